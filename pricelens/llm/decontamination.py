"""Benchmark decontamination: BM25 over the test items, block-max WAND.

The benchmark is the indexed side and every passage of every training text is
a query.  An item's term weights are its BM25 impacts divided by their sum, so
a passage's score is the share (0 to 1) of the item's weight that it holds; all
items at ``min_score`` or above are retrieved, then verified on word shingles:

* question: the item's words without its last sentence; answer: the last
  sentence (an item of one sentence has no answer).  A document is contaminated
  by an item when one passage holds at least ``min_overlap`` of the item's
  five-word shingles, or that share of the question's and of the answer's.
* Passages are windows of 2 L words that start every L words, L the words of
  the longest item, so every copy of an item lies whole in some window.

Retrieval first applies the upper-bound test to all windows of a document at
once: terms are split so that for no item the common terms weigh more than
``common_share``; a window whose rarer terms weigh less than ``min_score -
common_share`` for every item cannot reach the threshold.  The rest runs
block-max WAND over impact-ordered blocks of the posting lists.

One map pass over the documents; nothing of theirs is shuffled or collected.
The index is broadcast in parts of at most ``part_bytes`` of item text; a larger
benchmark is indexed part by part, with document frequencies taken over all
items.  Words are lower-cased without signs.

Null and empty texts match nothing; items without words match nothing; items
under five words are one shingle.  Repeated ids give their rows each, one for
every (row, item).  Equal items are reported each.  An empty benchmark or table
gives no rows.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import shared, table, written

K1, B = 1.2, 0.75
MIN_SCORE, COMMON_SHARE, MIN_OVERLAP = 0.6, 0.25, 0.8
SHINGLE = 5
BLOCK = 64
PART_BYTES = 32 << 20
MEMO = 400_000
ASCII_SIGNS = string.punctuation
SIGNS = re.compile(r"[\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def clean(word: str) -> str:
    word = word.lower().strip(ASCII_SIGNS)
    return word if word.isalnum() else SIGNS.sub("", word)


def clean_words(text: str) -> list[str]:
    return [w for w in map(clean, text.split()) if w]


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}


def question_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [p for p in map(clean_words, SENTENCE.split(text)) if p]
    if len(parts) < 2:
        return clean_words(text), []
    return [w for p in parts[:-1] for w in p], parts[-1]


class Index:
    """Posting lists of one part of the benchmark, with block maxima."""

    def __init__(self, items: list[tuple[object, str]], df: dict[str, int], n_items: int, mean: float):
        self.ids = [i for i, _ in items]
        words = [clean_words(t) for _, t in items]
        self.parts = []
        postings: dict[str, list[tuple[int, float]]] = {}
        for k, own in enumerate(words):
            q, a = question_answer(items[k][1])
            self.parts.append((shingles(own), shingles(q), shingles(a)))
            tf: dict[str, int] = {}
            for w in own:
                tf[w] = tf.get(w, 0) + 1
            impact = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1)
                      / (n + K1 * (1 - B + B * len(own) / mean)) for w, n in tf.items()}
            total = sum(impact.values())
            for w, x in impact.items():
                postings.setdefault(w, []).append((k, x / total))
        self.span = max([len(w) for w in words], default=1) or 1
        self.term = {w: t for t, w in enumerate(sorted(postings))}
        lists = [postings[w] for w in sorted(postings)]
        self.docs = [[d for d, _ in p] for p in lists]
        self.impacts = [[x for _, x in p] for p in lists]
        self.top = [max(x) for x in self.impacts]
        self.block_top = [[max(x[k:k + BLOCK]) for k in range(0, len(x), BLOCK)] for x in self.impacts]
        # rare terms: what is left when the most common terms are set aside up to their share
        spent, common = np.zeros(len(items)), np.zeros(len(lists) + 1, bool)
        for t in sorted(range(len(lists)), key=lambda t: -len(lists[t])):
            at = np.array(self.docs[t])
            if (spent[at] + self.impacts[t]).max() >= COMMON_SHARE:
                break
            spent[at] += self.impacts[t]
            common[t] = True
        common[-1] = True  # the place of words outside the index
        self.rare = ~common
        self.start = np.cumsum([0, *map(len, lists), 0])
        self.flat_docs = np.array([d for p in self.docs for d in p], np.int64)
        self.flat_impacts = np.array([x for p in self.impacts for x in p])

    def windows(self, terms: np.ndarray) -> list[int]:
        """Starts of the windows that the upper-bound test leaves."""
        at = np.flatnonzero(self.rare[terms])
        if not len(at):
            return []
        t = terms[at]
        sizes = self.start[t + 1] - self.start[t]
        hits = np.repeat(self.start[t] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        items, weight, place = self.flat_docs[hits], self.flat_impacts[hits], np.repeat(at // self.span, sizes)
        need = MIN_SCORE - COMMON_SHARE
        found, of = np.unique(items, return_inverse=True)
        enough = np.bincount(of, weights=weight) >= need
        if not enough.any():
            return []
        keep = enough[of]
        items, weight, place = items[keep], weight[keep], place[keep]
        cells = int(place.max()) + 2
        both = np.concatenate((items * cells + place + 1, items * cells + place))  # a window and the one before
        cell, of = np.unique(both, return_inverse=True)
        good = cell[np.bincount(of, weights=np.concatenate((weight, weight))) >= need] % cells - 1
        return sorted({max(0, int(w)) * self.span for w in good})

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: all (item, score) with score >= MIN_SCORE."""
        cursor = [[self.docs[t][0], 0, t] for t in terms]
        out = []
        while cursor:
            cursor.sort()
            bound, pivot = 0.0, None
            for k, (_, _, t) in enumerate(cursor):
                bound += self.top[t]
                if bound >= MIN_SCORE - 1e-9:
                    pivot = k
                    break
            if pivot is None:
                return out
            item = cursor[pivot][0]
            while pivot + 1 < len(cursor) and cursor[pivot + 1][0] == item:
                pivot += 1
            block_bound, ahead = 0.0, cursor[pivot + 1][0] if pivot + 1 < len(cursor) else math.inf
            for _, at, t in cursor[:pivot + 1]:
                b = bisect_left(self.docs[t], item, at) // BLOCK
                if b < len(self.block_top[t]):
                    block_bound += self.block_top[t][b]
                    last = self.docs[t][min(len(self.docs[t]), (b + 1) * BLOCK) - 1]
                    ahead = min(ahead, last + 1)
            if block_bound >= MIN_SCORE - 1e-9:
                score = 0.0
                for c in cursor[:pivot + 1]:
                    at = bisect_left(self.docs[c[2]], item, c[1])
                    if at < len(self.docs[c[2]]) and self.docs[c[2]][at] == item:
                        score += self.impacts[c[2]][at]
                if score >= MIN_SCORE - 1e-9:
                    out.append((item, score))
                ahead = item + 1
            target = max(ahead, item + 1)
            moved = []
            for k, (d, at, t) in enumerate(cursor):
                if k <= pivot:
                    at = bisect_left(self.docs[t], target, at)
                    if at >= len(self.docs[t]):
                        continue
                    d = self.docs[t][at]
                moved.append([d, at, t])
            cursor = moved
        return out


def _search(index, id_type: pa.DataType, item_type: pa.DataType):
    names = ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"]

    def share(part: set, found: set):
        return len(part & found) / len(part) if part else None

    def run(batches):
        ix: Index = index()

        class Terms(dict):
            def __missing__(self, word):
                if len(self) >= MEMO:
                    self.clear()
                got = self[word] = ix.term.get(clean(word), len(ix.term))
                return got
        term = Terms()
        for batch in batches:
            out = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or "").split()
                if not words:
                    continue
                terms = np.fromiter(map(term.__getitem__, words), np.int64, len(words))
                best: dict[int, tuple] = {}
                for start in ix.windows(terms):
                    own = np.unique(terms[start:start + 2 * ix.span])
                    hits = ix.search(own[own < len(ix.term)].tolist())
                    if hits:
                        seen = shingles(clean_words(" ".join(words[start:start + 2 * ix.span])))
                        for item, score in hits:
                            # a part shorter than a shingle is looked for as a whole
                            all_, q, a = (share(p, seen if not p or len(next(iter(p))) == SHINGLE else shingles(
                                clean_words(" ".join(words[start:start + 2 * ix.span])), len(next(iter(p)))))
                                for p in ix.parts[item])
                            if all_ is not None and (all_ >= MIN_OVERLAP or (
                                    q is not None and q >= MIN_OVERLAP and a is not None and a >= MIN_OVERLAP)):
                                best[item] = max(best.get(item, (0.0,)), (all_, score, q or 0.0, -1.0 if a is None else a))
                for item, (all_, score, q, a) in sorted(best.items()):
                    for c, v in zip(out, (doc_id, ix.ids[item], score, all_, q, None if a < 0 else a), strict=True):
                        c.append(v)
            kinds = (id_type, item_type, *[pa.float64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text",
                 part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap) of
    every document and item that it holds."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    its = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    its = written(its.filter("text is not null and item_id is not null"))
    kind, item_kind = src.schema["doc_id"].dataType, its.schema["item_id"].dataType
    size = its.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes))

    def each(batches):
        for b in batches:
            own = [clean_words(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sorted(set(w)) for w in own], pa.list_(pa.string())),
                                              pa.array(map(len, own), pa.int64())], ["terms", "n"])
    counted = written(its.select("text").mapInArrow(each, "terms array<string>, n long").filter("n > 0"))
    n_items, mean = counted.agg(F.count("*"), F.avg("n")).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    schema = (f"doc_id {kind.simpleString()}, item_id {item_kind.simpleString()}, score double, overlap double, "
              "question_overlap double, answer_overlap double")
    out = spark.createDataFrame([], schema)
    for p in range(parts if n_items else 0):
        # one part of the items, at most about part_bytes of text, and its terms' document frequencies
        rows = its.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).orderBy("item_id", "text").collect()
        rows = [(r[0], r[1]) for r in rows if clean_words(r[1])]
        if not rows:
            continue
        own = spark.createDataFrame([(w,) for w in sorted({w for _, t in rows for w in clean_words(t)})], "term string")
        index = Index(rows, dict(df.join(own, "term").select("term", "df").collect()), n_items, mean)
        found = src.mapInArrow(_search(shared(spark, index), to_arrow_type(kind),
                                       to_arrow_type(item_kind)), schema)
        out = out.unionByName(found)
    return out


def op5_decontamination(spark, sf_dir) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text"))
