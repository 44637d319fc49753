"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all of its segmentations into pieces of
the product of their probabilities, by the forward algorithm; a text's is the
product over its words.  With the languages' shares as prior this gives a
posterior, and the language with the greatest one is predicted.

Words: the text in lower case, cut to maximal runs of letters and marks, each
with the word mark U+2581 in front.  No piece has the mark after another
character, so a sum over the segmentations of a text factors into its words.
A run of more than ``LONGEST`` characters is scored as several words of at most
that many.  A character that no piece covers counts as an unknown piece.  No piece
is less likely than e^``LEAST``.

Learning covers every row to learn from, not a sample.  One map pass counts
the words of each record batch and one aggregation adds them to
(language, word, n).  Then ``ROUNDS`` rounds of expectation maximisation read
that table: the forward-backward algorithm gives the expected number of uses of
each piece in each distinct word, weighted by n, and an aggregation adds them by
(language, piece).  What reaches the driver and is broadcast is this table of
vocabulary size x languages, bounded by ``MODEL_CELLS`` (beyond it the fit
raises).  Piece probabilities are smoothed towards the mean over all languages.

All dynamic programming runs for the distinct words of a record batch at once,
level by level over the position, on scaled probabilities.

Defined results.  Null texts and texts without a letter: ``und``, score 0.  No
row to learn from: ``und``, score 0, for all.  Equal posteriors: the smallest
language name.  Repeated ids give one row each, and an empty table no rows.
Rows without an id are learnt from and predicted like others.  Texts are read
whole, in slices of rows of at most about ``SLICE_CHARS`` characters.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import held_out, row_slices, shared, table, written
from pricelens.llm.token_counts import BLANK, read_pieces

LONGEST = 32
PER_CHAR, LEAST = 5.0, -23.0
ROUNDS = 3
SMOOTHING = 50.0  # uses of the mean over the languages that are added to each language's counts
FLAT = 1e-7       # share of the flat distribution in that mean
SLICE_CHARS = 4_000_000
WORDS_AT_ONCE = 20_000
MEMO = 200_000
MODEL_CELLS = 16_000_000
NOT_A_LETTER = r"[^\p{L}\p{M}]+"


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words in order, number of words of each row)."""
    flat = pc.replace_substring_regex(pc.utf8_lower(texts.fill_null("")), NOT_A_LETTER, " ")
    lists = pc.utf8_split_whitespace(pc.utf8_trim(flat, " "))
    words, counts = lists.flatten(), np.diff(np.asarray(lists.offsets))
    sizes = np.asarray(pc.utf8_length(words))
    if not len(sizes) or (sizes.min() > 0 and sizes.max() <= LONGEST):
        return words, counts
    row = np.repeat(np.arange(len(counts)), counts)
    parts, at = [], []
    for w, n, r in zip(words.to_pylist(), sizes, row):
        for k in range(0, n, LONGEST):
            parts.append(w[k:k + LONGEST])
            at.append(r)
    return pa.array(parts, pa.string()), np.bincount(np.array(at, int), minlength=len(counts))


class Pieces:
    """All occurrences of vocabulary pieces in many words.  Pieces of two or
    more characters come from an Aho-Corasick automaton, those of one from a
    table by code point (the unknown piece where there is none)."""

    def __init__(self, pieces: list[str]):
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        self.unknown = len(pieces)
        self.single = np.full(0x110000, self.unknown, np.int64)
        for k, p in enumerate(pieces):
            if BLANK in p.lstrip(BLANK):
                raise ValueError(f"piece {p!r} has a word mark after another character")
            if len(p) == 1:
                self.single[ord(p)] = k
            elif p:
                self.auto.add_word(p, k << 16 | len(p))
        self.auto.make_automaton()
        self.sizes = np.array([*map(len, pieces), 1], float)

    def lattice(self, words: list[str]) -> Lattice:
        marked = [BLANK + w for w in words]
        joined = "".join(marked)  # a piece has the mark only in front, so none crosses a word
        found = np.zeros((0, 2), np.int64)
        if len(self.auto):
            found = np.fromiter(chain.from_iterable(self.auto.iter(joined)), np.int64).reshape(-1, 2)
        lone = self.single[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        at = np.concatenate((np.arange(len(joined)), found[:, 0]))
        order = np.argsort(at, kind="stable")
        at = at[order]
        size = np.concatenate((np.ones(len(lone), np.int64), found[:, 1] & 0xFFFF))[order]
        piece = np.concatenate((lone, found[:, 1] >> 16))[order]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        return Lattice(at, size, piece, sizes)


class Lattice:
    """Words side by side on one line of positions (a word of n characters has
    n + 1): ``start``, ``end``, ``piece`` and ``word`` of every match, sorted
    by end; ``first`` and ``last`` position of every word."""

    def __init__(self, at: np.ndarray, size: np.ndarray, piece: np.ndarray, sizes: np.ndarray):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        self.word, self.piece, self.sizes = owner[at], piece, sizes
        self.end = at + 1 + self.word
        self.start = self.end - size
        self.last = np.cumsum(sizes + 1) - 1
        self.first = self.last - sizes
        self.depth = (np.arange(int((sizes + 1).sum())) - np.repeat(self.first, sizes + 1)).astype(np.uint16)

    def _sums(self, ends: np.ndarray, begins: np.ndarray, weight: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Level by level in the order of ``begins``' positions: the value of a
        position in ``ends`` is the sum of weight x value at ``begins``."""
        value = np.zeros((len(self.depth), weight.shape[1]))
        value[source] = 1.0
        key = self.depth[ends] if source is self.first else LONGEST + 2 - self.depth[ends]
        order = np.argsort(key, kind="stable")
        for chosen in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            into = ends[chosen]
            cut = np.flatnonzero(np.append(True, into[1:] != into[:-1]))
            value[into[cut]] = np.add.reduceat(value[begins[chosen]] * weight[chosen], cut)
        return value

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over all segmentations up to each position (positions x
        columns of ``weight``, the scaled probability of each match)."""
        return self._sums(self.end, self.start, weight, self.first)

    def expected_uses(self, weight: np.ndarray) -> np.ndarray:
        """Posterior probability of each match, by forward and backward sums."""
        alpha = self.forward(weight[:, None])[:, 0]
        by_start = np.argsort(self.start, kind="stable")
        beta = self._sums(self.start[by_start], self.end[by_start], weight[by_start, None], self.last)[:, 0]
        return alpha[self.start] * weight * beta[self.end] / alpha[self.last][self.word]


def scaled(logs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Piece probabilities, none under ``LEAST``, times e^(``PER_CHAR`` x
    length): sums over words of up to ``LONGEST`` characters then neither
    underflow nor overflow."""
    return np.exp(np.maximum(logs, LEAST) + PER_CHAR * sizes.reshape(-1, *[1] * (logs.ndim - 1)))


class LanguageModel:
    """Sorted language names, log priors, log piece probabilities
    (pieces + the unknown one, languages)."""

    def __init__(self, pieces: list[str], langs: list[str], priors: np.ndarray, logs: np.ndarray):
        self.pieces, self.langs, self.priors, self.logs = pieces, langs, priors, logs


class WordScores:
    """Log probability of words in each language; keeps up to ``MEMO``."""

    def __init__(self, pieces: Pieces, logs: np.ndarray):
        self.pieces, self.weights = pieces, scaled(logs, pieces.sizes)
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, logs.shape[1]))

    def of(self, words: list[str]) -> np.ndarray:
        """One row for each of these distinct words."""
        if len(self.place) > MEMO:
            self.place, self.rows = {}, self.rows[:0]
        new = [w for w in words if w not in self.place]
        parts = [self.rows]
        for k in range(0, len(new), WORDS_AT_ONCE):
            lattice = self.pieces.lattice(new[k:k + WORDS_AT_ONCE])
            whole = lattice.forward(self.weights[lattice.piece])[lattice.last]
            parts.append(np.log(whole) - PER_CHAR * lattice.sizes[:, None])
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.rows = np.concatenate(parts)
        return self.rows[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]


def _counted_words(batches):
    for b in batches:
        for start, n in row_slices(b.column(1), SLICE_CHARS):
            langs, texts = b.column(0).slice(start, n), b.column(1).slice(start, n)
            words, counts = text_words(texts)
            if not len(words):
                continue
            rows = pa.table({"lang": langs.take(pa.array(np.repeat(np.arange(n), counts))), "word": words})
            got = rows.group_by(["lang", "word"]).aggregate([([], "count_all")])
            yield from got.rename_columns(["lang", "word", "n"]).select(["lang", "word", "n"]).to_batches()


def word_counts(learn: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of (lang, text)."""
    got = learn.select("lang", "text").mapInArrow(_counted_words, "lang string, word string, n long")
    return got.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit_languages(docs: DataFrame, pieces: list[str], lang_col: str = "lang", text_col: str = "text",
                  rounds: int = ROUNDS) -> LanguageModel | None:
    """A model of the languages named in ``docs``; None without any."""
    spark = docs.sparkSession
    learn = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    learn = learn.filter(F.col("lang").isNotNull())
    shares = learn.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(1 + MODEL_CELLS // len(pieces)).collect()
    if len(shares) * len(pieces) > MODEL_CELLS:
        raise ValueError(f"more than {MODEL_CELLS // len(pieces)} languages: the piece table would be too large to broadcast")
    if not shares:
        return None
    langs, n = [r["lang"] for r in shares], np.array([r["n"] for r in shares], float)
    number = F.broadcast(spark.createDataFrame([(x, k) for k, x in enumerate(langs)], "lang string, l int"))
    counts = written(word_counts(learn).join(number, "lang").select("l", "word", "n"))
    size = len(pieces) + 1
    logs = np.full((size, len(langs)), -np.log(size))
    for _ in range(rounds):
        now = shared(spark, (pieces, logs))

        def uses(batches):
            names, table_now = now()
            v = Pieces(names)
            weights = scaled(table_now, v.sizes)
            for b in batches:
                for k in range(0, len(b), WORDS_AT_ONCE):
                    l, words, times = (c.slice(k, WORDS_AT_ONCE) for c in b.columns)
                    lattice = v.lattice(words.to_pylist())
                    lang = np.asarray(l).astype(np.int64)[lattice.word]
                    got = lattice.expected_uses(weights[lattice.piece, lang]) * np.asarray(times)[lattice.word]
                    cells, place = np.unique(lang * size + lattice.piece, return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells), pa.array(np.bincount(place, got, len(cells)))], ["cell", "uses"])
        # at most vocabulary x languages rows; summed as decimals, so that every run adds alike
        sums = (counts.mapInArrow(uses, "cell long, uses double")
                .groupBy("cell").agg(F.sum(F.col("uses").cast("decimal(30,9)")).cast("double").alias("uses")).toPandas())
        total = np.zeros(len(langs) * size)
        total[sums["cell"].to_numpy(np.int64)] = sums["uses"]
        total = total.reshape(len(langs), size).T
        mean = (1 - FLAT) * (total / np.maximum(1.0, total.sum(axis=0))).mean(axis=1) + FLAT / size
        logs = np.log((total + SMOOTHING * mean[:, None]) / (total.sum(axis=0) + SMOOTHING * mean.sum()))
    return LanguageModel(pieces, langs, np.log(n / n.sum()), logs)


def predict_languages(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, n_words) of every row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    if model is None:
        return src.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_words"))
    held = shared(docs.sparkSession, (model.pieces, model.langs, model.priors, model.logs))

    def run(batches):
        pieces, langs, priors, logs = held()
        scores, names = WordScores(Pieces(pieces), logs), np.array([*langs, "und"], object)
        for b in batches:
            for start, n in row_slices(b.column(1), SLICE_CHARS):
                texts = b.column(1).slice(start, n)
                words, counts = text_words(texts)
                lettered = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
                total = np.tile(priors, (n, 1))
                if len(words):
                    coded = words.dictionary_encode()
                    per_word = scores.of(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
                    some = np.flatnonzero(counts)
                    total[some] += np.add.reduceat(per_word, (np.cumsum(counts) - counts)[some])
                best = np.argmax(total, axis=1)
                share = 1 / np.exp(total - total[np.arange(n), best][:, None]).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, n), pa.array(names[np.where(lettered, best, len(langs))], pa.string()),
                     pa.array(np.where(lettered, share, 0.0)), pa.array(counts, pa.int64())],
                    ["doc_id", "lang_pred", "score", "n_words"])
    return src.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_words long")


def learn_rows(docs: DataFrame, out: Column) -> DataFrame:
    return docs.filter(~out).select("lang", "text")


def op11_language_id(spark, sf_dir) -> DataFrame:
    import public_tokenizers
    pieces = [p for p, _ in read_pieces(public_tokenizers.path("piece_bpe_32k.model"))]
    out = held_out(F.col("doc_id"), 5, 0)
    model = fit_languages(learn_rows(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), out), pieces)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return predict_languages(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
