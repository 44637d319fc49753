"""Count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each
position; dynamic programming carries only (best score, piece count).  Ties go
to the piece that starts first (an equal score never replaces an earlier
start), as in the lattice of the public unigram tokenizers.  A character that
no single-character piece covers may be taken as unknown at ``least score -
10`` and counts one piece per UTF-8 byte (byte fallback).

A text is normalised by writing each blank as U+2581 and putting one in front.
No vocabulary piece has U+2581 after another character (checked when the
vocabulary is read), so the best segmentation is the sum over the stretches
that begin at a run of U+2581; likewise a character that occurs in no piece of
two or more characters cuts.  The stretches of a record batch are cut and told
apart by Arrow, the distinct ones are solved together, position by position in
numpy, each once (a task keeps up to about ``MEMO`` answers), and a text's counts are summed by position.  One map pass, no
shuffle, nothing collected; texts are read whole, in slices of rows of about
``SLICE_CHARS`` characters.

Ties.  The reference library adds up scores from the start of the text, so
where two segmentations are equal but for rounding, its choice depends on the
sum before them.  Scores that are whole multiples of 1/1024 add up exactly, so
a stretch may be solved on its own.  With other scores a stretch in which two
ways come within ``NEAR`` of each other (relative to the sums) is called close,
and a text with a close stretch is solved from its first character to its last.

The vocabulary and its scores are a parameter; the registered query takes the
pieces and scores of the public 32k piece file (that file's own encoder merges
pairs; here its scores serve as unigram log scores, since no unigram file is
among the public ones).  Null and empty texts have 0 pieces and score 0;
repeated ids give one row each.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import row_slices, shared, table

BLANK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the unigram tokenizers
MEMO = 300_000  # beyond it a task forgets
SHORT, AT_ONCE = 200, 20_000  # longer stretches are solved one by one
NEAR = 1e-9
SLICE_CHARS = 4_000_000
BLANK_RUN = re.compile(BLANK + "+[^" + BLANK + "]*|[^" + BLANK + "]+")


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Normal pieces and scores of a sentencepiece model (no control, unknown
    or byte pieces)."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())
            if not (m.is_byte(i) or m.is_unknown(i) or m.is_control(i) or m.is_unused(i))]


class CountViterbi:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        for p, s in pieces:
            self.auto.add_word(p, (len(p), s))
            if BLANK in p.lstrip(BLANK):
                raise ValueError(f"piece {p!r} has a blank after another character")
        self.auto.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.inner = {c for p, _ in pieces if len(p) > 1 for c in p}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.exact = all(float(s * 1024).is_integer() and abs(s) < 2 ** 30 for _, s in pieces)
        self.memo: dict[str, tuple[float, int, bool]] = {}
        # for many stretches at once: longer pieces by number, single characters by table
        self.scores = np.array([*(s for _, s in pieces), self.unknown])
        self.code_of = np.full(0x110000, len(pieces), np.int64)
        self.auto_codes = ahocorasick.Automaton()
        for k, (p, _) in enumerate(pieces):
            if len(p) == 1:
                self.code_of[ord(p)] = k
            else:
                self.auto_codes.add_word(p, k << 16 | len(p))
        self.auto_codes.make_automaton()

    def solve(self, s: str) -> tuple[float, int, bool]:
        """(best score, pieces, is close) of one stretch, or of a whole text."""
        n = len(s)
        score: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        score[0] = 0.0
        close = False
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if self.auto:
            for end, match in self.auto.iter(s):
                ends[end].append(match)
        for e in range(n):
            best, pieces = None, 0
            for size, piece_score in sorted(ends[e], reverse=True):  # earliest start first
                before = score[e + 1 - size]
                if before is None:
                    continue
                now = before + piece_score
                if best is not None and abs(now - best) <= NEAR * (1.0 + abs(best)):
                    close = True
                if best is None or now > best:
                    best, pieces = now, count[e + 1 - size] + 1
            if s[e] not in self.single and score[e] is not None:
                now = score[e] + self.unknown
                if best is not None and abs(now - best) <= NEAR * (1.0 + abs(best)):
                    close = True
                if best is None or now > best:
                    best, pieces = now, count[e] + len(s[e].encode("utf-8", "surrogatepass"))
            score[e + 1], count[e + 1] = best, pieces
        return score[n], count[n], close and not self.exact

    def stretch(self, s: str) -> tuple[float, int, bool]:
        got = self.memo.get(s)
        if got is None:
            total, pieces, close, start = 0.0, 0, False, 0
            for k in range(1, len(s) + 1):
                if k == len(s) or s[k] not in self.inner or s[k - 1] not in self.inner:
                    a, b, c = self.solve(s[start:k])
                    total, pieces, close, start = total + a, pieces + b, close or c, k
            got = self.memo[s] = (total, pieces, close)
        return got

    def text(self, text: str | None) -> tuple[float, int]:
        """(best score, pieces) of one text."""
        counts, scores = self.texts(pa.array([text], pa.string()))
        return float(scores[0]), int(counts[0])

    def solve_many(self, words: list[str]) -> list[tuple[float, int, bool]]:
        """``solve`` of many short stretches at once: the matches of all of
        them side by side, position by position in their stretch.  Matches
        that end at one place come in the order of their starts, and the first
        of the best is taken."""
        joined = "".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        found = np.zeros((0, 2), np.int64)
        if self.auto_codes:
            found = np.fromiter(chain.from_iterable(self.auto_codes.iter(joined)), np.int64).reshape(-1, 2)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        found = found[found[:, 0] + 1 - (found[:, 1] & 0xFFFF) >= begin[found[:, 0]]]  # none reaches over a cut
        at = np.concatenate((found[:, 0], np.arange(len(joined))))
        order = np.argsort(at, kind="stable")
        at = at[order]
        size = np.concatenate((found[:, 1] & 0xFFFF, np.ones(len(joined), np.int64)))[order]
        piece = np.concatenate((found[:, 1] >> 16, self.code_of[points]))[order]
        of_bytes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        adds = np.where(piece < len(self.scores) - 1, 1, of_bytes[at])  # the last is the unknown piece
        owner = np.repeat(np.arange(len(words)), sizes)
        word = owner[at]
        end = at + 1 + word  # a stretch of n characters has n + 1 positions
        start = end - size
        last = np.cumsum(sizes + 1) - 1
        score, count = np.zeros(len(joined) + len(words)), np.zeros(len(joined) + len(words), np.int64)
        close = np.zeros(len(words), bool)
        depth = (end - (last - sizes)[word]).astype(np.uint8)
        by_depth = np.argsort(depth, kind="stable")
        for chosen in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
            now, into = score[start[chosen]] + self.scores[piece[chosen]], end[chosen]
            cut = np.flatnonzero(np.append(True, into[1:] != into[:-1]))
            group = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(into))))
            top = np.maximum.reduceat(now, cut)
            best = np.flatnonzero(now == top[group])
            best = best[np.searchsorted(group[best], np.arange(len(cut)))]
            score[into[cut]] = top
            count[into[cut]] = count[start[chosen[best]]] + adds[chosen[best]]
            if not self.exact:
                near = np.add.reduceat((top[group] - now <= NEAR * (1.0 + np.abs(top[group]))).astype(np.int64), cut)
                close[word[chosen[cut[near > 1]]]] = True
        return [*zip(score[last].tolist(), count[last].tolist(), close.tolist())]

    def stretches(self, words: list[str]) -> list[tuple[float, int, bool]]:
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = [w for w in words if w not in self.memo]
        short = [w for w in new if len(w) <= SHORT]
        for k in range(0, len(short), AT_ONCE):
            part = short[k:k + AT_ONCE]
            self.memo.update(zip(part, self.solve_many(part)))
        return [self.memo[w] if w in self.memo else self.stretch(w) for w in words]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(counts, scores) of a slice of texts."""
        texts = texts.fill_null("")
        stretches, row = text_stretches(texts)
        coded = stretches.dictionary_encode()
        solved = self.stretches(coded.dictionary.to_pylist())
        at = np.asarray(coded.indices)
        of = [np.array(x, k)[at] for x, k in zip(zip(*solved) if solved else ((),) * 3, (float, np.int64, bool))]
        counts = np.bincount(row, of[1], len(texts)).astype(np.int64)
        scores = np.bincount(row, of[0], len(texts)).astype(float)
        for k in np.unique(row[of[2]]):
            scores[k], counts[k], _ = self.solve(BLANK + texts[int(k)].as_py().replace(" ", BLANK))
        return counts, scores


def text_stretches(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All stretches of the texts and the row of each.  Where blanks stand
    alone, they are the words with a mark in front; texts with runs of blanks,
    a blank in front or marks of their own are cut by a pattern."""
    odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, BLANK)))
    some = pc.not_equal(texts, "")
    plain = np.flatnonzero(np.asarray(pc.and_(some, pc.invert(odd))))
    words = pc.split_pattern(texts.take(pa.array(plain)), " ")
    flat, row = words.flatten(), np.repeat(plain, np.diff(np.asarray(words.offsets)))
    parts = [pc.binary_join_element_wise(pa.scalar(BLANK), flat, "")]
    rows = [row]
    for k in np.flatnonzero(np.asarray(pc.and_(some, odd))):
        found = BLANK_RUN.findall(BLANK + texts[int(k)].as_py().replace(" ", BLANK))
        parts.append(pa.array(found, pa.string()))
        rows.append(np.full(len(found), k))
    return pa.concat_arrays(parts), np.concatenate(rows).astype(np.int64)


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_pieces, best_score."""
    held = shared(docs.sparkSession, pieces)  # bounded by the tokenizer file
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        v = CountViterbi(held())
        for b in batches:
            for start, n in row_slices(b.column(1), SLICE_CHARS):
                counts, scores = v.texts(b.column(1).slice(start, n))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, n), pa.array(counts), pa.array(scores)],
                                                 ["doc_id", "n_pieces", "best_score"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_pieces long, best_score double")


def op2_token_counts(spark, sf_dir) -> DataFrame:
    import public_tokenizers
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"),
                        read_pieces(public_tokenizers.path("piece_bpe_32k.model")))
