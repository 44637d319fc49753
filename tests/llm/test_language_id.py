"""Language identification: every segmentation listed by hand, held-out rows, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelens.llm.common import row_slices, table
from pricelens.llm.language_id import (
    BLANK, LONGEST, Pieces, WordScores, fit_languages, learn_rows, op11_language_id, predict_languages, scaled, text_words)

PIECES = [BLANK, BLANK + "a", "a", "b", "ab", "ba", "bab", BLANK + "ab", "aba"]


def segmentations(word):
    """Every way to cut ``word`` into pieces, as lists of piece numbers."""
    if not word:
        return [[]]
    out = []
    for n in range(1, len(word) + 1):
        head = word[:n]
        if head in PIECES:
            out += [[PIECES.index(head), *rest] for rest in segmentations(word[n:])]
        elif n == 1:
            out += [[len(PIECES), *rest] for rest in segmentations(word[1:])]
    return out


def test_forward_sums_all_segmentations():
    logs = np.log(np.random.default_rng(3).dirichlet(np.ones(len(PIECES) + 1), 3).T)
    words = ["a", "ab", "abab", "bababa", "zab", "ab" * 12, "qqq"]
    got = WordScores(Pieces(PIECES), logs).of(words)
    for w, row in zip(words, got):
        want = np.log(sum(np.exp(logs[s].sum(axis=0)) for s in segmentations(BLANK + w)))
        assert np.allclose(row, want, atol=1e-9)


def test_expected_uses_match_enumeration():
    logs = np.log(np.random.default_rng(4).dirichlet(np.ones(len(PIECES) + 1)))
    v = Pieces(PIECES)
    lattice = v.lattice(["abab", "zba"])
    uses = lattice.expected_uses(scaled(logs, v.sizes)[lattice.piece])
    for k, w in enumerate(["abab", "zba"]):
        ways = segmentations(BLANK + w)
        p = np.array([np.exp(logs[s].sum()) for s in ways])
        want = sum(q * np.bincount(s, minlength=len(logs)) for q, s in zip(p / p.sum(), ways))
        mine = lattice.word == k
        assert np.allclose(np.bincount(lattice.piece[mine], uses[mine], len(logs)), want)


def test_extreme_words_neither_overflow_nor_underflow():
    v = Pieces(PIECES)
    logs = np.log(np.full((len(PIECES) + 1, 2), 1e-30))
    got = WordScores(v, logs).of(["z" * LONGEST, "a" * LONGEST])
    assert np.isfinite(got).all()


def test_words_and_slices():
    texts = pa.array(["Ab, cd'1e", None, "", "12 !", "x" * (2 * LONGEST + 3), " ÉÀ\n"])
    words, counts = text_words(texts)
    assert words.to_pylist() == ["ab", "cd", "e", "x" * LONGEST, "x" * LONGEST, "xxx", "éà"]
    assert counts.tolist() == [3, 0, 0, 0, 3, 1]
    assert sum(n for _, n in row_slices(texts, 5)) == len(texts)
    assert [*row_slices(pa.array([], pa.string()), 5)] == []


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = op11_language_id(spark, sf).join(table(spark, sf, "documents", "doc_id", "lang"), "doc_id")
    row = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
                                     F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert row.right >= 0.97 and 0 <= row.lo and row.hi <= 1


def test_odd_rows(spark):
    rows = [(1, "the of and the", "en", "s"), (2, "der die und der", "de", "s"), (3, None, "en", "s"), (4, "", None, "s"),
            (4, "the the", None, "s"), (None, "und der", "de", "s"), (5, "42 !!", "de", "s"), (6, "the of and " * 13_000 + "x" * 5000, "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    pieces = [BLANK, *"abcdefghijklmnopqrstuvwxyz", BLANK + "the", BLANK + "der", "nd"]
    model = fit_languages(learn_rows(docs, F.lit(False)), pieces)
    out = {(r.doc_id, r.n_words): r for r in predict_languages(docs, model).collect()}
    assert len(out) == len(rows)
    assert out[1, 4].lang_pred == "en" and out[2, 4].lang_pred == "de" and out[None, 2].lang_pred == "de"
    assert out[6, 39_000 + -(-5000 // LONGEST)].lang_pred == "en"
    for k in ((3, 0), (4, 0), (5, 0)):
        assert (out[k].lang_pred, out[k].score) == ("und", 0.0)
    nothing = predict_languages(docs, fit_languages(docs.filter("lang is null"), pieces))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    assert predict_languages(docs.limit(0), model).count() == 0


def test_too_many_languages_are_refused(spark, monkeypatch):
    from pricelens.llm import language_id
    monkeypatch.setattr(language_id, "MODEL_CELLS", 4)
    docs = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "lang string, text string")
    with pytest.raises(ValueError, match="languages"):
        fit_languages(docs, [BLANK, "x"])
