"""Near words against comparing every pair; hot groups; odd rows."""

import itertools
import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelens.llm.spelling import Acceptor, near_middles, near_pairs, spelling_forms, word_counts


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if u == v or len(v) - len(u) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return any(u == v[:k] + v[k + 1:] for k in range(len(v)))


def brute(words):
    return {(a, b) for a, b in itertools.permutations(words, 2) if near(a, b)}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("ab", min_size=3, max_size=3), max_size=8), st.sets(st.text("ab", min_size=4, max_size=4), max_size=12))
def test_composition_of_two_lengths(short, long):
    got = [frozenset(p) for p in near_middles(sorted(short), sorted(long), 3, True)]
    want = {frozenset(p) for p in brute(short)} | {frozenset((a, b)) for a in short for b in long if near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_acceptor_is_minimal():
    m = Acceptor()
    s = m.add(sorted(["tap", "taps", "top", "tops"]))
    assert sorted(m.rest(s)) == ["tap", "taps", "top", "tops"]
    assert len(m.final) == 5  # t, {a, o} share one state, p, s


def vocabulary(seed, letters, n, lengths):
    r = random.Random(seed)
    return sorted({"".join(r.choice(letters) for _ in range(r.choice(lengths))) for _ in range(n)})


@pytest.mark.parametrize("rows", [20_000, 6])
def test_pairs_against_all_pairs(spark, rows):
    """Small groups, and groups split down to single positions."""
    words = vocabulary(1, "abé", 260, [1, 2, 4, 5, 6]) + ["common" + w for w in vocabulary(2, "xyz", 60, [3, 4])]
    df = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n long")
    got = [(r.word, r.near) for r in near_pairs(df, group_rows=rows).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(words)


def test_forms_and_roots(spark):
    n = {"colour": 100, "color": 40, "colou": 20, "colo": 9, "zebra": 8, "zebro": 5, "aaaaa": 8, "aaaab": 8, "aaaac": 4}
    df = spark.createDataFrame([*n.items()], "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling_forms(df).collect()}
    assert got["color"] == ("colour", "colour", 3, 100) and got["colo"] == ("color", "colour", 2, 40)
    assert got["colou"] == ("colour", "colour", 3, 100) and got["colour"] == (None, "colour", 2, None)
    assert got["zebro"] == (None, "zebro", 1, None)
    assert got["aaaac"] == ("aaaaa", "aaaaa", 2, 8)  # equal n: the smaller word


def test_long_chain_of_forms(spark):
    words = ["ab" * 3 + "c" * k for k in range(9)]
    df = spark.createDataFrame([(w, 3 ** (9 - k)) for k, w in enumerate(words)], "word string, n long")
    assert {r.root for r in spelling_forms(df).collect()} == {words[0]}


def test_very_long_words(spark):
    long = "ab" * 3000
    words = [long, long + "x", long[:10] + "z" + long[11:], "q" + long, long[:2999] + long[3000:]]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    assert {(r.word, r.near) for r in near_pairs(df).collect()} == brute(words)


def test_word_counts(spark):
    rows = [(1, "Éclair ÉCLAIR éclair"), (2, "Hello hello, HELLO! it's"), (2, "Hello"), (3, None), (4, ""), (None, "hello hello"),
            (5, "x×yz÷w " * 3), (6, "long" * 3000), (7, "tiny tiny tiny")]
    want = Counter()
    for i, t in rows:
        import re
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 3 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            want[w] += 1
    docs = spark.createDataFrame([(i, t, 1, "h") for i, t in rows], "doc_id long, text string, n int, word string")
    got = {r.word: r.n for r in word_counts(docs, misspelt=3, least_count=1).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5}
    empty = spelling_forms(word_counts(docs.limit(0)))
    assert empty.count() == 0 and set(empty.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
