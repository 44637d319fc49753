"""Hard negatives against plain integer products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm.hard_negatives import Packed, hard_negatives, largest, quantised


@pytest.mark.parametrize("top", [1, 3, 200, 1 << 13, 1 << 30, 1 << 61])
def test_packed_products_are_exact(top):
    rng = np.random.default_rng(top % 97)
    c, a = rng.integers(-top, top + 1, (37, 9)), rng.integers(-top, top + 1, (5, 9))
    want = [[max(-(2 ** 63 - 1), min(2 ** 63 - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in c] for p in a]
    assert Packed(c, largest(a)).scores(a).tolist() == want


def test_packing_shares_words():
    c = np.random.default_rng(0).integers(-130, 131, (30, 64))
    p = Packed(c, 130)
    assert p.small and p.fields >= 2 and p.words.shape == (64, -(-30 // p.fields))


def test_empty_shapes():
    assert Packed(np.zeros((3, 0), np.int64), 1).scores(np.zeros((2, 0), np.int64)).tolist() == [[0, 0, 0]] * 2


def brute(rows, anchors, positives=5, negatives=5):
    out = []
    for i, (a_id, a_lab, a) in enumerate(rows):
        if a_id not in anchors:
            continue
        s = [(-int(np.dot(a, v)), v_id, lab) for j, (v_id, lab, v) in enumerate(rows) if j != i and len(v) == len(a)]
        for p, p_id, _ in sorted(x for x in s if x[2] == a_lab)[:positives]:
            fits = sorted(x for x in s if x[2] != a_lab and 80 * -p <= 100 * -x[0] <= 100 * -p)
            out += [(a_id, p_id, k, n_id, -p, -n) for k, (n, n_id, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("tile", [(8192, 4096), (16, 3)])
def test_against_brute_force(spark, tile):
    rng = np.random.default_rng(5)
    data = [(k, int(rng.integers(0, 3)), [float(x) for x in rng.integers(-2, 4, 4) / 4]) for k in range(160)]
    data += [(k + 160, lab, v) for k, lab, v in data[:25]]                       # exact copies: ties
    data += [(500, 1, [1.0, 2.0]), (501, 1, [1.0, 2.0]), (502, 2, [1.0, 1.9]), (600, 1, []), (601, 2, []), (602, 1, [])]
    odd = [(None, 1, [1.0, 1.0, 1.0, 1.0]), (700, None, [1.0] * 4), (701, 1, None), (702, 1, [1.0, None, 1.0, 1.0]),
           (703, 1, [1.0, float("nan"), 1.0, 1.0]), (704, 2, [1.0, float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 9, "x") for r in data + odd],
                               "vec_id long, label int, embedding array<double>, rank int, score string")
    anchors = {k for k, _, _ in data if k % 10 == 0}
    got = hard_negatives(quantised(df, 256), F.col("vec_id") % 10 == 0, candidates_per_tile=tile[0], anchors_per_tile=tile[1])
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    q = [(k, lab, np.floor(256 * np.array(v)).astype(int)) for k, lab, v in data]
    assert sorted(map(tuple, got.collect())) == brute(q, anchors)


def test_empty_and_lonely(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(100, 1, [1.0])], [(100, 1, [1.0]), (1, 2, [1.0])]):
        assert hard_negatives(quantised(spark.createDataFrame(rows, schema), 256), F.col("vec_id") % 100 == 0).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(100, 1, [1.0]), (100, 1, [1.0]), (3, 2, [1.0])]
    got = hard_negatives(quantised(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), 4), F.col("vec_id") == 100)
    assert [tuple(r) for r in got.collect()] == [(100, 100, 1, 3, 16, 16)] * 2
