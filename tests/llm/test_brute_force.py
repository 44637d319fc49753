"""Searches, gradients and packing against plain computations."""

import math

import numpy as np
import pyarrow as pa
import pytest

from pricelens.llm import bpe, decontamination as dc, quality, sharding, toxicity
from pricelens.llm.common import table
from pricelens.llm.decontamination import Index, clean_words, contaminated, question_answer, shingles
from pricelens.llm.url_filters import op10_url_filters

SF = "/root/testdata/sf0.001"


def plain_impacts(items):
    """Per item: word -> its share of the item's BM25 weight against itself."""
    words = [clean_words(t) for _, t in items]
    mean = sum(map(len, words)) / len(words)
    df = {}
    for own in words:
        for w in set(own):
            df[w] = df.get(w, 0) + 1
    out = []
    for own in words:
        impact = {}
        for w in set(own):
            n = own.count(w)
            idf = math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5))
            impact[w] = idf * n * (dc.K1 + 1) / (n + dc.K1 * (1 - dc.B + dc.B * len(own) / mean))
        total = sum(impact.values())
        out.append({w: x / total for w, x in impact.items()})
    return out, df, mean


@pytest.mark.parametrize("seed", range(4))
def test_block_max_wand_equals_scoring_every_item(seed):
    r = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = 1 / np.arange(1, 61)
    items = [(k, " ".join(r.choice(vocabulary, r.integers(3, 30), p=weights / weights.sum()))) for k in range(500)]
    impacts, df, mean = plain_impacts(items)
    ix = Index(items, df, len(items), mean)
    found = 0
    for _ in range(150):
        asked = set(r.choice(vocabulary, r.integers(1, 50), replace=False).tolist()) & set(ix.term)
        want = {k: sum(x for w, x in own.items() if w in asked) for k, own in enumerate(impacts)}
        want = {k: s for k, s in want.items() if s >= dc.MIN_SCORE - 1e-9}
        got = dict(ix.search(sorted(ix.term[w] for w in asked)))
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
        found += len(want)
    assert found > 1000


def plain_contaminated(docs, items):
    """Every window of every text against every item."""
    impacts, _, _ = plain_impacts(items)
    span = max(len(clean_words(t)) for _, t in items)
    parts = [(shingles(clean_words(t)), *map(shingles, question_answer(t))) for _, t in items]
    out = set()
    for doc_id, text in docs:
        words = (text or "").split()
        for start in range(0, len(words), span):
            own = [w for w in map(dc.clean, words[start:start + 2 * span]) if w]
            present = set(own)
            for k, (item, _) in enumerate(items):
                if sum(x for w, x in impacts[k].items() if w in present) < dc.MIN_SCORE - 1e-9:
                    continue

                def share(part, own=own):
                    if not part:
                        return None
                    n = len(next(iter(part)))
                    return len(part & (shingles(own, n) if len(own) >= n else set())) / len(part)
                whole, q, a = map(share, parts[k])
                if whole >= dc.MIN_OVERLAP or (q is not None and a is not None and min(q, a) >= dc.MIN_OVERLAP):
                    out.add((doc_id, item))
    return out


@pytest.mark.parametrize("part_bytes", [dc.PART_BYTES, 3000])
def test_decontamination_equals_every_window_against_every_item(spark, part_bytes):
    docs, items = table(spark, SF, "documents", "doc_id", "text"), table(spark, SF, "benchmark", "item_id", "text")
    want = plain_contaminated([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items, part_bytes=part_bytes).collect()}
    if part_bytes == dc.PART_BYTES:
        assert want and got == want
    else:  # a part's windows follow its own longest item
        held = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if i.text in d.text}
        assert held <= got


def test_attention_gradients_are_numerically_right():
    r = np.random.default_rng(5)
    model = quality.AttentionMil()
    sizes = [1, 4, 2, 7]
    x = r.normal(0, 0.5, (sum(sizes), quality.WIDTH))
    starts = np.cumsum([0, *sizes])[:-1]
    y, weight = np.array([1.0, 0.0, 1.0, 0.0]), np.array([0.5, 1.5, 1.0, 2.0])

    def loss():
        s = model.forward(x, starts)[0]
        return float((-weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum() / weight.sum())
    s, kept = model.forward(x, starts)
    a = kept[4]
    assert np.allclose(np.add.reduceat(a, starts), 1.0)
    for name, grad in model.gradient(y, weight, starts, s, kept).items():
        flat = model.p[name].reshape(-1)
        for k in r.choice(flat.size, min(flat.size, 25), replace=False):
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert abs((up - down) / (2 * step) - np.asarray(grad).reshape(-1)[k]) < 1e-7, name


@pytest.mark.parametrize("bias,prior,clamped", [(-3.0, 0.6, True), (1.0, 0.1, False)])
def test_clamped_risk_gradients_are_numerically_right(bias, prior, clamped):
    r = np.random.default_rng(9)
    xp, xu = (r.random((40, 12)) < 0.5).astype(float), (r.random((200, 12)) < 0.2).astype(float)
    w = np.abs(r.normal(1.0, 0.3, 12))

    def plain(w, b):
        def soft(v):
            return np.log1p(np.exp(v)).mean()
        negative = soft(xu @ w + b) - prior * soft(xp @ w + b)
        return prior * soft(-(xp @ w + b)) + max(0.0, negative), negative < 0
    risk, grad = toxicity.pu_risk(w, bias, xp, xu, prior)
    assert plain(w, bias)[1] == clamped and abs(plain(w, bias)[0] - risk) < 1e-9
    for k in range(13):
        e = np.zeros(13)
        e[k] = 1e-6
        up, down = plain(w + e[:-1], bias + e[-1])[0], plain(w - e[:-1], bias - e[-1])[0]
        assert abs((up - down) / 2e-6 - grad[k]) < 1e-6


def test_toxic_words_found_among_unlabelled_rows():
    r = np.random.default_rng(2)

    def row(toxic):
        own = set(r.choice(1000, 30, replace=False).tolist())
        return np.array(sorted(own | set((2000 + r.choice(20, 6, replace=False)).tolist() if toxic else [])), np.uint64)
    positive = [row(True) for _ in range(300)]
    model = toxicity.fit_pu(positive, [row(k % 10 == 0) for k in range(2000)], 0.1)
    assert min(model.score(row(True)) for _ in range(100)) > 0.7
    assert max(model.score(row(False)) for _ in range(100)) < 0.3
    assert model.score(np.zeros(0, np.uint64)) < 0.3


def plain_best_fit(sizes, rooms, grow):
    rooms, out = list(rooms), []
    for s in sizes:
        fits = [(room, k) for k, room in enumerate(rooms) if room >= s]
        if not fits and grow is None:
            return None
        if not fits:
            rooms.append(max(grow, s))
            fits = [(rooms[-1], len(rooms) - 1)]
        k = min(fits)[1]
        rooms[k] -= s
        out.append(k)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_equals_the_plain_form(seed):
    r = np.random.default_rng(seed)
    sizes = sorted(r.integers(1, 40, 200).tolist(), reverse=True)
    rooms = r.integers(0, 300, 8).tolist()
    assert sharding.best_fit(sizes, rooms, grow=60) == plain_best_fit(sizes, rooms, 60)
    assert sharding.best_fit(sizes, rooms) == plain_best_fit(sizes, rooms, None)
    assert sharding.best_fit([], rooms) == []


@pytest.mark.parametrize("seed", range(20))
def test_level_fit_leaves_bins_level(seed):
    r = np.random.default_rng(seed)
    sizes = sorted(r.integers(1, 60, 400).tolist(), reverse=True)
    used = r.integers(0, 500, 10).tolist()
    fill = list(used)
    for s, k in zip(sizes, sharding.level_fit(sizes, used), strict=True):
        fill[k] += s
    assert sum(fill) == sum(used) + sum(sizes)
    assert max(fill) - min(fill) <= max(sizes)


def test_a_full_word_table_changes_nothing(spark, monkeypatch):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, SF, "documents", "doc_id", "text")

    def run():
        return {r.doc_id: (r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode_decode(docs, path).collect()}
    whole = run()
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    assert run() == whole


def test_rules_stay_in_the_jvm(spark):
    plan = op10_url_filters(spark, SF)._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "LogicalRDD" not in plan and "Python" not in plan
    assert pa.__version__
