"""Operators against brute force, round trips and held-out accuracy; odd rows."""

import hashlib
import os
import re
import subprocess
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers

from pricelens.llm import cover_tree, jaccard, quality, sharding, toxicity
from pricelens.llm.bpe import WordBpe, encode_decode, words_of
from pricelens.llm.common import min_label_components, table
from pricelens.llm.decontamination import contaminated
from pricelens.llm.labelled import label_rows
from pricelens.llm.line_dedup import line_dedup
from pricelens.llm.stages import decontamination_stage, jaccard_stage
from pricelens.llm.token_counts import CountViterbi, read_pieces, token_counts
from pricelens.llm.url_filters import url_filter

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [(1, None), (2, ""), (3, "one"), (3, "one"), (4, "a b c d e f g\nh i"), (5, "a b c d e f g\nh i"),
       (None, "a b c d e f g\nh i"), (6, "Ünï 中文 😀 <|endoftext|> it's\t\x1c"), (7, "word " * 30_000), (8, " \n\n ")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, an extra clashing column."""
    rows = [(i, t, "x", "y") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, sig string, shard string")


def rows_of(df, *cols):
    return sorted(map(repr, df.select(*cols).collect()))


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 1), (3, 4), (7, 9)], "a long, b long")
    assert {r.node: r.component_id for r in min_label_components(e).collect()} == {
        1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}


def test_line_dedup(spark, odd):
    long = "\n".join(f"w{k} " * 15 + "end" for k in range(6))
    rows = [(1, "head\n" + long), (2, long + "\ntail"), (3, long), (4, "short\nshort"), (None, long)]
    out = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[1].n_removed, out[2].text, out[3].n_removed, out[4].n_removed) == (0, "tail", 6, 0)
    assert out[None].text == "" and [tuple(s) for s in out[2].spans] == [(0, 5)]
    got = {r.doc_id: (r.text, r.n_lines) for r in line_dedup(odd).collect()}
    assert got[1] == (None, 0) and got[2] == ("", 1) and got[4][1] == 2
    assert line_dedup(odd.limit(0)).count() == 0


def test_token_counts_match_the_library(spark, odd):
    pieces = read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    vocab = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)] + pieces
    lib = Tokenizer(models.Unigram(vocab, 0, True))
    lib.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    texts = [r.text for r in table(spark, SF, "documents", "text").collect()][:100]
    texts += ["", "a  b   c", " x ", "é\n\n中文 😀x", "\t\x00", "   "]
    v = CountViterbi(pieces)
    assert [v.text(t)[1] for t in texts] == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    got = {r.doc_id: r.n_pieces for r in token_counts(odd, pieces).collect()}
    assert got[1] == got[2] == 0 and got[3] == v.text("one")[1]


def test_token_counts_with_fractional_scores():
    """Ties that depend on rounding fall as in the library."""
    rng = np.random.default_rng(11)
    for _ in range(40):
        singles = ["▁", "a", "b", "c"]
        longer = {"".join(rng.choice(list("abc"), rng.integers(2, 5))) for _ in range(12)}
        pieces = [(p, -float(rng.integers(1, 60)) / 10) for p in singles + sorted(longer) + ["▁a", "▁ab", "▁▁"]]
        lib = Tokenizer(models.Unigram([("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)] + pieces, 0, True))
        lib.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
        texts = [" ".join("".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(rng.integers(1, 30)))
                 for _ in range(40)] + ["", " ", "a  b", "ab▁c d", " a"]
        counts, _ = CountViterbi(pieces).texts(pa.array([*texts, None]))
        want = [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)] + [0]
        assert counts.tolist() == want


def test_rows_of_one_id_are_linked_each_by_its_own_text(spark):
    a, z = " ".join(f"a{k}" for k in range(60)), " ".join(f"z{k}" for k in range(60))
    rows = [(1, a), (2, a + " tail"), (2, z), (3, z + " tail"), (4, "alone"), (4, "apart"), (5, ""), (5, None), (None, a), (4, "alone")]
    docs = spark.createDataFrame([(i, t, "g", 0) for i, t in rows], "doc_id long, text string, group string, row int")
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()), key=repr)
    assert out == sorted([(1, 56, 1), (2, 57, 1), (2, 56, 2), (3, 57, 2), (4, 1, 4), (4, 1, 4), (4, 1, 4), (5, 0, 5), (5, 0, 5),
                          (None, 56, None)], key=repr)
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0
    stay = jaccard_stage(spark, docs, SF)
    assert stay.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in stay.collect()), key=repr) == sorted(
        [(1, a), (2, z), (4, "alone"), (4, "apart"), (5, ""), (None, a)], key=repr)


def test_a_contaminated_row_goes_whatever_its_id(spark):
    item = table(spark, SF, "benchmark", "text").first()[0]
    clean = table(spark, "/root/testdata/sf0.001", "documents", "text").first()[0]
    rows = [(None, item), (1, item), (1, "something else here"), (2, None), (3, ""), (None, "nothing of it")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, item_id string")
    got = sorted(((r.doc_id, r.text) for r in decontamination_stage(spark, docs, SF).collect()), key=repr)
    assert clean and got == sorted([(1, "something else here"), (2, None), (3, ""), (None, "nothing of it")], key=repr)


def test_every_vector_is_a_row_of_its_own(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0, 0.1]), (4, [1.0, 0.0, 0.0]), (5, [2.0, 0.0, 0.0]), (6, [0.0, 1.0]),
            (6, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [-1.0, 0.0]), (7, None), (8, [0.0, 0.0]), (9, [None, 1.0]), (10, [])]
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id long, embedding array<double>, key int, n int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.near_duplicates(df, 0.95).collect()), key=repr)
    want = [(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (4, 1, 4, True), (5, 1, 4, False), (6, 0, 6, True), (6, 4, 1, False),
            (None, 4, 1, False), (None, 0, None, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True)]
    assert got == sorted(want, key=repr)


def test_components_that_do_not_settle_are_refused(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="settle"):
        min_label_components(chain, max_rounds=1)


def test_lines_of_one_text_in_proportion(spark):
    lines = [f"line {k} of very many" for k in range(30_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[100:200]))]
    out = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: (30_000, 0), 2: (100, 100)}


FOREIGN = """
import sys, os
os.chdir("/")
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1200]").config("spark.ui.enabled", "false").config(
    "spark.executor.memory", "1100m").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
sys.path.remove(sys.argv[1])
for name in ("op2_token_counts", "op5_decontamination", "op6_toxicity", "op8_quality", "op11_language_id", "op12_hard_negatives", "op13_spelling"):
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_executors_need_no_installed_package(tmp_dir):
    """A driver elsewhere, executors in processes of their own without the
    package on their path."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" or here not in v}
    got = subprocess.run([sys.executable, "-c", FOREIGN, here, tmp_dir], env=env, cwd="/", capture_output=True, text=True, timeout=600)
    assert got.returncode == 0, got.stderr[-3000:]
    assert len(got.stdout.strip().splitlines()) == 7


def test_jaccard_matches_brute_force(spark, odd):
    docs = table(spark, SF, "documents", "doc_id", "text")
    sets = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        sets[r.doc_id] = {tuple(x.lower() for x in w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    label = {i: i for i in sets}
    ids = sorted(sets)
    for _ in range(4):
        for i in ids:
            for j in ids:
                a, b = sets[i], sets[j]
                if i != j and a and 100 * len(a & b) >= 85 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, 4, "0.85").collect()}
    assert got == label
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd, 5, "0.8").collect()}
    assert out[1] == (0, 1) and out[2] == (0, 2) and out[3] == (1, 3) and out[5] == (5, 4) and out[None][1] is None


def test_band_plans_keep_the_pigeonhole():
    t = jaccard.Fraction("0.85")
    for low, high in jaccard.bands(3000, t):
        m, r = jaccard.plan_band(low, high, t)
        assert r <= m and m + r >= jaccard.most_different(high, t) + 1


def test_cover_tree_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8))
    x = np.concatenate([x, x[:60] + rng.normal(size=(60, 8)) * 0.05, np.repeat(x[:1], 40, 0), x[:1] * 5])
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8),
                                                         (903, [1.0, None] * 4), (904, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(label, np.where(hit, label[None, :], len(x)).min(1))
        if (new == label).all():
            break
        label = new
    got = cover_tree.near_duplicates(df, 0.95, chunk=100).toPandas().set_index("vec_id").sort_index()
    assert (got.n_links[:len(x)].to_numpy() == hit.sum(1)).all()
    assert (got.component_id[:len(x)].to_numpy() == label).all()
    assert (got.n_links[900:] == 0).all() and got.kept[900:].all()
    assert cover_tree.near_duplicates(df.limit(0), 0.95).count() == 0


def test_decontamination_finds_every_copy(spark, odd):
    docs, items = table(spark, SF, "documents", "doc_id", "text"), table(spark, SF, "benchmark", "item_id", "text")
    texts, its = docs.collect(), items.collect()
    want = {(d.doc_id, i.item_id) for d in texts for i in its if i.text in d.text}
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert want and want <= got and len(got - want) <= 2
    parts = {(r.doc_id, r.item_id) for r in contaminated(docs, items, part_bytes=2000).collect()}
    assert want <= parts
    assert contaminated(odd, items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0


def test_classifiers_on_held_out_rows(spark, odd):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels").toPandas()
    got = quality.op8_quality(spark, sf).toPandas().merge(labels, on="doc_id")
    held = got[got.held_out]
    assert ((held.score >= 0.5) == (held.quality == 1)).mean() > 0.9
    tox = toxicity.op6_toxicity(spark, sf).toPandas().merge(labels, on="doc_id")
    held = tox[tox.held_out]
    assert held[held.toxic == 1].score.mean() > held[held.toxic == 0].score.mean() + 0.2
    assert (held[held.toxic == 0].predicted == 0).mean() > 0.95
    none = label_rows(table(spark, sf, "labels").limit(0), "quality", F.lit(True))
    assert quality.fit_quality(docs, none) == 0.5 and toxicity.fit_toxicity(docs, none) == 0.0
    assert quality.quality_scores(odd, 0.5).count() == toxicity.toxicity_scores(odd, 0.0).count() == len(ODD)


def test_sharding_keeps_groups_and_levels_bytes(spark, odd):
    docs = table(spark, SF, "documents", "doc_id", "text")
    out = sharding.pack(docs, 8).toPandas()
    sizes = out.groupby("shard")["size"].sum()
    assert len(out) == docs.count() and sizes.max() - sizes.min() <= out["size"].max()
    assert (out.groupby("text_crc32").shard.nunique() == 1).all()
    assert all(sorted(s) == list(range(len(s))) for _, s in out.groupby("shard").slot)
    assert sharding.pack(odd, 3).count() == len(ODD) and sharding.pack(odd.limit(0), 3).count() == 0
    fixed = sharding.pack_capacity(docs, 100_000).toPandas().groupby("shard")["size"].agg(["sum", "max"])
    assert ((fixed["sum"] <= 100_000) | (fixed["sum"] == fixed["max"])).all()
    sizes = sorted(np.random.default_rng(1).integers(1, 50, 300).tolist(), reverse=True)
    bins = sharding.best_fit(sizes, [], grow=100)
    assert pd.Series(sizes).groupby(bins).sum().max() <= 100 and max(bins) + 1 <= 1.1 * sum(sizes) / 100 + 1


def test_bpe_matches_the_library(spark, odd):
    lib = Tokenizer.from_file(BPE)
    docs = table(spark, SF, "documents", "doc_id", "text").unionByName(odd.filter("doc_id > 5 or doc_id < 3")
                                                                       .select(F.col("doc_id") + 10_000, "text")
                                                                       .toDF("doc_id", "text"))
    got = {r.doc_id: r for r in encode_decode(docs, BPE, block_words=5000).collect()}
    for r in docs.collect():
        e = lib.encode(r.text or "", add_special_tokens=False)
        assert hashlib.sha256(np.array(e.ids, "<u4").tobytes()).digest() == hashlib.sha256(got[r.doc_id].ids).digest()
        assert got[r.doc_id].decoded == lib.decode(e.ids, skip_special_tokens=False)
    assert encode_decode(odd.limit(0), BPE).count() == 0


def test_bpe_on_every_letter_of_the_basic_plane():
    lib = Tokenizer.from_file(BPE)
    with open(BPE, encoding="utf-8") as f:
        own = WordBpe(f.read())
    texts = [f"a{chr(c)}B {chr(c)}" for c in range(0x2000)]
    import unicodedata
    for t, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False), strict=True):
        if unicodedata.category(t[1]) != "Cn":
            assert e.ids == [i for s in words_of(t) for w in own.words(s) for i in own.word_ids(w)], hex(ord(t[1]))


def test_url_filter(spark):
    rows = [(1, "http://WWW.Example.com:80/x"), (2, "https://a.b.example.com/en/1"), (3, None), (4, "no scheme"),
            (5, "x://net/es/?q"), (6, "x://example.com./en/"), (7, "http://notexample.com/en/"), (8, "http://com"),
            (9, "http://www.example.com/en/#a"), (9, "http://www.example.com/en/#a"), (None, "http://x.net/fr/")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string")
    rules = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block"),
                                   ("www.example.com", "/en/", "allow"), ("net", "/fr/", "block")],
                                  "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(pages, rules).collect()}
    assert got[1] == ("www.example.com:80", "/x", None, "allow")
    assert got[2][2:] == ("example.com/en/", "block") and got[9][2:] == ("www.example.com/en/", "allow")
    assert got[3] == ("", "", None, "allow") and got[4][0] == "" and got[5][2:] == ("net/es/", "block")
    assert got[6][2] is None and got[7][2:] == ("com/", "allow") and got[8][2] is None and got[None][3] == "block"
    assert url_filter(pages, rules).count() == len(rows) and url_filter(pages.limit(0), rules).count() == 0


def test_pipeline_stages(spark, odd):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, SF))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < docs.count() <= n
        n = docs.count()
    odd_docs = odd
    for _, stage in corpus_pipeline.STAGES:
        odd_docs = corpus_pipeline.written(stage(spark, odd_docs, SF))
    assert {r.doc_id for r in odd_docs.collect()} <= {i for i, _ in ODD}
