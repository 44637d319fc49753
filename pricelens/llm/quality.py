"""Quality by attention-based multiple-instance learning.

A document is a bag of passages (stretches of ``PASSAGE`` bytes of its whole
text), labelled as a whole.  A passage is described by the shares of its byte
classes and of hashed pairs of neighbouring classes, and by the share of
distinct words; an encoder h = tanh(W x + b) turns it into ``HIDDEN`` numbers.
Gated attention a = softmax(w . (tanh(V h) * sigmoid(U h))) weighs the passages,
and the score is sigmoid(c . sum(a h) + d).  All weights are learned together
from document labels with Adam in numpy.

The model is fitted on at most ``SAMPLE`` labelled documents of each label (the
smallest hashes of the id) and weighted back to the labels' own shares, a
documented bound; scoring reads every whole text in one map pass without a
shuffle.  Labels of held-out rows are never read into the fit, and only the
text is an input of the score.

Null text counts as empty; an empty text is one passage of zeros and gets the
model's score for it.  Without labels the score is 0.5, with a single label its
share (0 or 1).  Repeated ids give one row each; an empty table no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import held_out, shared, table
from pricelens.llm.labelled import hashed_sample, label_rows
from pricelens.llm.shingles import mix, word_hashes

PASSAGE = 512
PAIRS = 96
HIDDEN, GATE = 24, 12
SAMPLE = 1500
EPOCHS, RATE, DECAY = 250, 0.02, 1e-4
THRESHOLD = 0.7


def byte_classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, line end, each ASCII
    sign of its own, other control, UTF-8 continuation and lead bytes."""
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    out = np.full(256, 5, np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 192:
            out[b] = 7
        elif b >= 128:
            out[b] = 6
        elif c.islower():
            out[b] = 0
        elif c.isupper():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        elif c == " ":
            out[b] = 3
        elif c == "\n":
            out[b] = 4
        elif b in signs:
            out[b] = 8 + signs.index(b)
    return out


CLASSES = byte_classes()
N_CLASSES = int(CLASSES.max()) + 1
PAIR_BIN = (mix(np.arange(N_CLASSES * N_CLASSES, dtype=np.uint64) + np.uint64(1)) % np.uint64(PAIRS)).astype(np.int64)
WIDTH = N_CLASSES + PAIRS + 1


def passages(text: str | None) -> np.ndarray:
    """One row of features for each stretch of the text (at least one)."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-len(raw) // PASSAGE))
    out = np.zeros((n, WIDTH), np.float32)
    if not len(raw):
        return out
    kind = CLASSES[raw]
    at = np.arange(len(raw)) // PASSAGE
    sizes = np.bincount(at, minlength=n)[:, None]
    out[:, :N_CLASSES] = np.bincount(at * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, -1) / sizes
    pair = PAIR_BIN[kind[:-1] * N_CLASSES + kind[1:]]
    out[:, N_CLASSES:-1] = np.bincount(at[:-1] * PAIRS + pair, minlength=n * PAIRS).reshape(n, -1) / sizes
    words = word_hashes(text)
    out[:, -1] = len(np.unique(words)) / max(1, len(words))
    return np.sqrt(out)


class AttentionMil:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"W": r.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)) * 4, "b": np.zeros(HIDDEN),
                  "V": r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
                  "U": r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, GATE)),
                  "w": r.normal(0, 1 / np.sqrt(GATE), GATE), "c": r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
                  "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)

    def forward(self, x: np.ndarray, starts: np.ndarray):
        """Bag scores; ``starts`` is the first row of each bag."""
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        sizes = np.diff(np.append(starts, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return s, (x, h, t, g, a, z, sizes)

    def gradient(self, y, weight, starts, s, kept):
        x, h, t, g, a, z, sizes = kept
        p, n = self.p, weight.sum()
        ds = (s - y) * weight / n
        dz = ds[:, None] * p["c"]
        dz_rows = np.repeat(dz, sizes, axis=0)
        da = (dz_rows * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz_rows + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - h * h)
        return {"W": x.T @ dpre, "b": dpre.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
                "c": z.T @ ds, "d": np.array([ds.sum()])}

    def fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> AttentionMil:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        for step in range(1, EPOCHS + 1):
            s, kept = self.forward(x, starts)
            for k, grad in self.gradient(y, weight, starts, s, kept).items():
                grad = grad + DECAY * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                self.p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def _bags(texts) -> tuple[np.ndarray, np.ndarray]:
    rows = [passages(t) for t in texts]
    return np.concatenate(rows), np.cumsum([0, *map(len, rows)])[:-1]


def fit_quality(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> AttentionMil | float:
    """A model fitted on at most ``sample`` documents of each label, or a fixed
    score where there is nothing to tell apart.  ``docs`` has doc_id and text,
    ``labelled`` doc_id and label."""
    shares = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0.5))
    chosen = hashed_sample(labelled.filter("label = 0"), sample).unionByName(
        hashed_sample(labelled.filter("label = 1"), sample))  # at most 2 * sample ids

    def features(batches):
        for b in batches:
            rows = [passages(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.astype("<f2").tobytes() for r in rows],
                                                                    pa.binary())], ["label", "x"])
    got = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
           .mapInArrow(features, "label int, x binary").collect())
    if len({r["label"] for r in got}) < 2:
        return float(max(shares, key=shares.get)) if got else 0.5
    rows = [np.frombuffer(r["x"], "<f2").reshape(-1, WIDTH).astype(np.float64) for r in got]
    y = np.array([r["label"] for r in got], float)
    part = np.array([np.mean(y == k) for k in (0, 1)])
    true = np.array([shares[k] for k in (0, 1)]) / sum(shares.values())
    weight = (true / part)[y.astype(int)]
    return AttentionMil().fit(np.concatenate(rows), np.cumsum([0, *map(len, rows)])[:-1], y, weight)


def quality_score(spark, model: AttentionMil | float):
    """A function of a text column that gives its score."""
    held = shared(spark, model)  # a few thousand numbers

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m, out = held(), []
        for k in range(0, len(texts), 256):
            part = texts.iloc[k:k + 256]
            out.append(np.full(len(part), m) if isinstance(m, float) else m.forward(*_bags(part))[0])
        return pd.Series(np.concatenate(out) if out else np.zeros(0))
    return score


def quality_scores(docs: DataFrame, model: AttentionMil | float, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, each from its whole text."""
    score = quality_score(docs.sparkSession, model)
    return docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col).cast("string")).alias("score"))


def op8_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = held_out(F.col("doc_id"), 4, 2)
    model = fit_quality(docs, label_rows(table(spark, sf_dir, "labels", "doc_id", "quality"), "quality", ~out))
    return quality_scores(docs, model).select("doc_id", out.alias("held_out"), "score",
                                              (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
