"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled text is drawn from
all documents, whatever their labels, so that it has the class prior.  A linear classifier over the presence of hashed words
(lower-cased, cut at white space and ASCII signs) and of word prefixes shared by
one, two or three distinct words of the text is trained in numpy on the
non-negative risk: with class prior p and logistic loss l,

    p E_pos[l(+)] + max(0, E_unl[l(-)] - p E_pos[l(-)]);

where the second term is negative it stops counting (Kiryo et al. 2017).
The prior is the share of toxic rows among the labels to learn from.  A first
pass keeps the words whose share among the positives exceeds that among the
unlabelled by the most standard errors, at least ``LEAST_GAIN`` (at most
``WORDS`` words).

The fit uses at most ``POSITIVES`` toxic and ``UNLABELLED`` documents of all (the
smallest hashes of the id), a documented bound.  Scoring reads every whole text
in one map pass without a shuffle.  Held-out labels are never read into the fit
(such documents may serve as unlabelled text); only the text is an input.

Null text counts as empty and gets the bias alone.  Without toxic labels the
score is 0.  Repeated ids give one row each;
an empty table no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import held_out, shared, table, written
from pricelens.llm.labelled import hashed_sample, label_rows
from pricelens.llm.shingles import word_and_prefix_hashes

POSITIVES, UNLABELLED = 1500, 3000
PREFIXES, LEVELS = (5, 6, 7, 8), 3
WORDS = 512
LEAST_SHARE, LEAST_GAIN = 0.01, 3.5
EPOCHS, RATE, DECAY = 400, 0.1, 1e-3
THRESHOLD = 0.7


def features(text: str | None) -> np.ndarray:
    """Distinct feature hashes of a text, sorted."""
    return word_and_prefix_hashes(text, PREFIXES, LEVELS)


class PuModel:
    """Sorted kept word hashes, their weights, a bias."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, bias: float):
        self.words, self.weights, self.bias = words, weights, bias

    def score(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.words, found)
        at[at == len(self.words)] = 0
        hit = self.words[at] == found if len(self.words) else np.zeros(len(found), bool)
        return float(1 / (1 + np.exp(-np.clip(self.weights[at[hit]].sum() + self.bias, -30, 30))))


def pu_risk(w: np.ndarray, b: float, xp: np.ndarray, xu: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """Non-negative risk of logistic losses and its gradient (weights, then
    bias): the share of unlabelled rows that the prior leaves to label 0 counts
    only while its estimate is not below zero."""
    n_p, n_u = len(xp), len(xu)
    sp, su = 1 / (1 + np.exp(-(xp @ w + b))), 1 / (1 + np.exp(-(xu @ w + b)))
    # logistic losses: l(+) has slope s - 1, l(-) has slope s
    gp_plus = np.append(xp.T @ (sp - 1), (sp - 1).sum()) / n_p
    gp_minus = np.append(xp.T @ sp, sp.sum()) / n_p
    gu_minus = np.append(xu.T @ su, su.sum()) / n_u
    negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
    risk = -prior * np.log(np.maximum(sp, 1e-12)).mean() + max(0.0, negative)
    return float(risk), prior * gp_plus + (gu_minus - prior * gp_minus if negative >= 0 else 0)


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> PuModel:
    n_p, n_u = len(positive), len(unlabelled)
    words, n = np.unique(np.concatenate(positive), return_counts=True)
    p = n / n_p
    words, p = words[p >= LEAST_SHARE], p[p >= LEAST_SHARE]
    flat = np.concatenate(unlabelled) if n_u else np.zeros(0, np.uint64)
    at = np.searchsorted(words, flat)
    at[at == len(words)] = 0
    hit = words[at] == flat if len(words) else np.zeros(len(flat), bool)
    u = np.bincount(at[hit], minlength=len(words)) / max(1, n_u)
    gain = (p - u) / np.sqrt(p * (1 - p) / n_p + u * (1 - u) / max(1, n_u) + 1e-9)
    best = np.argsort(-gain, kind="stable")[:WORDS]
    best = np.sort(best[gain[best] >= LEAST_GAIN])
    words = words[best]

    def matrix(rows):
        x = np.zeros((len(rows), len(words)), np.float32)
        for k, r in enumerate(rows):
            x[k] = np.isin(words, r, assume_unique=True)
        return x
    xp, xu = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(len(words)), -2.0
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, EPOCHS + 1):
        grad = pu_risk(w, b, xp, xu, prior)[1]
        grad[:-1] += DECAY * w
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = np.maximum(0, w - move[:-1]), b - move[-1]  # kept words speak for toxicity only
    return PuModel(words, w, float(b))


def fit_toxicity(docs: DataFrame, labelled: DataFrame, positives: int = POSITIVES,
                 unlabelled: int = UNLABELLED) -> PuModel | float:
    """``docs`` has doc_id and text, ``labelled`` doc_id and label (1 toxic)."""
    labelled = written(labelled)
    shares = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not shares.get(1):
        return 0.0
    prior = min(0.9, shares[1] / sum(shares.values()))
    toxic = hashed_sample(labelled.filter("label = 1").select("doc_id"), positives)
    others = docs.select("doc_id").filter("doc_id is not null").distinct()
    chosen = toxic.withColumn("label", F.lit(1)).unionByName(
        hashed_sample(others, unlabelled).withColumn("label", F.lit(0)))  # at most positives + unlabelled ids

    def hashed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([features(t.as_py()).tobytes() for t in b.column(1)], pa.binary())],
                ["label", "x"])
    got = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
           .mapInArrow(hashed, "label int, x binary").collect())
    rows = {k: [np.frombuffer(r["x"], np.uint64) for r in got if r["label"] == k] for k in (0, 1)}
    if not rows[1] or not rows[0]:
        return prior
    return fit_pu(rows[1], rows[0], prior)


def toxicity_scores(docs: DataFrame, model: PuModel | float, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, each from its whole text."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = shared(docs.sparkSession, model)  # at most WORDS hashes and weights

    def run(batches):
        m = held()
        for b in batches:
            s = [m if isinstance(m, float) else m.score(features(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def op6_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = held_out(F.col("doc_id"), 3, 1)
    model = fit_toxicity(docs, label_rows(table(spark, sf_dir, "labels", "doc_id", "toxic"), "toxic", ~out))
    return toxicity_scores(docs, model).select("doc_id", out.alias("held_out"), "score",
                                               (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
