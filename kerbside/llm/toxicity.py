"""Toxicity: non-negative positive-unlabelled learning (Kiryo et al., 2017).

A linear classifier on words and word beginnings is trained from confirmed
toxic texts (positives) and a sample of all texts (unlabelled). With the class
prior p, the risk on negatives is estimated as the unlabelled risk minus p
times the positives' risk; where a batch drives this below zero, the step
undoes the overfit instead. Texts that are marked as not toxic take no part.

A quarter of both samples is set apart. On it the prior is the least ratio of
the unlabelled texts to the positives among those that score above some
threshold, as the positives alone are there where the classifier is sure (Garg et
al., 2021), and the scores are made probabilities by the scale and shift of
least risk, which for the logistic loss is a convex problem.

Fitting takes bounded samples (arguments of :func:`train`) whose features are made on
the executors; scoring covers all texts, one pass, no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import bounded_sample, text_of

POSITIVES = 4_000
UNLABELLED = 8_000
# Every so manieth row of both samples is set apart, and the prior of the first fit.
APART = 4
FIRST_PRIOR = 0.2
WIDTH = 1 << 18
PREFIX = 4
# Features of fewer positives are left out, and weights are drawn to zero by L1: a
# long text has thousands of words, whose small weights would add up.
LEAST_POSITIVES = 5
EPOCHS = 20
BATCHES = 6
RATE = 0.1
L1 = 0.1
L2 = 1e-4
EDGES = ".,;:!?\"'()[]{}*#$%&|<>-_"
# Words whose scores a worker remembers.
REMEMBERED = 500_000


def tokens(text: str) -> set[str]:
    """Distinct lower-cased words without punctuation at their ends."""
    found = {w.strip(EDGES) for w in text.lower().split()}
    found.discard("")
    return found


def features(token: str) -> tuple[int, int]:
    """Hashed features of a word: itself, and how it begins."""
    raw = token.encode("utf-8", "surrogatepass")
    start = b"^" + token[:PREFIX].encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) % WIDTH, zlib.crc32(start) % WIDTH


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def token_score(self, token: str) -> float:
        a, b = features(token)
        return float(self.weights[a] + self.weights[b])


def _spread(n: int) -> float:
    """Scale of a text's features: long texts add up many small weights."""
    return 1.0 / np.sqrt(max(n, 1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk_slope(z: np.ndarray, is_p: np.ndarray, prior: float) -> np.ndarray:
    """Derivative of a batch's risk by each text's logit.

    The risk is p times the loss of positives as positives, plus the risk on negatives: the
    loss of unlabelled texts as negatives less p times that of positives. Where the
    latter is below zero, the step goes up its own slope.
    """
    n_p, n_u, sig = is_p.sum(), (~is_p).sum(), _sigmoid(z)
    as_negative = np.logaddexp(0, z)
    rest = as_negative[~is_p].mean() - prior * as_negative[is_p].mean()
    up = np.where(is_p, prior * (sig - 1) / n_p, 0)
    down = np.where(is_p, -prior * sig / n_p, sig / n_u)
    return up + down if rest >= 0 else -down


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed=7) -> Model:
    """Minimise the non-negative risk of a logistic loss by Adam with soft thresholds.

    Each text is an array with two hashed features per distinct word. Without
    positives everything scores the prior.
    """
    common = np.zeros(WIDTH, int)
    for text in positive:
        common[np.unique(text)] += 1
    usable = common >= LEAST_POSITIVES
    weights, bias = np.zeros(WIDTH), float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(weights.astype(np.float32), bias)
    rng = np.random.default_rng(seed)
    mean, var, step = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1), 0
    for _ in range(EPOCHS):
        orders = [rng.permutation(len(x)) for x in (positive, unlabelled)]
        parts = [np.array_split(o, BATCHES) for o in orders]
        for p_rows, u_rows in zip(*parts, strict=True):
            if not len(p_rows) or not len(u_rows):
                continue
            texts = [positive[i] for i in p_rows] + [unlabelled[i] for i in u_rows]
            scale = np.array([_spread(len(t) / 2) for t in texts])
            texts = [t[usable[t]] for t in texts]
            at = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            index = np.concatenate(texts)
            z = np.bincount(at, weights[index], len(texts)) * scale + bias
            slope = risk_slope(z, np.arange(len(texts)) < len(p_rows), prior)
            grad = np.bincount(index, (slope * scale)[at], WIDTH)
            grad = np.append(grad + L2 * weights, slope.sum())
            step += 1
            mean += 0.1 * (grad - mean)
            var += 0.001 * (grad**2 - var)
            move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.999**step)) + 1e-8)
            weights -= move[:-1]
            weights = np.sign(weights) * np.maximum(np.abs(weights) - L1 * RATE, 0)
            bias -= move[-1]
    return Model(weights.astype(np.float32), float(bias))


def _logits(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    return np.array([model.weights[t].sum() * _spread(len(t) / 2) + model.bias for t in texts])


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled texts, from the logits of both.

    Above any threshold the unlabelled texts number at least the prior's share of the
    positives there; the threshold is taken where that bound is least, with a margin
    for the size of the samples.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.7, 69))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    margin = np.sqrt(np.log(10) / 2) * (1 / np.sqrt(len(unlabelled)) + 1 / np.sqrt(len(positive)))
    best = int(np.argmin((u + margin) / p))
    return float(np.clip(u[best] / p[best], 0.001, 0.999))


def calibrated(model: Model, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Scale and shift logits to the least risk on texts set apart, given their logits.

    For the logistic loss the risk is mean(log(1 + exp f)) over unlabelled less p times
    mean(f) over positives, which is convex in scale and shift.
    """
    centre, width = unlabelled.mean(), np.concatenate([positive, unlabelled]).std() + 1e-9
    rows = [np.column_stack([(z - centre) / width, np.ones(len(z))]) for z in (positive, unlabelled)]
    w, ridge = np.array([1.0, float(np.log(prior / (1 - prior)))]), np.diag([1e-3, 1e-4])
    for _ in range(100):
        q = _sigmoid(rows[1] @ w)
        bend = np.maximum(q * (1 - q), 1e-4)[:, None]
        slope = (rows[1] * q[:, None]).mean(axis=0) - prior * rows[0].mean(axis=0) + ridge @ w
        move = np.linalg.solve((rows[1] * bend).T @ rows[1] / len(unlabelled) + ridge, slope)
        w = w - move * min(1.0, 2 / (np.abs(move).max() + 1e-9))
    scale = w[0] / width
    return Model((model.weights * scale).astype(np.float32), float(model.bias * scale + w[1] - scale * centre))


def fit_and_calibrate(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> Model:
    """A first fit gives the prior, a second one uses it; both kinds of rows set apart calibrate it."""
    apart = [[t for k, t in enumerate(x) if k % APART == 0] for x in (positive, unlabelled)]
    others = [[t for k, t in enumerate(x) if k % APART] for x in (positive, unlabelled)]
    if not all(others):
        return fit([], [], 0.5)
    model, prior = None, FIRST_PRIOR
    for _ in range(2):
        model = fit(*others, prior)
        logits = [_logits(model, x) for x in apart]
        prior = class_prior(*logits)
    return calibrated(model, *logits, prior)


def held_out(column: str = "doc_id"):
    """True for the fifth of the rows whose labels are never learnt from."""
    name = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 5 == 0


def _featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        made = [[i for t in sorted(tokens(x)) for i in features(t)] for x in rows["text"]]
        packed = [np.array(m, np.int32).tobytes() for m in made]
        yield pd.DataFrame({"use": rows["use"], "index": packed})


def train(
    docs: DataFrame, labels: DataFrame, *, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> Model:
    """Fit on samples of at most so many rows, none of them held out.

    An id is toxic if any of its labels says so; of rows that share an id the first
    by text is used. Rows without an id are not sampled. Without positives everything scores 0.5.
    """
    marked = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic = 1").select("doc_id")
    free = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    known = bounded_sample(marked, positives, "toxic").withColumn("use", F.lit("positive"))
    ids = known.unionByName(bounded_sample(free, unlabelled, "free").withColumn("use", F.lit("unlabelled")))
    # At most positives + unlabelled ids are broadcast.
    chosen = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id")
    chosen = chosen.groupBy("doc_id", "use").agg(F.min("text").alias("text"))
    made = chosen.mapInPandas(_featurise, "use string, index binary").toPandas()
    made["key"] = [(zlib.crc32(i), len(i)) for i in made["index"]]
    made = made.sort_values(["use", "key"])  # rows arrive in any order
    arrays = {u: [np.frombuffer(i, np.int32) for i in rows["index"]] for u, rows in made.groupby("use")}
    return fit_and_calibrate(arrays.get("positive", []), arrays.get("unlabelled", []))


_scores: dict[str, float] = {}
_scored_by: list = [None]


def score_texts(texts, weights: bytes, bias: float) -> np.ndarray:
    """Probabilities of toxicity; the worker remembers the scores of words."""
    tag = zlib.crc32(weights)
    if _scored_by[0] != tag or len(_scores) > REMEMBERED:  # a worker may serve another model next
        _scores.clear()
        _scored_by[0] = tag
    model = Model(np.frombuffer(weights, np.float32), bias)
    z = []
    for text in texts:
        found = sorted(tokens(text))  # sums in an order that reruns repeat
        total = 0.0
        for t in found:
            value = _scores.get(t)
            if value is None:
                value = _scores[t] = model.token_score(t)
            total += value
        z.append(total * _spread(len(found)) + bias)
    return 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts get the bias alone; equal texts get equal scores;
    other columns are ignored.
    """
    weights, bias = model.weights.tobytes(), model.bias

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(texts, weights, bias))

    made = docs.select("doc_id", scored(text_of()).alias("score"))
    return made.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
