"""Quality classifier by co-training (Blum and Mitchell, 1998).

Two logistic classifiers see different views of a page: the text view has
statistics of its content, the metadata view its language, source and stated
length. Both start from the same labelled rows. In each round every view labels
the pool of unlabelled pages; what one view is sure of joins the training rows
of the other. Each view is then calibrated on labelled rows that it did not
learn from, and the calibrated views are combined by a last logistic fit there,
so a view without information ends with no weight.

Fitting takes bounded samples (arguments of :func:`train`) of features made on the
executors; scoring covers all texts in one pass without a shuffle.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import bounded_sample, text_of
from kerbside.llm.toxicity import held_out

LABELLED = 12_000
POOL = 12_000
ROUNDS = 3
SURE = 0.98
SOURCES = 256
LANGS = 16

SYMBOLS = b"#*$%&|<>"
MARKS = b"!?"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"


def text_features(text: str) -> list[float]:
    """Shares of symbols, marks, capitals, digits and repeats; word statistics."""
    raw = text.encode("utf-8", "surrogatepass")
    found = raw.split()
    n, size = max(len(found), 1), max(len(raw), 1)
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = sum(map(operator.eq, found, found[1:])) / n
    distinct = len(set(found)) / n
    expected = n ** -0.12  # of ordinary prose, whose words repeat more the longer it is
    return [
        min(share(SYMBOLS) * 10, 1.0),
        min(share(MARKS) * 10, 1.0),
        share(CAPITALS),
        share(DIGITS),
        repeats,
        distinct,
        distinct - expected,
        1 - len(set(lines)) / max(len(lines), 1),
        min(size / n / 10, 3.0),
        float(np.log1p(len(found))) / 10,
        1.0 if not found else 0.0,
    ]


def meta_features(lang, source, n_chars) -> list[float]:
    """Places of the language and source in their tables, and the stated length."""
    place = lambda x, width: zlib.crc32(str(x).encode("utf-8", "surrogatepass")) % width
    known = n_chars is not None and n_chars == n_chars
    length = float(np.log1p(max(float(n_chars), 0.0))) / 10 if known else 0.0
    return [place(lang, LANGS), place(source, SOURCES), length, 0.0 if known else 1.0]


def _meta_matrix(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), LANGS + SOURCES + 2))
    every = np.arange(len(rows))
    out[every, rows[:, 0].astype(int)] = 1
    out[every, LANGS + rows[:, 1].astype(int)] = 1
    out[:, -2:] = rows[:, 2:]
    return out


@dataclass
class Logistic:
    """Standardised logistic regression with a ridge."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        """Newton steps; ``y`` may hold probabilities."""
        centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.hstack([(x - centre) / spread, np.ones((len(x), 1))])
        w = np.zeros(z.shape[1])
        penalty = ridge * np.eye(len(w))
        penalty[-1, -1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            bend = np.maximum(p * (1 - p), 1e-6)
            move = np.linalg.solve((z * bend[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
            w = w - move
            if np.abs(move).max() < 1e-6:
                break
        return cls(centre, spread, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.spread) @ self.weights[:-1] + self.weights[-1]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    text_scale: Logistic
    meta_scale: Logistic
    both: Logistic

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality: text view, metadata view, combined."""
        t = self.text_scale.probability(self.text.logit(text)[:, None])
        m = self.meta_scale.probability(self.meta.logit(meta)[:, None])
        pair = np.column_stack([_logit(t), _logit(m)])
        return t, m, self.both.probability(pair)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def co_train(text, meta, y, pool_text, pool_meta, rounds: int = ROUNDS) -> CoTrained | None:
    """Fit both views; every fourth labelled row only calibrates. None without both classes."""
    cal = np.arange(len(y)) % 4 == 0
    if len(np.unique(y[~cal])) < 2 or len(np.unique(y[cal])) < 2:
        return None
    given = {"text": text[~cal], "meta": meta[~cal]}
    pools = {"text": pool_text, "meta": pool_meta}
    # Rows of the pool that each view was taught by the other, and their labels.
    taught = {v: (np.array([], int), np.array([])) for v in given}
    models: dict[str, Logistic] = {}
    for _ in range(rounds + 1):
        for v in given:
            rows, labels = taught[v]
            x = np.vstack([given[v], pools[v][rows]])
            models[v] = Logistic.fit(x, np.append(y[~cal], labels))
        for v, other in (("text", "meta"), ("meta", "text")):
            if len(pools[v]):
                p = models[v].probability(pools[v])
                sure = np.nonzero((p > SURE) | (p < 1 - SURE))[0]
                taught[other] = (sure, (p[sure] > 0.5).astype(float))
    scales = {
        v: Logistic.fit(models[v].logit(x[cal])[:, None], y[cal])
        for v, x in (("text", text), ("meta", meta))
    }
    views = [
        _logit(scales[v].probability(models[v].logit(x[cal])[:, None]))
        for v, x in (("text", text), ("meta", meta))
    ]
    both = Logistic.fit(np.column_stack(views), y[cal])
    return CoTrained(models["text"], models["meta"], scales["text"], scales["meta"], both)


def _views(rows: pd.DataFrame) -> tuple[list, list]:
    text = [text_features(t) for t in rows["text"]]
    meta = [meta_features(*r) for r in zip(rows["lang"], rows["source"], rows["n_chars"], strict=True)]
    return text, meta


def _featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        text, meta = _views(rows)
        yield rows[["doc_id", "quality"]].assign(text=text, meta=meta)


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_of().alias("text"), "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))


def train(
    docs: DataFrame, labels: DataFrame, *, labelled: int = LABELLED, pool: int = POOL
) -> CoTrained | None:
    """Fit on samples of at most so many rows, the labelled ones not held out.

    An id is of the least quality that its labels give; of rows that share an id the
    first by text is used. Rows without an id are not sampled.
    """
    marked = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min("quality").cast("double").alias("quality"))
    known = bounded_sample(marked, labelled, "labelled")
    free = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    ids = known.unionByName(bounded_sample(free, pool, "pool").withColumn("quality", F.lit(-1.0)))
    # At most labelled + pool ids are broadcast.
    chosen = _columns(docs).join(F.broadcast(ids), "doc_id")
    rest = F.struct("text", "lang", "source", "n_chars")
    chosen = chosen.groupBy("doc_id", "quality").agg(F.min(rest).alias("row")).select("doc_id", "quality", "row.*")
    made = chosen.mapInPandas(
        _featurise, "doc_id long, quality double, text array<double>, meta array<double>"
    ).toPandas()
    made["tie"] = [tuple(t) for t in made["text"]]
    made = made.sort_values(["doc_id", "quality", "tie"])  # rows arrive in any order
    good = made[made["quality"] >= 0]
    pool_rows = made[made["quality"] < 0]
    if not len(good):
        return None
    stack = lambda x, width: np.array([list(v) for v in x], float).reshape(-1, width)
    n_text = len(text_features(""))
    return co_train(
        stack(good["text"], n_text), _meta_matrix(stack(good["meta"], 4)), good["quality"].to_numpy(),
        stack(pool_rows["text"], n_text), _meta_matrix(stack(pool_rows["meta"], 4)),
    )


def _scorer(model: CoTrained | None):
    @F.pandas_udf("score_text double, score_meta double, score double")
    def scored(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        names = ["score_text", "score_meta", "score"]
        if model is None or not len(text):
            return pd.DataFrame(0.5, index=range(len(text)), columns=names)
        rows = pd.DataFrame({"text": text, "lang": lang, "source": source, "n_chars": n_chars})
        views = [np.array(v, float) for v in _views(rows)]
        found = model.score(views[0], _meta_matrix(views[1]))
        return pd.DataFrame(dict(zip(names, found, strict=True)))

    return scored(text_of(), F.col("lang"), F.col("source"), F.col("n_chars").cast("double"))


def score(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """``doc_id, held_out, score_text, score_meta, score, predicted`` for every row.

    The score is the probability of good quality. Null text is empty; null
    metadata is a value of its own; without labels of both classes everything
    scores 0.5 and counts as good; other columns are ignored.
    """
    made = docs.select("doc_id", _scorer(model).alias("found")).select("doc_id", "found.*")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return made.select("doc_id", held_out().alias("held_out"), "score_text", "score_meta", "score", predicted)


def keep_good(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """Rows of ``docs`` that score 0.5 or more, unchanged, in the same pass as scoring."""
    scored = docs.withColumn("quality__found", _scorer(model))
    return scored.where("quality__found.score >= 0.5").select(*docs.columns)
