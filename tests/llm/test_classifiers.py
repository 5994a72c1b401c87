"""The learning methods themselves: risk, prior, calibration, co-training, samples, robust estimates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import quality_classifier, quality_rules, toxicity
from kerbside.llm.common import bounded_sample


def risk(z, is_p, prior):
    positive = np.logaddexp(0, -z[is_p]).mean()
    negative = np.logaddexp(0, z[~is_p]).mean() - prior * np.logaddexp(0, z[is_p]).mean()
    return prior * positive, negative


@pytest.mark.parametrize("shift", [0.0, -6.0])
def test_slope_is_the_derivative_of_the_non_negative_risk(shift):
    rng = np.random.default_rng(1)
    z, is_p = rng.normal(size=12), np.arange(12) < 5
    z[~is_p] += shift  # far down, the risk on negatives is below zero
    up, down = risk(z, is_p, 0.6)
    assert (down < 0) == (shift < 0)
    got = toxicity.risk_slope(z, is_p, 0.6)
    for k in range(12):
        step = np.zeros(12)
        step[k] = 1e-6
        high, low = risk(z + step, is_p, 0.6), risk(z - step, is_p, 0.6)
        want = (sum(high) - sum(low)) / 2e-6 if down >= 0 else -(high[1] - low[1]) / 2e-6
        assert got[k] == pytest.approx(want, abs=1e-7)


@pytest.mark.parametrize("prior", [0.03, 0.1, 0.3])
def test_prior_from_positives_and_unlabelled(prior):
    rng = np.random.default_rng(2)
    positive = rng.normal(3, 1, 1000)
    mixed = np.where(rng.random(2000) < prior, rng.normal(3, 1, 2000), rng.normal(-2, 1, 2000))
    assert toxicity.class_prior(positive, mixed) == pytest.approx(prior, abs=0.02)


def test_calibration_without_clean_marks():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.2
    z = np.where(truth, rng.normal(2, 1, 20_000), rng.normal(0, 1, 20_000))
    positive = rng.normal(2, 1, 5000)
    start = toxicity.Model(np.array([1.0], np.float32), 5.0)
    model = toxicity.calibrated(start, 3 * positive + 5, 3 * z + 5, 0.2)
    p = 1 / (1 + np.exp(-(float(model.weights[0]) * 3 * z + model.bias)))
    for low in np.arange(0.1, 0.9, 0.2):
        here = (p >= low) & (p < low + 0.2)
        assert truth[here].mean() == pytest.approx(p[here].mean(), abs=0.05)


def test_clean_marks_take_no_part(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join([*rng.choice([f"w{i}" for i in range(200)], 30), *(["vile", "crude"] if k % 6 == 0 else [])])) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(0, 1200)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    only_toxic = toxicity.train(docs, labels.where("toxic = 1"))
    assert (model.weights == only_toxic.weights).all() and model.bias == only_toxic.bias
    got = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() > 0.98


def test_views_teach_each_other():
    """What only unlabelled pages show reaches the text view through the other view."""
    rng = np.random.default_rng(5)

    def pages(n, new):
        y = rng.integers(0, 2, n).astype(float)
        known = np.where(new, 0.0, y + rng.normal(0, 0.2, n))
        hint = np.where(new, y + rng.normal(0, 0.1, n), rng.normal(0.5, 0.1, n))
        return y, np.column_stack([known, hint]), np.column_stack([y + rng.normal(0, 0.05, n), rng.normal(size=n)])

    y, text, meta = pages(200, False)
    _, pool_text, pool_meta = pages(2000, True)
    test_y, test_text, _ = pages(1000, True)
    right = {}
    for rounds in (0, 3):
        model = quality_classifier.co_train(text, meta, y, pool_text, pool_meta, rounds)
        right[rounds] = ((model.text.probability(test_text) > 0.5) == (test_y == 1)).mean()
    assert right[0] < 0.75 and right[3] > 0.95


def test_samples_are_bounded_and_repeat(spark):
    ids = spark.range(5000).select(F.col("id").alias("doc_id")).repartition(9)
    some = [r.doc_id for r in bounded_sample(ids, 300, "x").collect()]
    assert len(set(some)) == 300 and some == [r.doc_id for r in bounded_sample(ids.repartition(3), 300, "x").collect()]
    other = {r.doc_id for r in bounded_sample(ids, 300, "y").collect()}
    assert len(other & set(some)) < 60 and abs(np.mean(some) - 2500) < 400
    assert bounded_sample(ids, 9000).count() == 5000 and bounded_sample(ids.limit(0), 5).count() == 0


def test_nearly_half_of_a_group_may_be_copies_that_are_off(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.normal([1.6, 0.2, 0.2, 0.2], 0.05, (3000, 4))
    rows = []
    for name, share in (("a", 0.45), ("b", 0.48), ("c", 0.6)):
        off = rng.random(3000) < share
        z = np.where(off[:, None], [1.6, 1.2, 0.2, 0.2], x)
        rows += [(f"{name}{int(o)}", name, *map(int, np.round(r * quality_rules.SCALE))) for o, r in zip(off, z, strict=True)]
    path = f"{tmp_path}/rows"
    spark.createDataFrame(rows, ["kind", "grp", *quality_rules.FEATURES]).write.parquet(path)
    table = spark.read.parquet(path)
    est = quality_rules.fitted(table.drop("kind").distinct())
    got = quality_rules._with_distance(table, est).selectExpr("kind", f"d2 > {quality_rules.CUTOFF} as far")
    share = {r.kind: r.share for r in got.groupBy("kind").agg(F.avg(F.col("far").cast("int")).alias("share")).collect()}
    assert all(share[k] == 1 for k in ("a1", "b1", "c1")) and all(share[k] < 0.002 for k in ("a0", "b0", "c0"))


def test_small_groups_are_judged_by_their_language_or_all(spark, prose):
    rng = np.random.default_rng(7)
    pool = prose.split()

    def row(k, lang, source, bad=False):
        text = " ".join(w + ("%%##" if bad else "") for w in rng.choice(pool, 60))
        return k, f"{text} {k}", lang, source

    rows = [row(k, "en", "big") for k in range(60)] + [row(60 + k, "en", f"s{k}", k == 0) for k in range(4)]
    rows += [row(70 + k, f"l{k}", None, k == 0) for k in range(5)] + [(99, "few words", "en", "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert {got[k].level for k in range(60)} == {"source"} and {got[60 + k].level for k in range(4)} == {"language"}
    assert {got[70 + k].level for k in range(5)} == {"all"} and got[99].level is None
    assert [k for k, r in got.items() if not r.kept] == [60, 70, 99]
