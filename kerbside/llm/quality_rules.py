"""Quality rules: fixed base rules, then robust outlier rejection per language and source.

The statistics of a document form a vector. In each group (language, source)
the minimum covariance determinant estimate of its mean and covariance is
found by concentration steps: from the current estimate take the half of the
rows that are nearest by Mahalanobis distance, estimate again, and repeat
(Rousseeuw and Van Driessen, 1999). Several starts run side by side, as groups
of their own: all rows, medians with median deviations, and small subsets
chosen by hash; the one of least determinant is taken. Rows beyond a fixed
quantile of the chi-squared distribution are rejected. Equal vectors count once:
copies have no spread, so a half made of them would have the least determinant.

Each step is one grouped sum of products, combined before the shuffle, and one
join with the groups' estimates. The nearest half is read from a histogram of
distances with fixed bins, so nothing is sorted and a group may hold any share
of all rows. Vectors are rounded to integers, so sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import WORD, materialize, text_of, words

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
# Vectors are kept in units of 1/SCALE.
SCALE = 10_000
# Least standard deviation of each feature, in its transformed unit. Most documents
# have no symbol and no repeated line; without a floor any single one would be far out.
FLOORS = (0.02, 0.1, 0.1, 0.15)
# Words of PRIOR_LENGTH characters that the mean word length starts from: that of a few
# words varies too much to tell anything.
PRIOR_WORDS, PRIOR_LENGTH = 20, 5
STEPS = 5
# Starts from subsets of about SUBSET_ROWS rows, besides all rows and medians.
SUBSETS, SUBSET_ROWS = 4, 10
STARTS = 2 + SUBSETS
# Standard deviation over median absolute deviation, for normal rows.
MAD = 1.4826
# 0.9999 quantile of chi-squared with 4 degrees of freedom.
CUTOFF = 23.513
# Consistency of a covariance from the nearest half in 4 dimensions, for normal rows:
# 0.5 / P(chi-squared with 6 degrees <= the 0.5 quantile with 4).
CONSISTENCY = 0.5 / 0.23707
# Least rows of a group that is judged by itself: five for each dimension.
MIN_GROUP = 20
# Bins of ln(squared distance), of width 1/BIN.
BIN = 32


def _repeated_words(rows: DataFrame) -> DataFrame:
    """Replace ``windows`` by ``n_repeat_words``: words in windows found twice or more.

    Only rows with a repeated window are sorted. Every step is a column of its
    own, because lambdas would evaluate a nested expression once per element.
    """
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("ordered", F.when(repeated, F.sort_array(placed)))
    like_neighbour = lambda x, j: (
        (F.get(F.col("ordered"), j - 1)["h"] == x["h"])
        | (F.get(F.col("ordered"), j + 1)["h"] == x["h"])
    )
    rows = rows.withColumn("doubled", F.filter("ordered", like_neighbour))
    rows = rows.withColumn("starts", F.sort_array(F.transform("doubled", lambda x: x["i"])))
    covered = F.transform(
        "starts",
        lambda s, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), j + 1) - s, F.lit(WINDOW))
        ),
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda x, y: x + y)
    rows = rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))
    return rows.drop("windows", "ordered", "doubled", "starts")


def base_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts that the base rules need."""
    rows = docs.select("doc_id", "lang", "source", text_of().alias("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    rows = rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    count = F.size("hashes") - (WINDOW - 1)
    first = F.when(count > 0, F.slice("hashes", F.lit(1), count))
    windows = F.transform(
        F.coalesce(first, F.array().cast("array<bigint>")),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("hashes"), i + k) for k in range(1, WINDOW)]),
    )
    rows = rows.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    return _repeated_words(rows)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def feature_vector() -> list[Column]:
    """Transformed statistics in units of 1/SCALE.

    The log of the mean word length, and the square roots, which even out the
    spread of counts, of symbols, repeated lines and repeated words per word.
    """
    n = F.greatest(F.col("n_words"), F.lit(1))
    length = (F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH) / (n + PRIOR_WORDS)
    raw = (
        F.log(length),
        F.sqrt(F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
    )
    return [F.round(x * SCALE).cast("long").alias(f) for x, f in zip(raw, FEATURES, strict=True)]


def _products() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


def _estimates(rows: DataFrame) -> DataFrame:
    """Per group: mean and inverse Cholesky pivots of the covariance of its rows."""
    whole = "decimal(38,0)"
    sums = [F.sum(F.col(f).cast("decimal(20,0)")).cast(whole).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    pairs = [
        F.sum((F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("decimal(20,0)")).cast(whole).alias(f"p{i}{j}")
        for i, j in _products()
    ]
    got = rows.groupBy("grp").agg(F.count(F.lit(1)).cast("double").alias("m"), *sums, *pairs)
    unit = float(SCALE)
    got = got.withColumns({f"mu{i}": F.col(f"s{i}").cast("double") / F.col("m") / unit for i in range(len(FEATURES))})
    cov = {}
    for i, j in _products():
        mean = F.col(f"p{i}{j}").cast("double") / F.col("m") / (unit * unit)
        value = (mean - F.col(f"mu{i}") * F.col(f"mu{j}")) * CONSISTENCY
        cov[f"c{i}{j}"] = value + FLOORS[i] ** 2 if i == j else value
    got = got.withColumns(cov)
    for i in range(len(FEATURES)):  # Cholesky, one column of the factor after another
        pivot = F.col(f"c{i}{i}") - sum((F.col(f"l{i}{k}") ** 2 for k in range(i)), F.lit(0.0))
        got = got.withColumn(f"l{i}{i}", F.sqrt(F.greatest(pivot, F.lit(1e-9))))
        below = {}
        for j in range(i + 1, len(FEATURES)):
            rest = sum((F.col(f"l{j}{k}") * F.col(f"l{i}{k}") for k in range(i)), F.lit(0.0))
            below[f"l{j}{i}"] = (F.col(f"c{i}{j}") - rest) / F.col(f"l{i}{i}")
        got = got.withColumns(below)
    keep = [f"mu{i}" for i in range(len(FEATURES))]
    keep += [f"l{j}{i}" for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    return got.select("grp", *keep)


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance from the group's estimate.

    Rows of a group without an estimate get null.
    """
    out = rows.join(estimates, "grp", "left")
    for i, f in enumerate(FEATURES):
        left = F.col(f) / float(SCALE) - F.col(f"mu{i}")
        left = left - sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", left / F.col(f"l{i}{i}"))
    square = sum((F.col(f"z{i}") ** 2 for i in range(len(FEATURES))), F.lit(0.0))
    return out.select(*rows.columns, square.alias("d2"))


def _medians(rows: DataFrame) -> DataFrame:
    """Per group, in the form of ``_estimates``: medians and their absolute deviations.

    Features are integers of few values, so the exact medians take little memory.
    """
    p = len(FEATURES)
    mid = rows.groupBy("grp").agg(*[F.median(f).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    mid = materialize(mid, "rules-medians")
    away = [F.median(F.abs(F.col(f) - F.col(f"m{i}"))).alias(f"a{i}") for i, f in enumerate(FEATURES)]
    got = mid.join(rows.join(mid, "grp").groupBy("grp").agg(*away), "grp")
    unit = float(SCALE)
    mu = [(F.col(f"m{i}") / unit).alias(f"mu{i}") for i in range(p)]
    scale = lambda i: F.greatest(F.col(f"a{i}") * (MAD / unit), F.lit(FLOORS[i]))
    factor = [
        (scale(i) if i == j else F.lit(0.0)).alias(f"l{j}{i}") for i in range(p) for j in range(i, p)
    ]
    return got.select("grp", *mu, *factor)


def _started(start: Column) -> Column:
    return F.concat(start.cast("string"), F.lit(":"), F.col("grp")).alias("grp")


def fitted(rows: DataFrame, *, steps: int = STEPS) -> DataFrame:
    """The estimate of least determinant of each ``grp`` of written feature ``rows``."""
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    sizes = materialize(sizes, "rules-sizes")
    every = F.greatest(F.lit(1), (F.col("size") / SUBSET_ROWS).cast("long"))
    chosen = [
        F.when(F.pmod(F.xxhash64(*FEATURES, F.lit(k)), every) == 0, F.lit(k))
        for k in range(2, STARTS)
    ]
    subsets = rows.join(sizes, "grp").select("*", F.explode(F.array_compact(F.array(*chosen))).alias("k"))
    estimate = _estimates(rows).withColumn("grp", _started(F.lit(0)))
    estimate = estimate.unionByName(_medians(rows).withColumn("grp", _started(F.lit(1))))
    estimate = estimate.unionByName(_estimates(subsets.select(_started(F.col("k")), *FEATURES)))
    estimate = materialize(estimate, "rules-estimate")
    starts = F.explode(F.array(*map(F.lit, range(STARTS)))).alias("k")
    copies = rows.select("*", starts).select(_started(F.col("k")), *FEATURES)
    for _ in range(steps):  # a start without a row has no estimate, and no distance
        near = _nearest(_with_distance(copies, estimate).where("d2 is not null"))
        estimate = materialize(_estimates(near), "rules-estimate")
    spread = sum((F.log(F.col(f"l{i}{i}")) for i in range(len(FEATURES))), F.lit(0.0))
    best = F.struct(spread.alias("spread"), *[c for c in estimate.columns])
    best = estimate.groupBy(F.expr("substring(grp, instr(grp, ':') + 1)").alias("own")).agg(F.min(best).alias("e"))
    kept = [F.col(f"e.{c}").alias(c) for c in estimate.columns if c != "grp"]
    return materialize(best.select(F.col("own").alias("grp"), *kept), "rules-best")


def _nearest(rows: DataFrame) -> DataFrame:
    """The nearest rows of each group: whole bins of distance until half of the rows is reached."""
    bins = F.floor(F.log(F.col("d2") + 1e-6) * BIN).cast("int")
    rows = rows.withColumn("bin", bins)
    counts = rows.groupBy("grp", "bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("grp")
    upto = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    need = F.floor((F.sum("n").over(group) + len(FEATURES) + 1) / 2)
    taken = counts.select("grp", "bin", F.coalesce(upto, F.lit(0)).alias("below"), need.alias("need"))
    last = taken.where("below < need").groupBy("grp").agg(F.max("bin").alias("last_bin"))
    # One row per group, written, so that the join with a large group can be split.
    last = materialize(last, "rules-cut")
    return rows.join(last, "grp").where("bin <= last_bin").drop("bin", "last_bin", "d2")


def _name(column: str) -> Column:
    return F.when(F.col(column).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(column)))


def _levels(good: DataFrame) -> DataFrame:
    """Per language and source the group that its rows are judged in: ``lang, source, grp, level``.

    Its own, or that of all rows of its language, or that of all rows, whichever is
    the first with ``MIN_GROUP`` rows.
    """
    sizes = good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("own"))
    sizes = sizes.withColumn("of_lang", F.sum("own").over(Window.partitionBy("lang")))
    total = sizes.agg(F.sum("own")).scalar()
    level = (
        F.when(F.col("own") >= MIN_GROUP, "source")
        .when(F.col("of_lang") >= MIN_GROUP, "language")
        .when(total >= MIN_GROUP, "all")
    )
    return materialize(sizes.select("lang", "source", level.alias("level")), "rules-levels")


def _group(level: Column) -> Column:
    """Name of a row's group on a level."""
    return (
        F.when(level == "source", F.concat_ws("/", F.lit("s"), _name("lang"), _name("source")))
        .when(level == "language", F.concat_ws("/", F.lit("l"), _name("lang")))
        .when(level == "all", "a")
    )


def judge(docs: DataFrame, *, steps: int = STEPS) -> DataFrame:
    """Base statistics and verdict of every document.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept``, ``distance2`` (null where no estimate was
    needed or possible) and ``level``, one row per input row. Null text has no
    words and fails; null languages and sources are groups of their own. A group
    with fewer than ``MIN_GROUP`` rows that pass the base rules is judged by the
    estimate of all rows of its language, or else of all rows; ``level`` tells which
    it was: ``source``, ``language``, ``all``, or null where even these are fewer,
    and the rows are kept. Other columns are ignored.
    """
    stats = base_statistics(docs).withColumn("base_failed", base_failed())
    vectors = materialize(stats.select("*", *feature_vector()), "rules-statistics")
    good = vectors.where("not base_failed")
    levels = _levels(good)
    # A row takes part in the estimates of all levels that some row is judged on.
    used = levels.where("level is not null").select("lang", "source", _group(F.col("level")).alias("grp"))
    used = materialize(used.select("grp").distinct(), "rules-groups")
    names = F.explode(F.array(*[_group(F.lit(x)) for x in ("source", "language", "all")])).alias("grp")
    rows = good.select(names, *FEATURES).join(used, "grp").distinct()
    estimate = fitted(materialize(rows, "rules-rows"), steps=steps)
    same = vectors["lang"].eqNullSafe(levels["lang"]) & vectors["source"].eqNullSafe(levels["source"])
    placed = vectors.join(levels, same, "left").drop(levels["lang"], levels["source"])
    placed = placed.withColumn("grp", _group(F.col("level")))
    scored = _with_distance(placed, estimate)
    far = F.coalesce(F.col("d2") > CUTOFF, F.lit(False))
    passed = ~F.col("base_failed")
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
        (passed & ~far).alias("kept"),
        F.when(passed, F.col("d2")).alias("distance2"),
        F.when(passed, F.col("level")).alias("level"),
    )
