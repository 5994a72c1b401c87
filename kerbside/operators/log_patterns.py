"""Many line patterns at once, from a table.

Trying every pattern on every line is a product of both. Here each pattern is
tried only on lines that hold a word of it. A word inside a literal part, with
other characters on both sides of it there, stands as a whole word in every line
that fits; of a pattern's words the one that is rarest in the lines is its key,
and one join by word brings the candidates together. Patterns without such a
word are tried on every line, so the result is that of one expression per pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.matching import WILDCARD

WORD = "[A-Za-z0-9_]"
# A bitmap of key words has so many places as a power of two, two megabytes.
MAP_BITS = 24
_INNER = f"(?<=[^A-Za-z0-9_])({WORD}+)(?=[^A-Za-z0-9_])"
_SPECIAL = r"([\\.\[\]{}()*+?^$|&~#\-])"


def _parts(pattern: Column) -> Column:
    return F.filter(F.split(pattern, WILDCARD), lambda part: part != "")


def sure_words(pattern: Column) -> Column:
    """Words that stand whole in every line that fits the pattern."""
    found = F.transform(_parts(pattern), lambda p: F.regexp_extract_all(p, F.lit(_INNER), F.lit(1)))
    return F.array_distinct(F.flatten(found))


def pattern_regex(pattern: Column) -> Column:
    """The expression of a pattern: its literal parts in order, the first place of each being enough."""
    quoted = F.transform(
        _parts(pattern),
        lambda p: F.concat(F.lit("(?>.*?"), F.regexp_replace(p, F.lit(_SPECIAL), F.lit(r"\\$1")), F.lit(")")),
    )
    return F.concat(F.lit("(?s)^"), F.array_join(quoted, ""))


def keyed_patterns(logs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern, regex, word``: each pattern once with its rarest sure word, or an empty one."""
    table = patterns.select("pattern").where("pattern is not null").distinct()
    each = table.select("pattern", F.explode_outer(sure_words(F.col("pattern"))).alias("word"))
    lines = logs.select(F.explode(_words(F.col("line"))).alias("word"))
    counted = lines.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("key")
    keyed = _by_shuffle(each, counted, "word", "left").groupBy("pattern").agg(rarest)
    word = F.coalesce("key.word", F.lit("")).alias("word")
    return keyed.select("pattern", pattern_regex(F.col("pattern")).alias("regex"), word)


def _words(line: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(line, F.lit(f"({WORD}+)"), F.lit(1)))


def _by_shuffle(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join that sends no side through the driver.

    The planner takes exploded rows to be as few as the rows that they come from, and
    would broadcast all words of all lines.
    """
    return left.hint("merge").join(right.hint("merge"), on, how)


def _place(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(1 << MAP_BITS))


def _may_be_in(words: DataFrame, word: Column) -> Column:
    """Whether ``word`` may be one of a table: a bitmap of fixed size, which never misses one."""
    slots = words.select(_place(F.col("word")).alias("place")).groupBy(F.shiftright("place", 6).alias("slot"))
    bits = slots.agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    every = words.sparkSession.range(1 << (MAP_BITS - 6)).withColumnRenamed("id", "slot")
    every = every.join(bits, "slot", "left").select("slot", F.coalesce("bits", F.lit(0)).alias("bits"))
    found = every.agg(F.sort_array(F.collect_list(F.struct("slot", "bits")))["bits"]).scalar()
    at = _place(word)
    return F.getbit(F.get(found, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1


def pattern_matches(logs: DataFrame, patterns: DataFrame) -> DataFrame:
    """The rows of ``logs`` once for every ``pattern`` of the table that they fit.

    ``patterns`` has a column ``pattern``, in which ``<_>`` spans any text; equal
    ones count once. Rows without a line fit none. Only words that may be a
    pattern's key are shuffled with their lines.
    """
    keyed = keyed_patterns(logs, patterns)
    every = F.concat(_words(F.col("line")), F.array(F.lit("")))
    rows = logs.where("line is not null").withColumn("word", F.explode(every))
    rows = rows.where(_may_be_in(keyed, F.col("word")))
    return _by_shuffle(rows, keyed, "word").where(F.rlike("line", F.col("regex"))).drop("word", "regex")


def pattern_series_of(logs: DataFrame, patterns: DataFrame, step: str) -> DataFrame:
    """Rows per bucket for every pattern of a table, with the pattern's total, largest first."""
    counted = pattern_matches(logs.select("ts", "line"), patterns)
    counted = counted.groupBy("pattern", F.window("ts", step).alias("w")).agg(F.count(F.lit(1)).alias("count"))
    series = counted.select("pattern", F.col("w.start").alias("bucket"), "count")
    totals = series.groupBy("pattern").agg(F.sum("count").alias("total"))
    return series.join(totals, "pattern").orderBy(F.col("total").desc(), "pattern", "bucket")
