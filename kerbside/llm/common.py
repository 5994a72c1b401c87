"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import shared_dir

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows that one Arrow batch holds: texts have no bound on their length.
BATCH_ROWS = 256


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators need: UTC, adaptive execution, small Arrow batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, SPACES), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


# Intermediate tables of this driver, oldest first.
WRITTEN: list[str] = []


def drop_written(spark: SparkSession, upto: int) -> None:
    """Delete the first ``upto`` intermediate tables, once all that reads them is written."""
    paths, WRITTEN[:upto] = WRITTEN[:upto], []
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage, fixes values that depend on how rows were dealt, and
    gives the planner the real size. Readable from every executor.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    WRITTEN.append(path)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_splits(df: DataFrame, column: str, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending values that cut ``column`` into even ranges.

    Reads this one column. Only as many values as there are ranges reach the
    driver, however many rows there are.
    """
    steps = [i / ranges for i in range(1, ranges)]
    if not steps:
        return []
    found = df.select(F.percentile_approx(column, steps, 10_000)).first()[0]
    return sorted(set(found or []))


def range_of(column: Column, splits: list[int]) -> Column:
    """Number of the range that a value lies in; -1 for null. Splits close a range."""
    if not splits:
        return F.when(column.isNull(), -1).otherwise(0)
    cuts = F.array(*[F.lit(s).cast("long") for s in splits])
    return F.when(column.isNull(), -1).otherwise(F.size(F.filter(cuts, lambda s: s < column)))


def bitmap_of(marks: DataFrame, bits: int) -> bytes:
    """Bitmap of ``2 ** bits`` bits with those of ``mark`` set; the lowest bit of a byte comes first.

    Built in pieces of 4 kB; only the pieces reach the driver, 16 MB for 27 bits.
    """
    mark = F.col("mark") + 1
    pieces = marks.groupBy(F.bitmap_bucket_number(mark).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(mark)).alias("bits")
    )
    out = bytearray(max(1 << bits, 1 << 15) // 8)
    for row in pieces.collect():
        at = (row["piece"] - 1) * 4096
        out[at : at + len(row["bits"])] = row["bits"]
    return bytes(out)


MAP_BITS = 27


def marked(table: DataFrame, column: str, most_bits: int = MAP_BITS):
    """Broadcast bitmap of the leading bits of a written table's 64-bit hashes, and how many bits.

    The bitmap has about 32 bits per row, up to a fixed size: it never misses a hash,
    and beyond that size it lets more others pass.
    """
    bits = min(max(15, (32 * table.count()).bit_length()), most_bits)
    marks = table.select(F.shiftrightunsigned(column, 64 - bits).alias("mark"))
    return table.sparkSession.sparkContext.broadcast(bitmap_of(marks, bits)), bits


def has_mark(hashes: np.ndarray, bitmap, map_bits: int) -> np.ndarray:
    bits = np.frombuffer(bitmap.value, np.uint8)
    mark = hashes.astype(np.int64).view(np.uint64) >> np.uint64(64 - map_bits)
    return (bits[(mark >> np.uint64(3)).astype(np.int64)] >> (mark & np.uint64(7)).astype(np.uint8)) & 1 > 0


def is_marked(bitmap, map_bits: int):
    """A function of a column of hashes: whether the bitmap lets them pass."""

    @F.pandas_udf("boolean")
    def known(hashes: pd.Series) -> pd.Series:
        return pd.Series(has_mark(hashes.to_numpy(), bitmap, map_bits))

    return known


def bounded_sample(ids: DataFrame, n: int, salt: str = "") -> DataFrame:
    """At most ``n`` rows of ``doc_id``, those of the least hashes, the same on every run.

    A bound on the hash, set from the number of rows, leaves about ``n`` of them before
    any are compared, so the tasks together send no more than that.
    """
    hashed = F.xxhash64("doc_id", F.lit(salt))
    total = ids.count()
    if total > n:
        share = min(1.0, (n + 5 * n**0.5 + 20) / total)
        ids = ids.where(F.pmod(F.xxhash64(hashed), F.lit(1 << 40)) < int(share * (1 << 40)))
    return ids.orderBy(F.pmod(F.xxhash64(hashed), F.lit(1 << 40)), "doc_id").limit(n)
