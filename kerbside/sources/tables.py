"""Output tables that survive replayed micro-batches and gain columns over time.

A table is a folder with one sub-folder per run and micro-batch. A run is one
streaming query, known by the id that its checkpoint keeps. Writing batch *n* of
a run again replaces its sub-folder, so a batch that is replayed after a failure
leaves the table as it was; no existing row is read or rewritten for that. A
query that starts with a new checkpoint counts its batches from 0 again, but as
another run, so it never replaces what an earlier one stored. Rows that both
have written are told apart on read, by their key.

Batches may be split by day of event time, so that a read of some days opens
only their files. The schemas of a table's batches lie beside the data, so that
a read need not open every file to learn the columns.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the two output tables.
DETAIL_TABLE = "traffic_detailed"
AVERAGES_TABLE = "traffic_averages"

QUARANTINE_TABLE = "quarantine"


QUERY_ID = "sql.streaming.queryId"
DAY = "table_day"
SCHEMAS = "_schemas"


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    partition_by: tuple[str, ...] = (),
    *,
    run: str,
    day_of: str | None = None,
    known: set[str] | None = None,
) -> None:
    """Write one micro-batch; the same ``batch_id`` of the same ``run`` replaces its earlier output.

    ``day_of`` names the time column whose day splits the batch; all batches of a
    table are split alike. The schema is noted before the data, unless ``known``
    holds it already.
    """
    known = set() if known is None else known
    if df.schema.json() not in known:
        _note_schema(df, path, run)
        known.add(df.schema.json())
    if day_of is not None:
        df = df.withColumn(DAY, F.to_date(day_of))
        partition_by = (DAY, *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/run=id-{run}/batch_id={batch_id}")


def _note_schema(df: DataFrame, path: str, run: str) -> None:
    text = df.schema.json()
    name = hashlib.sha256(text.encode()).hexdigest()[:16]
    note = df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1)
    note.write.mode("overwrite").text(f"{path}/{SCHEMAS}/run=id-{run}/schema=id-{name}")


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """All columns that batches of a table have had, oldest first; a changed type is an error.

    Reads one line per run and schema, however many files the table has.
    """
    notes = spark.read.text(f"{path}/{SCHEMAS}").select("value", "_metadata.file_modification_time")
    first = notes.groupBy("value").agg(F.min("file_modification_time").alias("since"))
    fields: dict[str, T.StructField] = {}
    for row in first.orderBy("since", "value").collect():
        for field in T.StructType.fromJson(json.loads(row["value"])):
            held = fields.setdefault(field.name, T.StructField(field.name, field.dataType))
            if held.dataType != field.dataType:
                raise ValueError(f"column {field.name} is {held.dataType} and {field.dataType}")
    return T.StructType(list(fields.values()))


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query that runs this micro-batch, the same after a restart."""
    found = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    if not found:
        raise ValueError("not inside a streaming query")
    return found


def batch_writer(
    path: str, partition_by: tuple[str, ...] = (), *, day_of: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends to the table at ``path``."""
    known: set[str] = set()

    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id, partition_by, run=run_of(df), day_of=day_of, known=known)

    return write


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    keys: list[str] | None = None,
    days: tuple[date | str, date | str] | None = None,
) -> DataFrame:
    """All batches of all runs of a table; one row per key where ``keys`` are given.

    Columns that a batch lacks read as NULL. Without ``schema`` the columns are
    all that the table has had. ``days``, first and last, reads the files of these
    days only, from a table that is split by day.
    """
    columns = table_schema(spark, path) if schema is None else schema
    places = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
    reader = spark.read.option("basePath", path).schema(T.StructType([*columns.fields, *places]))
    rows = reader.parquet(path)
    if days is not None:
        first, last = (F.lit(day).cast("date") for day in days)
        rows = rows.where(F.col(DAY).between(first, last))
    rows = rows.drop("run", "batch_id", DAY)
    return rows if keys is None else rows.dropDuplicates(keys)


def align_columns(batch: DataFrame, table: DataFrame) -> DataFrame:
    """``batch`` with the table's columns first and any new ones after them."""
    known = table.limit(0)
    return known.unionByName(batch, allowMissingColumns=True)


def append_new(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of ``batch`` that the target does not hold yet; NULL keys are equal.

    For targets that cannot replace a batch, such as a database table: read the
    keys that lie in the batch's time range and append only what is new.
    """
    held = existing.select(*[F.col(k).alias(f"held__{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"held__{k}")) for k in keys]
    return batch.dropDuplicates(keys).join(held, same, "left_anti")


def jdbc_options(url: str, table: str, user: str, password: str, connections: int = 8) -> dict[str, str]:
    """Writer options of a database table; credentials come from the caller and
    ``connections`` bounds how many tasks write at once."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "numPartitions": str(connections),
    }


def time_slices(column: str, low: datetime, high: datetime, slices: int) -> list[str]:
    """Predicates that cut [low, high] into spans of time, one for each task that reads."""
    step = (high - low) / slices
    cuts = [low + k * step for k in range(slices)]
    stamp = "TIMESTAMP '{:%Y-%m-%d %H:%M:%S.%f}'".format
    return [
        f"{column} >= {stamp(a)} AND {column} {'<' if b else '<='} {stamp(b or high)}"
        for a, b in zip(cuts, [*cuts[1:], None], strict=True)
    ]


def _read_slices(spark: SparkSession, options: dict[str, str], predicates: list[str]) -> DataFrame:
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable", "numPartitions")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=properties)


def jdbc_batch_writer(
    options: dict[str, str],
    keys: list[str],
    time_column: str,
    read: Callable[[SparkSession, dict[str, str], list[str]], DataFrame] = _read_slices,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends rows with new keys to a database table.

    The rows already there are read for the batch's time range only, one span of it
    per connection (``numPartitions``); the predicates are evaluated by the database.
    The first run needs the table to exist.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        batch = df.persist()
        try:
            low, high = batch.agg(F.min(time_column), F.max(time_column)).first()
            if low is None:
                return
            slices = time_slices(time_column, low, high, int(options.get("numPartitions", "8")))
            new = append_new(batch, read(df.sparkSession, options, slices), keys)
            new.write.format("jdbc").options(**options).mode("append").save()
        finally:
            batch.unpersist()

    return write


def merge_statement(table: str, stage: str, columns: list[str], keys: list[str]) -> str:
    """One statement that takes the staged rows over: new keys are added, known ones replaced.

    The table needs a unique constraint on the keys; a key column must not be null.
    """
    name = '"{}"'.format
    listed = ", ".join(map(name, columns))
    rest = [c for c in columns if c not in keys]
    change = ", ".join(f"{name(c)} = excluded.{name(c)}" for c in rest)
    return (
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {stage} "
        f"ON CONFLICT ({', '.join(map(name, keys))}) DO {f'UPDATE SET {change}' if rest else 'NOTHING'}"
    )


def _stage(df: DataFrame, options: dict[str, str], stage: str) -> None:
    df.write.format("jdbc").options(**options | {"dbtable": stage}).mode("overwrite").save()


def jdbc_execute(spark: SparkSession, options: dict[str, str], statements: list[str]) -> None:
    """Run statements in one transaction of the database, over the driver that Spark uses."""
    properties = spark._jvm.java.util.Properties()
    for name in ("user", "password"):
        properties.setProperty(name, options[name])
    if "driver" in options:
        spark._jvm.java.lang.Class.forName(options["driver"])
    connection = spark._jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().execute(statement)
        connection.commit()
    finally:
        connection.close()


def jdbc_upsert_writer(
    options: dict[str, str],
    keys: list[str],
    order: str | None = None,
    stage: Callable[[DataFrame, dict[str, str], str], None] = _stage,
    execute: Callable[[SparkSession, dict[str, str], list[str]], None] = jdbc_execute,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that leaves one row per key in a database table.

    A batch goes to a staging table of its run by as many tasks as there are
    connections, and from there by one merge statement in one transaction, so readers
    see a batch whole. No row is read back. A replayed batch writes the same rows
    again, a corrected one replaces them. Of several rows of a batch with one key the
    one with the largest ``order`` counts, or any where there is no order.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        one = df.dropDuplicates(keys)
        if order is not None:
            rest = F.struct(*[c for c in df.columns if c not in keys])
            one = df.groupBy(*keys).agg(F.max_by(rest, order).alias("kept")).select(*keys, "kept.*")
        one = one.select(*df.columns)
        name = f"{options['dbtable']}_stage_{run_of(df).replace('-', '')[:12]}"
        stage(one, options, name)
        merge = merge_statement(options["dbtable"], name, df.columns, keys)
        execute(df.sparkSession, options, [merge, f"DROP TABLE {name}"])

    return write


def source_names(averages: DataFrame) -> DataFrame:
    """The averages under the column names of the deployed table."""
    return averages.select(
        "avg_speed",
        F.col("window_start").alias("window_start_ms"),
        F.col("window_end").alias("window_end_ms"),
        F.col("highway_id").alias("new_keys"),
    )


def summary_table(averages: DataFrame) -> DataFrame:
    """The declared summary table: ``start``, ``end``, ``avg_speed``."""
    return averages.select(
        F.col("window_start").alias("start"),
        F.col("window_end").alias("end"),
        F.col("avg_speed"),
    )
