"""Tables whose parts are listed in numbered snapshots.

A part is a folder of Parquet files that never changes once it is listed. A
writer puts a new part beside the others and then adds a snapshot, a small file
that names all parts of the table from then on. The file of a number can be
created only once; who comes second looks at the newer snapshot and tries again.
A reader takes the newest snapshot when it starts, and what it names stays in
place until :func:`vacuum` removes what no recent snapshot names.

The part of a micro-batch carries its run and batch number, so a replayed batch
takes the place of its first attempt. :func:`compact` merges the parts of a
generation into one part of the next, as soon as there are ``fan_in`` of them: a
row is rewritten once per generation, and the number of parts grows with the
logarithm of the number of batches. How far a run's batches have been merged is
noted, so a batch that is replayed after that is not stored twice.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.sources.tables import run_of

SNAPSHOTS = "_snapshots"
# Folders of parts, in the form of a partition, so that many are read as one table.
PART = "snapshot_part"
FAN_IN = 16
ATTEMPTS = 20
# Partition column of tables that are split by time, and its form by unit.
SLOT = "slot"
SLOT_FORMS = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


@dataclass
class Snapshot:
    """Parts (``folder, run, batch, generation``), columns, split, and merged batches by run."""

    version: int = 0
    parts: list[dict] = field(default_factory=list)
    schema: dict | None = None
    split: list[str] = field(default_factory=list)
    merged: dict[str, int] = field(default_factory=dict)

    def batch(self, run: str, batch: int) -> dict | None:
        return next((p for p in self.parts if (p["run"], p["batch"]) == (run, batch)), None)


# --- files -------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder, with when they were last changed; none if there is no folder."""
    files, to_path = _files(spark, path)
    if not files.exists(to_path(path)):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(to_path(path))]


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = (name for name, _ in _names(spark, f"{path}/{SNAPSHOTS}"))
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[0] != ".")


def latest(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The newest snapshot of a table, or that of a given number; an empty one if there is none."""
    versions = _versions(spark, path)
    if not versions:
        return Snapshot()
    name = f"{path}/{SNAPSHOTS}/{versions[-1] if version is None else version:012d}.json"
    [row] = spark.read.option("wholetext", True).text(name).collect()
    return Snapshot(**json.loads(row["value"]))


def _create(spark: SparkSession, path: str, snapshot: Snapshot) -> bool:
    """Write the snapshot's file, whole at once; False if the number is taken."""
    jvm = spark._jvm
    files, to_path = _files(spark, path)
    temp = to_path(f"{path}/{SNAPSHOTS}/.{uuid.uuid4().hex}")
    out = files.create(temp, False)
    out.write(bytearray(json.dumps(vars(snapshot)).encode()))
    out.close()
    where = to_path(f"{path}/{SNAPSHOTS}/{snapshot.version:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    # Without options an existing target is an error.
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(temp), files.makeQualified(where), options)
        return True
    except Exception as error:
        if "FileAlreadyExists" not in str(error):
            raise
        files.delete(temp, False)
        return False


def commit(spark: SparkSession, path: str, change: Callable[[Snapshot], bool]) -> Snapshot:
    """Apply ``change`` to the newest snapshot and add the result; again if another was first.

    ``change`` alters its argument and tells whether there is anything to add.
    """
    for _ in range(ATTEMPTS):
        snapshot = latest(spark, path)
        if not change(snapshot):
            return snapshot
        snapshot.version += 1
        if _create(spark, path, snapshot):
            return snapshot
    raise RuntimeError(f"{path}: {ATTEMPTS} attempts to add a snapshot")


# --- writing -----------------------------------------------------------------


def slot_of(time_column: str, unit: str = "day") -> Column:
    """The day or hour of a time, as a value to split a table by."""
    return F.date_format(time_column, SLOT_FORMS[unit]).alias(SLOT)


def _with_columns(known: dict | None, added: T.StructType) -> dict:
    """The table's columns and any new ones after them; a changed type is an error."""
    fields = {f.name: f for f in (T.StructType.fromJson(known) if known else [])}
    for f in added:
        held = fields.setdefault(f.name, T.StructField(f.name, f.dataType))
        if held.dataType != f.dataType:
            raise ValueError(f"column {f.name} is {held.dataType} and {f.dataType}")
    return json.loads(T.StructType(list(fields.values())).json())


def _write(df: DataFrame, path: str, split: list[str]) -> str:
    folder = f"{PART}={uuid.uuid4().hex}"
    writer = df.write.partitionBy(*split) if split else df.write
    writer.parquet(f"{path}/{folder}")
    return folder


def append_batch(
    df: DataFrame, path: str, batch: int, *, run: str, split: tuple[str, ...] = ()
) -> Snapshot:
    """Add a micro-batch as a part; the same ``batch`` of the same ``run`` takes its earlier place.

    ``split`` names the columns whose values get folders of their own.
    """
    spark = df.sparkSession
    if batch <= latest(spark, path).merged.get(run, -1):
        return latest(spark, path)
    part = {"folder": _write(df, path, list(split)), "run": run, "batch": batch, "generation": 0}

    def add(snapshot: Snapshot) -> bool:
        if snapshot.parts and snapshot.split != list(split):
            raise ValueError(f"{path} is split by {snapshot.split}")
        if batch <= snapshot.merged.get(run, -1):
            return False
        snapshot.parts = [p for p in snapshot.parts if (p["run"], p["batch"]) != (run, batch)] + [part]
        snapshot.schema = _with_columns(snapshot.schema, df.schema)
        snapshot.split = list(split)
        return True

    return commit(spark, path, add)


def snapshot_writer(
    path: str, time_column: str | None = None, unit: str = "day", *, fan_in: int = FAN_IN
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds each batch as a part and merges small parts.

    With ``time_column`` the table is split by that time's day or hour.
    """
    split = (SLOT,) if time_column else ()

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn(SLOT, slot_of(time_column, unit)) if time_column else df
        append_batch(rows, path, batch_id, run=run_of(df), split=split)
        compact(df.sparkSession, path, fan_in=fan_in)

    return write


def keep_batches(spark: SparkSession, path: str, run: str, first: int) -> Snapshot:
    """Take a run's batches before ``first`` out of the table, for tables that a batch replaces."""

    def drop(snapshot: Snapshot) -> bool:
        kept = [p for p in snapshot.parts if p["run"] != run or p["batch"] >= first]
        changed = len(kept) < len(snapshot.parts)
        snapshot.parts = kept
        return changed

    return commit(spark, path, drop)


def compact(
    spark: SparkSession,
    path: str,
    *,
    fold: Callable[[DataFrame], DataFrame] | None = None,
    fan_in: int = FAN_IN,
) -> Snapshot:
    """Merge every generation that has ``fan_in`` parts or more into one part of the next.

    ``fold`` may shrink the merged rows, such as by adding up deltas; its result must
    mean the same as the rows. Files are as large as adaptive execution's advisory
    size, per value of the split. Meant for one caller at a time, beside any number of
    writers and readers.
    """
    generation = 0
    while True:
        snapshot = latest(spark, path)
        chosen = [p for p in snapshot.parts if p["generation"] == generation]
        if len(chosen) < fan_in:
            if not any(p["generation"] > generation for p in snapshot.parts):
                return snapshot
            generation += 1
            continue
        rows = read(spark, path, snapshot, parts=chosen)
        rows = fold(rows) if fold else rows
        rows = rows.hint("rebalance", *[F.col(c) for c in snapshot.split])
        gone = {p["folder"] for p in chosen}
        part = {"folder": _write(rows, path, snapshot.split), "run": None, "batch": None, "generation": generation + 1}

        def replace(newer: Snapshot) -> bool:
            # A batch that was replayed meanwhile has another folder: merge again later.
            if not gone <= {p["folder"] for p in newer.parts}:
                return False
            for p in chosen:
                if p["run"] is not None:
                    newer.merged[p["run"]] = max(p["batch"], newer.merged.get(p["run"], -1))
            newer.parts = [p for p in newer.parts if p["folder"] not in gone] + [part]
            return True

        commit(spark, path, replace)


def vacuum(spark: SparkSession, path: str, *, versions: int = 10, older_than_s: float = 86_400) -> int:
    """Remove parts that none of the last ``versions`` snapshots names, and older snapshots.

    Parts younger than ``older_than_s`` stay: a writer may be about to list them. A
    reader may thus take as long as the table takes for ``versions`` snapshots.
    """
    known = _versions(spark, path)
    named = {p["folder"] for v in known[-versions:] for p in latest(spark, path, v).parts}
    limit = (time.time() - older_than_s) * 1000
    files, to_path = _files(spark, path)
    gone = [n for n, at in _names(spark, path) if n.startswith(f"{PART}=") and n not in named and at < limit]
    old = [f"{SNAPSHOTS}/{v:012d}.json" for v in known[:-versions]]
    for name in gone + old:
        files.delete(to_path(f"{path}/{name}"), True)
    return len(gone)


# --- reading -----------------------------------------------------------------


def read(
    spark: SparkSession, path: str, snapshot: Snapshot | None = None, parts: list[dict] | None = None
) -> DataFrame:
    """All rows of a snapshot, the newest by default, or of some of its parts.

    Columns that a part lacks read as NULL. The table must have had a batch.
    """
    snapshot = latest(spark, path) if snapshot is None else snapshot
    if snapshot.schema is None:
        raise ValueError(f"{path} has no snapshot")
    schema = T.StructType.fromJson(snapshot.schema)
    folders = [f"{path}/{p['folder']}" for p in (snapshot.parts if parts is None else parts)]
    if not folders:
        return spark.createDataFrame([], schema)
    # Partition columns come last on reading.
    whole = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
    reader = spark.read.option("basePath", path).schema(whole)
    return reader.parquet(*folders).select(*schema.names)
