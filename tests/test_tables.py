"""Output tables: replays, new columns, keyed appends, names."""

import tempfile
from datetime import datetime

import pytest

from kerbside.schema import AVERAGES
from kerbside.session import shared_dir
from kerbside.sources import tables

T = datetime(2025, 1, 31)


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="run-") + "/table"


def averages(spark, *rows):
    return spark.createDataFrame([(road, speed, T, end) for road, speed, end in rows], AVERAGES)


def test_replayed_batch_replaces_itself(spark, path):
    first = averages(spark, ("0", 1.0, T), ("1", 2.0, T))
    tables.write_batch(first, path, 0, run="a")
    tables.write_batch(averages(spark, ("0", 3.0, datetime(2025, 2, 1))), path, 1, run="a")
    before = sorted(map(tuple, tables.read_table(spark, path, AVERAGES).collect()))
    tables.write_batch(first.repartition(3), path, 0, run="a")
    assert sorted(map(tuple, tables.read_table(spark, path, AVERAGES).collect())) == before
    assert len(before) == 3


def test_new_column_is_null_in_old_rows(spark, path):
    tables.write_batch(spark.createDataFrame([(1,)], "a int"), path, 0, run="a")
    tables.write_batch(spark.createDataFrame([(2, "x")], "a int, b string"), path, 1, run="a")
    got = tables.read_table(spark, path)
    assert got.columns == ["a", "b"]
    assert sorted(map(tuple, got.collect())) == [(1, None), (2, "x")]
    known = tables.read_table(spark, path, got.schema)
    assert sorted(map(tuple, known.collect())) == [(1, None), (2, "x")]


def test_align_columns(spark):
    table = spark.createDataFrame([(1, 2.0)], "a int, b double")
    batch = spark.createDataFrame([("x", 3)], "c string, a int")
    aligned = tables.align_columns(batch, table)
    assert aligned.columns == ["a", "b", "c"]
    assert [tuple(r) for r in aligned.collect()] == [(3, None, "x")]


def test_append_new_keeps_unknown_keys(spark):
    held = averages(spark, ("0", 1.0, T))
    batch = averages(spark, ("0", 1.0, T), ("1", 1.0, T))
    new = tables.append_new(batch, held, ["highway_id", "window_end"])
    assert [r.highway_id for r in new.collect()] == ["1"]


def test_append_new_takes_each_key_once_and_null_as_a_key(spark):
    held = averages(spark, (None, 1.0, T))
    batch = averages(spark, (None, 1.0, T), ("1", 1.0, T), ("1", 1.0, T))
    new = tables.append_new(batch, held, ["highway_id", "window_end"])
    assert [r.highway_id for r in new.collect()] == ["1"]


def test_partitioned_batch_reads_back(spark, path):
    tables.write_batch(averages(spark, ("0", 1.0, T), ("1", 2.0, T)), path, 0, ("highway_id",), run="a")
    got = tables.read_table(spark, path, AVERAGES).collect()
    assert sorted((r.highway_id, r.avg_speed) for r in got) == [("0", 1.0), ("1", 2.0)]


def test_names(spark):
    means = averages(spark, ("0", 1.0, T))
    assert tables.summary_table(means).columns == ["start", "end", "avg_speed"]
    assert set(tables.source_names(means).columns) == {
        "avg_speed", "window_start_ms", "window_end_ms", "new_keys",
    }


def test_jdbc_options_hold_what_the_caller_gives():
    options = tables.jdbc_options("jdbc:postgresql://db/x", "t", "u", "p", connections=4)
    assert options["numPartitions"] == "4" and options["user"] == "u"


def test_shared_dir_is_under_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and "/kerbside/x-" in first
    assert root is None or first.startswith(f"{root}/kerbside/")


def test_days_are_pruned(spark, path):
    rows = averages(spark, *[("0", float(n), datetime(2025, 1, 31 - n, 12)) for n in range(4)])
    tables.write_batch(rows, path, 0, run="a", day_of="window_end")
    tables.write_batch(averages(spark, ("1", 9.0, None)), path, 1, run="a", day_of="window_end")
    some = tables.read_table(spark, path, days=("2025-01-29", "2025-01-30"))
    assert some.columns == AVERAGES.names
    assert sorted(r.avg_speed for r in some.collect()) == [1.0, 2.0]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "table_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert tables.read_table(spark, path, AVERAGES).count() == 5


def test_days_of_a_table_without_days(spark, path):
    tables.write_batch(averages(spark, ("0", 1.0, T)), path, 0, run="a")
    with pytest.raises(Exception, match="table_day"):
        tables.read_table(spark, path, AVERAGES, days=("2025-01-31", "2025-01-31")).collect()


def test_changed_type_is_an_error(spark, path):
    tables.write_batch(spark.createDataFrame([(1,)], "a int"), path, 0, run="a")
    tables.write_batch(spark.createDataFrame([("x",)], "a string"), path, 0, run="b")
    with pytest.raises(ValueError, match="column a"):
        tables.read_table(spark, path)


class StandIn:
    """Plays a database table with a unique key: takes staged rows over by a merge statement."""

    def __init__(self, keys):
        self.keys, self.staged, self.rows, self.statements = keys, {}, {}, []

    def stage(self, df, options, name):
        self.staged[name] = [r.asDict() for r in df.collect()]

    def execute(self, spark, options, statements):
        self.statements += statements
        merge, drop = statements
        name = drop.removeprefix("DROP TABLE ")
        assert merge.startswith(f'INSERT INTO {options["dbtable"]} (') and f" FROM {name} ON CONFLICT " in merge
        for row in self.staged.pop(name):
            self.rows[tuple(row[k] for k in self.keys)] = row


def test_upsert_leaves_one_row_per_key(spark, tmp_path):
    keys = ["highway_id", "window_end"]
    held = StandIn(keys)
    options = tables.jdbc_options("jdbc:x", "traffic_averages", "u", "p")
    write = tables.jdbc_upsert_writer(options, keys, order="avg_speed", stage=held.stage, execute=held.execute)
    later = datetime(2025, 2, 1)
    for n, rows in enumerate([[("0", 1.0, T), ("1", 2.0, T)], [("0", 5.0, T), ("0", 3.0, later), ("0", 4.0, later)]]):
        averages(spark, *rows).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    crash = [1]

    def sink(df, batch_id):
        write(df, batch_id)
        if crash:
            raise RuntimeError(f"lost after batch {crash.pop()}")

    def run():
        stream = spark.readStream.schema(AVERAGES).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/c")
        query.trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="lost after"):
        run()
    run()  # the same batch once more
    assert {k: r["avg_speed"] for k, r in held.rows.items()} == {("0", T): 5.0, ("1", T): 2.0, ("0", later): 4.0}
    averages(spark, ("1", 9.0, T)).coalesce(1).write.parquet(f"{tmp_path}/in/2")
    run()  # a corrected row
    assert {k: r["avg_speed"] for k, r in held.rows.items()} == {("0", T): 5.0, ("1", T): 9.0, ("0", later): 4.0}
    assert not held.staged and len(held.statements) == 6


def test_merge_statement():
    got = tables.merge_statement("t", "s", ["a", "b"], ["a"])
    assert got == 'INSERT INTO t ("a", "b") SELECT "a", "b" FROM s ON CONFLICT ("a") DO UPDATE SET "b" = excluded."b"'
    assert tables.merge_statement("t", "s", ["a"], ["a"]).endswith('ON CONFLICT ("a") DO NOTHING')


def test_slices_cover_the_range_once(spark):
    low, high = datetime(2025, 1, 31, 0, 0, 0, 1), datetime(2025, 1, 31, 7)
    slices = tables.time_slices("window_end", low, high, 5)
    times = [low + (high - low) * k / 37 for k in range(38)]
    rows = averages(spark, *[("0", float(k), t) for k, t in enumerate(times)])
    counts = [rows.where(s).count() for s in slices]
    assert len(slices) == 5 and sum(counts) == 38 and all(counts)
    assert tables.time_slices("t", low, low, 1)[0].count(f"{low:%H:%M:%S.%f}") == 2


def test_present_rows_are_read_by_many_tasks(spark, monkeypatch):
    seen, saved = [], []
    held = averages(spark, ("0", 1.0, T), ("0", 2.0, datetime(2025, 2, 1)))

    def read(session, options, predicates):
        seen.extend(predicates)
        return held.where(" OR ".join(f"({p})" for p in predicates))

    monkeypatch.setattr(tables, "append_new", lambda *a, real=tables.append_new: saved.append(real(*a)) or spark.range(0))
    write = tables.jdbc_batch_writer(tables.jdbc_options("u", "t", "a", "b", 4), ["highway_id", "window_end"], "window_end", read)
    with pytest.raises(Exception):  # no driver for the address
        write(averages(spark, ("0", 1.0, T), ("1", 3.0, datetime(2025, 1, 31, 4))), 0)
    assert len(seen) == 4 and [r.highway_id for r in saved[0].collect()] == ["1"]
