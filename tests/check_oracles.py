"""Compare registered queries with their SQL: python tests/check_oracles.py SF_DIR [names]."""

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry


def duck(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, db, sf_dir, name):
    """None where both sides agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(entry.oracle_sql()[name])
    want = canonical([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} of {len(got[1])} rows differ, first {bad[0]}" if bad else None


def main():
    from conftest import make_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, db = make_session(), duck(sys.argv[1])
    failed = 0
    for name in names or entry.queries():
        begin = time.time()
        try:
            problem = compare(spark, db, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - begin:6.2f}s {problem or 'ok'}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
