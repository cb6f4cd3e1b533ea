"""Run queries on Spark and their SQL on DuckDB, and compare names, types and all rows.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return db


def plain(value):
    return int(value) if isinstance(value, bool) else value


def normal_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, db, name: str, sf: str) -> tuple[bool, str]:
    import __spark_entry__ as entry

    started = time.time()
    df = entry.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    spark_seconds = time.time() - started
    started = time.time()
    result = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    note = f"{len(got)} rows, spark {spark_seconds:.1f}s, duckdb {time.time() - started:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = normal_rows(df.columns, got), normal_rows(names, expected)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b), key=str)[:2], sorted(set(b) - set(a), key=str)[:2]
        return False, f"{note}, expected {len(expected)}\n  spark only: {only_a}\n  duck only:  {only_b}"
    other = {c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]}
    return True, note + (f" TYPES {other}" if other else "") + (" EMPTY" if not got else "")


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from findlake.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    bad = []
    for name in args or entry.queries():
        try:
            ok, note = compare(spark, db, name, sf)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        print(("ok   " if ok else "FAIL ") + name + ": " + note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
