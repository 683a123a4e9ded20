"""Run registered queries against their SQL in DuckDB, by hand: ``python -m tests.check sf0.01 [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def compare(spark, con, folder, build, sql):
    """``None`` if both agree in column names, row count and every value, else what differs."""
    df = build(spark, folder)
    names, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    expected_names, theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine}\n      != {other}"
    return None


def main(scale="sf0.01", *names):
    import __spark_entry__ as entry
    from gaugeline import session

    spark = session(
        "check", "local[8]", {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                              "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/{scale}"
    con = connect(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, folder, build, oracles[name])
            else:
                problem = None
                print(f"     {name}: no SQL, {build(spark, folder).count()} rows")
        except Exception as error:  # a report of all queries, not the first failure
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    missing = set(oracles) - set(entry.queries())
    print(f"{bad} failures; SQL without a query: {sorted(missing)}")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(*sys.argv[1:]) else 0)
