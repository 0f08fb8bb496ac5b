"""Run registered queries in Spark and in DuckDB and compare schema, row count and rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (dt.datetime, dt.date, float, int, str, decimal.Decimal)):
        return type(value).__name__
    return "null" if value is None else type(value).__name__


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    names, rows = [c[0] for c in result.description], result.fetchall()
    mine_names, mine = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(mine_names):
        return f"columns {sorted(mine_names)} != {sorted(names)}"
    if len(rows) != len(mine):
        return f"rows {len(mine)} != {len(rows)}"
    a, b = _rows(mine_names, mine), _rows(names, rows)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duckdb={bad[0][1]}"
    kinds = [{tuple(map(_kind, r)) for r in side} for side in (a, b)]
    if kinds[0] != kinds[1]:
        return f"types {kinds[0] ^ kinds[1]}"
    return None


if __name__ == "__main__":
    import time

    from aduana.checks import oracle, registry
    from aduana.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls = oracle.oracle_sql()
    wanted = sys.argv[1:] or list(registry.queries())
    for name in wanted:
        began = time.time()
        try:
            df = registry.queries()[name](spark, sf)
            outcome = difference(df, con, sqls[name]) if name in sqls else f"no sql, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:35s} {time.time() - began:6.2f}s {'ok' if outcome is None else outcome}", flush=True)
