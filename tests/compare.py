"""Run registered queries and their DuckDB twins side by side: rows, types and values."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(type_name: str) -> str:
    t = type_name.lower()
    if t.startswith(("hugeint", "decimal")):
        return t
    for kind, names in {
        "int": ("bigint", "int", "integer", "smallint", "tinyint", "long"),
        "float": ("double", "float"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
        "date": ("date",),
        "time": ("timestamp", "timestamp_ntz"),
    }.items():
        if t in names:
            return kind
    return t


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def compare(df, con, sql: str) -> str:
    """'' when rows, column names, types and values agree, else what differs."""
    ours_names = sorted(df.columns)
    ours = sorted((tuple(_cell(r[c]) for c in ours_names) for r in df.collect()), key=repr)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    types = dict(zip(names, (_kind(str(d[1])) for d in found.description)))
    order = sorted(names)
    at = [names.index(c) for c in order]
    theirs = sorted((tuple(_cell(r[i]) for i in at) for r in found.fetchall()), key=repr)
    if order != ours_names:
        return f"columns {ours_names} != {order}"
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    wrong = {c: (kinds[c], types[c]) for c in order if kinds[c] != types[c]}
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}; types {wrong}"
    if ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        return f"{len(bad)} rows differ, types {wrong}, first: {str(bad[0][0])[:400]} | {str(bad[0][1])[:400]}"
    return f"types {wrong}" if wrong else ""


def main() -> None:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                result = compare(df, con, oracle[name])
            else:
                result = ""
                rows = df.count()
                print(f"     {name}: {rows} rows, no twin ({time.time() - start:.1f}s)", flush=True)
                continue
        except Exception as cause:
            result = f"{type(cause).__name__}: {str(cause)[:1200]}"
        bad += bool(result)
        print(f"{'FAIL' if result else 'ok  '} {name} ({time.time() - start:.1f}s) {result}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
