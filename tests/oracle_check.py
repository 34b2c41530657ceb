"""Run registered queries next to their SQL in DuckDB and compare rows and types.

    python tests/oracle_check.py [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "double": "float", "float": "float",
    "string": "text", "boolean": "bool", "date": "date", "timestamp_ntz": "time", "timestamp": "time",
}
DUCK_KINDS = {
    "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "TINYINT": "int", "HUGEINT": "hugeint",
    "DOUBLE": "float", "FLOAT": "float", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "time",
}


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """None when both sides agree, else a description of the difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: DUCK_KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    if ours != kinds:
        return f"types {[(n, ours[n], kinds[n]) for n in names if ours[n] != kinds[n]]}"
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    wrong = [(a, b) for a, b in zip(got, expected) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}"[:700] if wrong else None


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    import __spark_entry__ as entry
    from tarnlake.session import build_session

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{options.sf}"
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    chosen = [n for n in entry.queries() if not options.names or any(w in n for w in options.names)]
    for name in chosen:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in oracles:
                verdict = compare(df, con, oracles[name]) or f"ok, {df.count()} rows"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as problem:  # report every query, then fail
            verdict = f"FAILED {type(problem).__name__}: {str(problem)[:600]}"
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{len(chosen)} queries, {bad} wrong")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
