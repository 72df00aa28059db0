"""Run registered queries in Spark and DuckDB and compare them: python tests/compare.py [sf dir] [name part ...]"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(map(_cell, value))
    return tuple(sorted((k, _cell(v)) for k, v in value.items())) if isinstance(value, dict) else value


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    rows = collections.Counter(tuple(_cell(r[i]) for i in order) for r in df.collect())
    return [df.columns[i] for i in order], [df.schema[i].dataType.simpleString() for i in order], rows


def duck_rows(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]).lower() for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = collections.Counter(tuple(_cell(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], [kinds[i] for i in order], rows


SAME = {"string": "varchar", "int": "integer"}


def compare(spark, con, sf_dir: str, name: str, build, sql: str | None) -> tuple[str, str]:
    """('ok' | 'rows' | 'BAD', note)"""
    names, kinds, rows = spark_rows(build(spark, sf_dir))
    total = sum(rows.values())
    if sql is None:
        return "rows", f"{total} rows"
    want_names, want_kinds, want = duck_rows(con, sql)
    if names != want_names:
        return "BAD", f"columns {names} != {want_names}"
    if rows != want:
        missing, extra = list((want - rows).items())[:2], list((rows - want).items())[:2]
        return "BAD", f"{total} rows, want {sum(want.values())}; {names} missing {missing}; extra {extra}"
    odd = [f"{n}: {a}/{b}" for n, a, b in zip(names, kinds, want_kinds) if SAME.get(a, a) != b]
    return "ok", f"{total} rows" + (f"; types {odd}" if odd else "")


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    counts = collections.Counter()
    for name, build in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            verdict, note = compare(spark, con, sf_dir, name, build, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            verdict, note = "BAD", str(error)[:700]
        counts[verdict] += 1
        print(f"{verdict:5}{time.time() - start:6.1f}s {name}: {note}", flush=True)
    print(dict(counts))


if __name__ == "__main__":
    main()
