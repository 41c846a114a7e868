"""Runs registered queries on Spark and their SQL on DuckDB and compares columns, types and values.

Command line: ``python tests/oracle.py SF_DIR [name-prefix …]``.
"""
from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cores}]").appName("plumbline-check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "10g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def sort_key(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=sort_key)


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    rel = con.sql(sql)
    want_names, want = rel.columns, rel.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} vs {sorted(want_names)}"
    kinds = dict(df.dtypes)
    types = {n: str(t) for n, t in zip(want_names, rel.types)}
    bad = {n: (kinds[n], types[n]) for n in want_names
           if SPARK_KIND.get(kinds[n], kinds[n]) != types[n] and not kinds[n].startswith("array")}
    if bad:
        return f"types {bad}"
    want = rows_of(want_names, want)
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    diff = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(diff)} of {len(got)} rows differ, first {diff[0]}" if diff else None


def main(sf_dir: str, prefixes: list[str]) -> int:
    from plumbline.plans.all_queries import ORACLES, QUERIES

    spark, con = session(), connect(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, sf_dir, fn, ORACLES[name])
                state = "ok" if problem is None else f"DIFF {problem[:700]}"
            else:
                df = fn(spark, sf_dir)
                rows = df.collect()
                state = f"rows={len(rows)} first={str(rows[:1])[:150]}"
        except Exception as e:
            state = "ERROR " + str(e)[:900]
        failed += state.startswith(("DIFF", "ERROR"))
        print(f"{time.time() - t0:6.1f}s {name}: {state}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
