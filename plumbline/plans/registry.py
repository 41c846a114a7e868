"""Named queries over the driver's tables, each with the SQL that checks it where SQL can."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.roles import Roles
from plumbline.sources.bench import BENCH_CTE, bench

ROLES = Roles()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query; ``sql`` may use the table ``bench``, whose definition is put in front."""

    def add(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_bench(sql) if " bench" in sql else sql
        return fn

    return add


def with_bench(sql: str) -> str:
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"{BENCH_CTE},\n{text[5:]}"
    return f"{BENCH_CTE}\n{text}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bench(spark, sf_dir).filter("split = 'train'")


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bench(spark, sf_dir).filter("split = 'test'")


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)
