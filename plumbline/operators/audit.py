"""Data-quality audit: missing values, distinct counts, sign counts, clipping, outliers, profiles.

All columns of a table are audited in one aggregate; results are one row per column.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.ordered import quantile_values, quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def per_column(df: DataFrame, cols: Sequence[str], stats: Mapping[str, Callable[[str], Column]],
               by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by…, column, <stat>…)`` from a single aggregate over all columns."""
    wide = df.groupBy(*by).agg(*[
        F.struct(F.lit(c).alias("column"), *[f(c).alias(s) for s, f in stats.items()]).alias(f"_c{i}")
        for i, c in enumerate(cols)])
    return wide.select(*by, F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(cols))])))


def per_cell(df: DataFrame, cols: Sequence[str], stats: Mapping[str, Callable[[Column], Column]],
             by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by…, column, <stat>…)`` of the same aggregates over each numeric column's values.

    Cells are unpivoted inside the scan and combined there, one entry per column and task. The
    generated code stays small enough to be compiled whatever the number of columns, which one
    aggregate per column does not.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return (df.select(*by, F.inline(cells)).groupBy(*by, "column")
            .agg(*[f(F.col("value")).alias(s) for s, f in stats.items()]))


def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows ``(column, n_missing, mean, std, min, max)`` over each numeric column's values.

    Tasks work through whole batches and give one entry per column, which are then combined. No
    rows, no entries. NaN counts as larger than any number, as in Spark's own aggregates.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = np.zeros((len(cols), 6))  # rows missing, rows there, their sum, squares about their mean, least, most
        facts[:, 4:] = np.nan
        seen = False
        for batch in batches:
            seen = seen or batch.num_rows > 0
            flat = batch.column(0).flatten()
            there = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, len(cols))
            values = flat.to_numpy(zero_copy_only=False).reshape(-1, len(cols))
            for f, ok, v in zip(facts, there.T, values.T):
                v = v[ok]
                f[0] += len(ok) - len(v)
                if len(v):
                    with np.errstate(invalid="ignore", over="ignore"):
                        total = v.sum()
                        squares, n = np.square(v - total / len(v)).sum(), f[1]
                        if n:
                            squares += f[3] + (total / len(v) - f[2] / n) ** 2 * n * len(v) / (n + len(v))
                    f[4] = np.fmin(f[4], np.fmin.reduce(v))
                    f[5] = np.maximum(f[5], v.max()) if n else v.max()
                    f[1:4] = n + len(v), f[2] + total, squares
        if seen:
            there = facts[:, 1] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols, pa.string()), pa.array(facts[:, 0].astype(np.int64)), pa.array(facts[:, 1].astype(np.int64)),
                 *[pa.array(facts[:, i], mask=~there, from_pandas=False) for i in range(2, 6)]], ["column", "gaps", "n", "s", "q", "low", "high"])

    cols = list(cols)
    wide = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("cells"))
    parts = wide.mapInArrow(run, "column string, gaps long, n long, s double, q double, low double, high double")
    whole = Window.partitionBy("column")
    mean = F.sum("s").over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    off = F.col("s") / F.nullif(F.col("n"), F.lit(0)) - F.col("_mean")
    n = F.sum("n")
    return parts.withColumn("_mean", mean).groupBy("column").agg(
        F.sum("gaps").alias("n_missing"), (F.sum("s") / F.nullif(n, F.lit(0))).alias("mean"),
        F.when(n > 1, F.sqrt(F.sum(F.col("q") + F.col("n") * off * off) / F.nullif(n - 1, F.lit(0)))).alias("std"),
        F.min("low").alias("min"), F.max("high").alias("max"))


def missing(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Missing count and percentage (2 places) per column, per group when ``by`` is given."""
    cols = cols or [c for c in df.columns if c not in by]
    gaps = df.select(*by, *[F.col(c).isNull().cast("int").alias(f"_gap{i}") for i, c in enumerate(cols)])
    counts = gaps.groupBy(*by).agg(F.count("*").alias("_n"), *[F.sum(f"_gap{i}").alias(f"_gap{i}") for i in range(len(cols))])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"_gap{i}"), F.lit(0)).alias("n_missing"))
                      for i, c in enumerate(cols)])
    out = counts.select(*by, "_n", F.inline(cells))
    share = F.round(100.0 * F.col("n_missing") / F.nullif(F.col("_n"), F.lit(0)), 2)
    return out.withColumn("pct_missing", share).drop("_n")


CELLS_HELD = 1 << 19  # values of a column that a task holds before it sends the distinct ones on
BUCKETS = 1024  # in which the values of a column are counted


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False,
                    log2_size: int = 14) -> DataFrame:
    """Distinct non-null values per column; ``approx`` uses a sketch and needs no shuffle of values.

    Numbers with a fraction travel in packed blocks of distinct values, the others as Spark's own aggregate has them.
    """
    cols = list(cols or df.columns)

    def count(c: str) -> Column:
        if not approx:
            return F.count_distinct(c)
        return F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(c)), log2_size))

    packed = [] if approx else [c for c in cols if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    if not packed:
        return per_column(df, cols, {"n_distinct": count})
    blocks = df.select(*[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(packed)]).mapInArrow(
        _distinct_blocks, "_c int, _bucket int, _values binary")
    found = blocks.repartition("_c", "_bucket").sortWithinPartitions("_c", "_bucket").mapInArrow(_count_blocks, "_c int, _n long")
    whole = found.agg(*[F.coalesce(F.sum(F.when(F.col("_c") == i, F.col("_n"))), F.lit(0)).alias(f"_n{i}") for i in range(len(packed))])
    others = [c for c in cols if c not in packed]
    if others:
        whole = whole.crossJoin(df.agg(*[count(c).alias(f"_o{i}") for i, c in enumerate(others)]))
    at = {**{c: f"_n{i}" for i, c in enumerate(packed)}, **{c: f"_o{i}" for i, c in enumerate(others)}}
    return whole.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(at[c]).alias("n_distinct")) for c in cols])))


def _distinct_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct values of each column of a task's rows, a block a bucket of their bits; NaN equals NaN and -0.0 equals 0.0."""
    held: dict[int, list[np.ndarray]] = {}
    size: dict[int, int] = {}

    def sent(i: int, values: np.ndarray) -> pa.RecordBatch:
        bucket = ((values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(BUCKETS)
        order = np.argsort(bucket, kind="stable")
        values, bucket = values[order], bucket[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(starts), i, np.int32)), pa.array(bucket[starts].astype(np.int32)),
             pa.array([v.tobytes() for v in np.split(values, starts[1:])], pa.binary())], ["_c", "_bucket", "_values"])

    for batch in batches:
        for i, column in enumerate(batch.columns):
            v = column.drop_null().to_numpy(zero_copy_only=False) + 0.0
            v[np.isnan(v)] = np.nan  # one pattern of bits
            held.setdefault(i, []).append(v)
            size[i] = size.get(i, 0) + len(v)
            if size[i] > CELLS_HELD:
                values = np.unique(np.concatenate(held[i]))
                if len(values) > CELLS_HELD // 2:
                    yield sent(i, values)
                    values = values[:0]
                held[i], size[i] = [values], len(values)
    for i, parts in held.items():
        values = np.unique(np.concatenate(parts))
        if len(values):
            yield sent(i, values)


def _count_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct values of each bucket, whose blocks follow each other."""
    counts: dict[int, int] = {}
    last, parts = None, []

    def close() -> None:
        if parts:
            counts[last[0]] = counts.get(last[0], 0) + len(np.unique(np.concatenate(parts)))

    for batch in batches:
        for i, (c, bucket) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if (c, bucket) != last:
                close()
                last, parts = (c, bucket), []
            parts.append(np.frombuffer(batch.column(2)[i].as_py(), np.float64))
    close()
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["_c", "_n"])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def sign_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return per_cell(df, cols, {"n_negative": lambda v: F.count_if(v < 0), "n_zero": lambda v: F.count_if(v == 0)})


def clipping(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Rows sitting exactly on a column's minimum and maximum, flagged when either exceeds ``k``."""
    ends = df.agg(F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c)
                             for c in cols]).alias("_ends")).scalar()
    marked = df.select(*cols, ends.alias("_ends"))
    at = {e: (lambda c, e=e: F.count_if(F.col(c) == F.col(f"_ends.{c}.{e}"))) for e in ("lo", "hi")}
    out = per_column(marked, cols, {"min": F.min, "max": F.max, "n_at_min": at["lo"], "n_at_max": at["hi"]})
    return out.withColumn("clipped", (F.col("n_at_min") > k) | (F.col("n_at_max") > k))


def describe(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, range and quartiles per column."""
    plain = per_cell(df, cols, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    q = quantiles(df, cols, QUARTILES, accuracy=accuracy).drop("n")
    return plain.join(F.broadcast(q), "column", "left").select(
        "column", "count", "mean", "std", "min", *QUARTILES, "max")


def extremes(df: DataFrame, cols: Sequence[str], iqr_factor: float = 1.5, z_limit: float = 3.0,
             accuracy: int | None = None) -> DataFrame:
    """Outlier counts and range per column.

    ``iqr_outliers`` lie strictly outside the quartiles widened by ``iqr_factor`` interquartile
    ranges. ``robust_z_outliers`` are further than ``z_limit`` from the median in units of 1.4826
    MAD, or of the sample deviation when the MAD is zero; with neither there are none.
    """
    cols = list(cols)
    q = quantile_values(df, cols, QUARTILES, accuracy)
    cols = [c for c in cols if c in q]
    away = df.select(*[F.abs(F.col(c) - F.lit(q[c]["p50"])).alias(c) for c in cols])
    mad = quantile_values(away, cols, {"mad": 0.5}, accuracy)
    flat = [c for c in cols if not mad[c]["mad"] > 0]
    std = df.agg(*[F.stddev_samp(c).alias(c) for c in flat]).first().asDict() if flat else {}
    scale = {c: std[c] if c in std else mad[c]["mad"] * 1.4826 for c in cols}

    limits = df.sparkSession.createDataFrame(
        [(c, q[c]["p25"] - iqr_factor * (q[c]["p75"] - q[c]["p25"]), q[c]["p75"] + iqr_factor * (q[c]["p75"] - q[c]["p25"]),
          q[c]["p50"], mad[c]["mad"], scale[c] or None) for c in cols],
        "column string, low double, high double, median double, mad double, scale double")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    v = F.col("value")
    # one row of limits per column
    return (df.select(F.inline(cells)).join(F.broadcast(limits), "column").groupBy("column", "median", "mad").agg(
        F.count_if((v < F.col("low")) | (v > F.col("high"))).alias("iqr_outliers"),
        F.count_if(F.abs((v - F.col("median")) / F.col("scale")) > z_limit).alias("robust_z_outliers"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
        .select("column", "iqr_outliers", "robust_z_outliers", "min", "max", "mean", "median", "std", "mad"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def flag_rate(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Rows hit by each flag, and by any, with the overall rate."""
    hit = {k: F.coalesce(c, F.lit(False)) for k, c in flags.items()}
    anywhere = F.lit(False)
    for c in hit.values():
        anywhere = anywhere | c
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(f"n_{k}") for k, c in hit.items()],
                  F.count_if(anywhere).alias("n_flagged"),
                  (F.count_if(anywhere) / F.count("*")).alias("flag_rate"))


def drop_constant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the columns of ``cols`` with at most one distinct value. One aggregate decides."""
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if ends[c]["lo"] == ends[c]["hi"] or ends[c]["lo"] is None])


def catalog(train: DataFrame, test: DataFrame, cols: Sequence[str], decimals: int = 4) -> DataFrame:
    """Per feature: missing in train and test, and the train column's mean, deviation and range."""
    stats = column_moments(train, cols).select(
        "column", F.col("n_missing").alias("n_missing_train"), *[F.round(c, decimals).alias(c) for c in ("mean", "std", "min", "max")])
    there = [c for c in cols if c in test.columns]
    other = column_moments(test, there).select("column", F.col("n_missing").alias("n_missing_test"))
    return (stats.join(F.broadcast(other), "column", "left")
            .select(F.col("column").alias("feature"), "n_missing_train", "n_missing_test", "mean", "std",
                    "min", "max"))
