"""Exact order statistics of large columns without a global sort in one task.

Both ways start from a quantile sketch, one scan whose result is a few numbers per column:

* ``quantiles`` uses the sketch to bracket every wanted rank and, while a bracket still spans many
  rows, sketches its inside to narrow it. A last scan counts what lies between the brackets and keeps
  only the values inside them. No scan shuffles more than that.
* ``running_counts`` uses it for range buckets. Rows collapse to one row per distinct value, so a
  value shared by a third of all rows costs one row; running totals inside a bucket come from a
  window over that bucket, and the totals of lower buckets are added.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.sources.shared import settled

# rank error of the sketches is 1/SKETCH; a bracket wider than BRACKET_ROWS rows is narrowed first
SKETCH = 4_000
BRACKET_ROWS = 4_000_000
MAX_CLASSES = 10_000


def n_partitions(df: DataFrame) -> int:
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def as_doubles(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    kept = [c for c in dict.fromkeys(keep) if c not in cols]
    return df.select(*kept, *[F.col(c).cast("double").alias(c) for c in dict.fromkeys(cols)])


def class_rows(table: DataFrame, columns: int = 1) -> list:
    """Collect a table with one row per class and column, after checking that there are few classes."""
    most = MAX_CLASSES * max(columns, 1)
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {MAX_CLASSES} classes: {table.columns}")
    return rows


def long_cells(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows ``(_key, column, value)``, one per non-null cell; ``_key`` holds the class columns."""
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    return (df.select(key.alias("_key"), F.inline(cells)).filter(F.col("value").isNotNull()))


def _with_edges(cells: DataFrame, edges: dict, n: int) -> DataFrame:
    """Cells next to their series' bracket edges ``_e0…``: one small row per class and column."""
    key_type = cells.schema["_key"].dataType
    fields = [T.StructField("_key", key_type, False), T.StructField("column", T.StringType(), False)]
    fields += [T.StructField(f"_e{i}", T.DoubleType()) for i in range(2 * n)]
    table = cells.sparkSession.createDataFrame([(k, c, *e) for (k, c), e in edges.items()], T.StructType(fields))
    return cells.join(F.broadcast(table), ["_key", "column"])


def _narrow(cells: DataFrame, edges: dict, sizes: dict, probs: Sequence[float]) -> tuple[dict, float]:
    """One scan: sketch the inside of every bracket and cut it down around its wanted rank."""
    grid = [i / 500 for i in range(501)]
    v = F.col("value")
    inside = [(v >= F.col(f"_e{2 * i}")) & (v <= F.col(f"_e{2 * i + 1}")) for i in range(len(probs))]
    rows = _with_edges(cells, edges, len(probs)).groupBy("_key", "column").agg(
        *[F.count_if(v < F.col(f"_e{2 * i}")).alias(f"b{i}") for i in range(len(probs))],
        *[F.count_if(on).alias(f"n{i}") for i, on in enumerate(inside)],
        *[F.percentile_approx(F.when(on, v), grid, SKETCH).alias(f"q{i}") for i, on in enumerate(inside)]).collect()
    out, widest = {}, 0.0
    for r in rows:
        k = (tuple(r["_key"]), r["column"])
        cut = []
        for i, p in enumerate(probs):
            rank = (sizes[k] - 1) * p - r[f"b{i}"]
            share = rank / max(r[f"n{i}"] - 1, 1)
            reach = 3.0 / SKETCH + 2.0 / max(r[f"n{i}"], 1)
            low = max(0, math.floor((share - reach) * 500))
            high = min(500, math.ceil((share + reach) * 500))
            cut += [r[f"q{i}"][low], r[f"q{i}"][high]]
            if cut[-2] < cut[-1]:
                widest = max(widest, r[f"n{i}"] * (high - low) / 500)
        out[k] = cut
    return out, widest


def quantiles(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = (),
              accuracy: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles as rows ``(by…, column, n, <name>…)``; NULLs are skipped.

    Exact by default. With ``accuracy`` the sketch alone answers, with a rank error of 1/accuracy.
    ``by`` are class columns such as labels and folds.
    """
    cols, by, names = list(cols), list(by), sorted(probs, key=lambda k: probs[k])
    base = as_doubles(df, cols, by)
    cells = long_cells(base, cols, by)
    margin = 3.0 / SKETCH
    asked = [probs[k] for k in names] if accuracy else [
        min(1.0, max(0.0, probs[k] + s * margin)) for k in names for s in (-1, 1)]
    sketched = cells.groupBy("_key", "column").agg(
        F.count("*").alias("n"), F.percentile_approx("value", asked, accuracy or SKETCH).alias("_q"))
    keys = [F.col("_key")[b].alias(b) for b in by]
    if accuracy:
        return sketched.select(*keys, "column", "n", *[F.get("_q", F.lit(names.index(k))).alias(k) for k in probs])

    found = class_rows(sketched, len(cols))
    edges = {(tuple(r["_key"]), r["column"]): list(r["_q"]) for r in found}
    sizes = {(tuple(r["_key"]), r["column"]): r["n"] for r in found}
    widest = 2 * margin * max(sizes.values(), default=0)
    while widest > BRACKET_ROWS:
        edges, width = _narrow(cells, edges, sizes, [probs[k] for k in names])
        if width >= widest:  # only values that repeat are left inside, and those collapse below
            break
        widest = width
    # slot 2i lies below bracket i, slot 2i+1 is bracket i, the last slot is above all of them
    value = F.col("value")
    slot = F.when(value < F.col("_e0"), F.lit(0))
    for i in range(1, 2 * len(names)):
        slot = slot.when(value <= F.col(f"_e{i}") if i % 2 else value < F.col(f"_e{i}"), F.lit(i))
    placed = _with_edges(cells, edges, len(names)).withColumn("_slot", slot.otherwise(F.lit(2 * len(names))))
    counted = (placed.select("_key", "column", "_slot", F.when(F.col("_slot") % 2 == 1, value).alias("value"))
               .groupBy("_key", "column", "_slot", "value").agg(F.count("*").alias("_m")))
    series = Window.partitionBy("_key", "column")
    end = F.sum("_m").over(series.orderBy("_slot", "value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.select("_key", "column", "value", end.alias("_end"), (end - F.col("_m")).alias("_start"),
                            F.sum("_m").over(series).alias("n"))
    spot = {k: (F.col("n") - 1) * F.lit(float(probs[k])) for k in names}

    def at(pos: Column) -> Column:
        hit = (F.col("_start") <= pos) & (pos < F.col("_end"))
        return F.max(F.when(hit, F.coalesce(
            F.col("value"), F.raise_error(F.lit("a wanted rank fell outside its bracket")).cast("double"))))

    picked = ranked.groupBy("_key", "column").agg(
        F.max("n").alias("n"), *[at(F.floor(spot[k])).alias(f"_lo_{k}") for k in names],
        *[at(F.ceil(spot[k])).alias(f"_hi_{k}") for k in names])
    return picked.select(*keys, "column", "n", *[
        (F.col(f"_lo_{k}") + (F.col(f"_hi_{k}") - F.col(f"_lo_{k}")) * (spot[k] - F.floor(spot[k]))).alias(k)
        for k in probs])


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float],
                    accuracy: int | None = None) -> dict[str, dict[str, float]]:
    """The quantiles of some columns on the driver: ``{column: {name: value}}``; empty columns absent."""
    return {r["column"]: {k: r[k] for k in probs}
            for r in quantiles(df, cols, probs, accuracy=accuracy).collect()}


def running_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                   counts: Mapping[str, Column] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per ``(by…, column, value)`` with counts, totals at smaller values and series totals.

    ``counts`` maps a name to a counting aggregate, which may read the columns ``keep``; the default
    is ``n``. Each count ``c`` comes with ``c_below`` and ``c_total``.
    """
    cols, by = list(cols), list(by)
    counts = dict(counts or {"n": F.count("*")})
    base = as_doubles(df, cols, [*by, *keep])
    n = n_partitions(df)
    probs = [i / n for i in range(1, n)]
    edges = base.agg(*[F.percentile_approx(c, probs, max(1000, 10 * n)).alias(c) for c in cols]).first()
    splits = {c: sorted({float(e) for e in edges[c] or [] if math.isfinite(e)}) or [0.0] for c in cols}
    placed = Bucketizer(
        inputCols=cols, outputCols=[f"_b_{c}" for c in cols], handleInvalid="keep",
        splitsArray=[[-math.inf, *splits[c], math.inf] for c in cols]).transform(base)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_b_{c}").cast("int").alias("_bucket"),
                               F.col(c).alias("value")) for c in cols])
    carried = list(dict.fromkeys([*by, *keep]))
    # written once: both the bucket totals and the rows inside the buckets read it
    collapsed = settled(placed.select(*carried, F.inline(cells)).filter(F.col("value").isNotNull())
                        .groupBy(*by, "column", "_bucket", "value").agg(*[a.alias(k) for k, a in counts.items()]), "values")
    bucket = [*by, "column", "_bucket"]
    series = Window.partitionBy(*by, "column")
    lower = series.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = (collapsed.groupBy(*bucket).agg(*[F.sum(c).alias(f"_s_{c}") for c in counts])
               .select(*bucket, *[F.coalesce(F.sum(f"_s_{c}").over(lower), zero).alias(f"_o_{c}") for c in counts],
                       *[F.sum(f"_s_{c}").over(series).alias(f"{c}_total") for c in counts]))
    inside = Window.partitionBy(*bucket).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    within = collapsed.select("*", *[F.coalesce(F.sum(c).over(inside), zero).alias(f"_i_{c}") for c in counts])
    right = offsets.select(*[F.col(b).alias(f"_k_{b}") for b in bucket],
                           *[c for c in offsets.columns if c not in bucket])
    same = [F.col(b).eqNullSafe(F.col(f"_k_{b}")) if b in by else F.col(b) == F.col(f"_k_{b}") for b in bucket]
    joined = within.join(right, same)
    return joined.select(*by, "column", "value", *counts,
                         *[(F.col(f"_o_{c}") + F.col(f"_i_{c}")).alias(f"{c}_below") for c in counts],
                         *[f"{c}_total" for c in counts])


def average_rank(descending: bool = False) -> Column:
    """Average rank of a value, from the columns of ``running_counts``."""
    below = F.col("n_total") - F.col("n_below") - F.col("n") if descending else F.col("n_below")
    return below + (F.col("n") + 1) / 2


def percent_rank() -> Column:
    """Share of rows strictly below a value, over n - 1, from the columns of ``running_counts``."""
    others = F.col("n_total") - 1
    return F.when(others > 0, F.col("n_below") / others).otherwise(F.lit(0.0))


def average_ranks(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                  descending: bool = False) -> DataFrame:
    """Average rank per distinct value: rows ``(by…, column, value, n, avg_rank)``."""
    return running_counts(df, cols, by).select(*by, "column", "value", "n", average_rank(descending).alias("avg_rank"))


def percent_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of rows strictly below each distinct value, over n - 1: ``(column, value, n, pct_rank)``."""
    return running_counts(df, cols).select("column", "value", "n", percent_rank().alias("pct_rank"))
