"""Quantile bins, equal-width bins, and the binned tables behind distribution charts."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.audit import per_column
from plumbline.operators.ordered import class_rows, quantile_values, quantiles


def edge_names(n: int) -> dict[str, float]:
    return {f"q{i}": i / n for i in range(n + 1)}


def quantile_bin(value: Column, edges: Sequence[float]) -> Column:
    """Bin number of ``value`` between ascending quantile edges; bins are closed on the right.

    Repeated edges collapse, so there may be fewer bins; equal edges throughout give NULL.
    """
    inner = sorted({e for e in edges if edges[0] < e < edges[-1]})
    if edges[0] == edges[-1]:
        return F.lit(None).cast("int")
    return F.when(value.isNotNull(), reduce(add, [(value > e).cast("int") for e in inner], F.lit(0)))


def qcut(df: DataFrame, cols: Sequence[str] | str, n: int, suffix: str = "_bin",
         accuracy: int | None = None) -> DataFrame:
    """Add the quantile bin of each column, numbered from 0, edges taken from this table."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    edges = quantile_values(df, cols, edge_names(n), accuracy)
    return df.withColumns({
        f"{c}{suffix}": quantile_bin(F.col(c), list(edges[c].values())) if c in edges
        else F.lit(None).cast("int") for c in cols})


def rate_by_bin(df: DataFrame, cols: Sequence[str], y: Column, n: int = 4,
                accuracy: int | None = None) -> DataFrame:
    """Mean of ``y`` per quantile bin of each column: rows ``(column, bin, n, rate)``."""
    binned = qcut(df.withColumn("_y", y.cast("double")), cols, n, accuracy=accuracy)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_bin").alias("bin")) for c in cols])
    return (binned.select("_y", F.inline(cells)).filter(F.col("bin").isNotNull())
            .groupBy("column", "bin").agg(F.count("*").alias("n"), F.avg("_y").alias("rate")))


def error_by_regime(df: DataFrame, y: str, p: str, terciles: Sequence[str],
                    cuts: Mapping[str, float], accuracy: int | None = None) -> DataFrame:
    """Mean absolute error per tercile of some columns and per side of a cut for others."""
    binned = qcut(df.withColumn("_e", F.abs(F.col(y) - F.col(p))), terciles, 3, accuracy=accuracy)
    regimes = [F.struct(F.lit(c).alias("column"), F.concat(F.lit("tercile "), F.col(f"{c}_bin")).alias("regime"))
               for c in terciles]
    regimes += [F.struct(F.lit(c).alias("column"),
                         F.when(F.col(c) <= at, F.lit(f"<= {at:g}")).when(F.col(c) > at, F.lit(f"> {at:g}"))
                         .alias("regime")) for c, at in cuts.items()]
    return (binned.select("_e", F.inline(F.array(*regimes))).filter(F.col("regime").isNotNull())
            .groupBy("column", "regime").agg(F.count("_e").alias("n"), F.avg("_e").alias("mae")))


def _range_row(df: DataFrame, cols: Sequence[str]) -> Column:
    return df.agg(F.struct(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"))
                             .alias(c) for c in cols]).alias("_r")).scalar()


def _range_values(df: DataFrame, cols: Sequence[str]) -> list[tuple[float | None, float | None]]:
    """Smallest and largest value of each column."""
    row = df.agg(*[f(c).cast("double").alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    return [(row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(cols))]


def equal_width_bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin 0…bins-1 of an equal-width grid over ``[lo, hi]``; the last bin is closed on both sides.

    A constant column gets the grid ``[lo - 0.5, lo + 0.5]``.
    """
    left = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo)
    return F.when(value.isNotNull(),
                  F.least(F.floor((value - left) / width * bins), F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 40, by: Sequence[str] = (),
              density: bool = False) -> DataFrame:
    """Equal-width histogram per column and group: rows ``(by…, column, bin, left, n[, density])``.

    All groups share one grid, spanning the column's range over the whole table.
    """
    cols = list(dict.fromkeys(cols))
    ends = _range_values(df, cols)
    # a cell is a number and a value: the grid of its column is looked up, so the code stays small enough to be compiled
    of = {k: F.array(*[F.lit(e[i]).cast("double") for e in ends]) for i, k in enumerate(("_lo", "_hi"))}
    lo, hi = (F.get(of[k], F.col("_c")) for k in ("_lo", "_hi"))
    cells = df.select(*by, F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("_c", "_v")).filter("_v is not null")
    counted = (cells.select(*by, "_c", equal_width_bin(F.col("_v"), lo, hi, bins).alias("bin"))
               .groupBy(*by, "_c", "bin").agg(F.count("*").alias("n"))
               .select(*by, F.get(F.array(*[F.lit(c) for c in cols]), F.col("_c")).alias("column"), "bin", "n",
                       lo.alias("_lo"), hi.alias("_hi")))
    flat = F.col("_lo") == F.col("_hi")
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo")) / bins
    start = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    out = counted.withColumn("left", start + F.col("bin") * width)
    names = [*by, "column", "bin", "left", "n"]
    if density:
        totals = counted.groupBy(*by, "column").agg(F.sum("n").alias("_total"))
        out = (out.join(F.broadcast(totals), [*by, "column"])  # bins × groups rows on either side
               .withColumn("density", F.col("n") / (F.col("_total") * width)))
        names.append("density")
    return out.select(*names)


def kde(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), grid: int = 50,
        bins: int = 400) -> DataFrame:
    """Gaussian density on an even grid, Scott bandwidth, from pre-binned counts.

    Rows are collapsed to ``bins`` bin centres per column and group first, so the kernel sum is
    bins × grid whatever the table's size. The grid spans each column's range.
    """
    hist = histogram(df, cols, bins, by)
    keys = [*by, "column"]
    spread = per_column(df, cols, {"_n": F.count, "_sd": F.stddev_samp}, by)
    ends = per_column(df, cols, {"_lo": lambda c: F.min(c).cast("double"),
                                 "_hi": lambda c: F.max(c).cast("double")})
    series = (spread.join(F.broadcast(ends), "column")
              .withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
              .filter("_h > 0"))
    step = (F.col("_hi") - F.col("_lo")) / bins
    points = hist.join(F.broadcast(series), keys).select(
        *keys, "n", "_n", "_h", "_lo", "_hi", (F.col("left") + step / 2).alias("_x"),
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    at = F.col("_lo") + F.col("point") * (F.col("_hi") - F.col("_lo")) / (grid - 1)
    z = (at - F.col("_x")) / F.col("_h")
    weight = F.col("n") / (F.col("_n") * F.col("_h") * F.sqrt(2.0 * F.pi()))
    return (points.withColumn("x", at).groupBy(*keys, "point")
            .agg(F.first("x").alias("x"), F.sum(weight * F.exp(-0.5 * z * z)).alias("density")))


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Quartiles and whiskers per column and group; whiskers end at the last point in the fences."""
    q = quantiles(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    q = df.sparkSession.createDataFrame(class_rows(q), q.schema)  # one row per class and column, counted
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    points = (df.select(F.struct(*by).alias("_by"), F.inline(cells)).filter("value is not null")
              .join(F.broadcast(q.withColumn("_by", F.struct(*by)).drop(*by)), ["_by", "column"]))
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("value") >= F.col("q1") - whisker * iqr) & (F.col("value") <= F.col("q3") + whisker * iqr)
    return points.groupBy("_by", "column").agg(
        F.max("n").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outside")).select(
        *[F.col("_by")[b].alias(b) for b in by], "column", "n", "q1", "median", "q3", "whisker_low",
        "whisker_high", "n_outside")


def grid2d(df: DataFrame, x: str, y: str, z: str | None = None, by: Sequence[str] = (), nx: int = 20,
           ny: int = 20) -> DataFrame:
    """Counts, and the mean of ``z``, on a two-dimensional equal-width grid over the table's range."""
    carried = [*by, *([z] if z else [])]
    spanned = df.select(x, y, *[c for c in carried if c not in (x, y)], _range_row(df, [x, y]).alias("_r"))
    bx = equal_width_bin(F.col(x), F.col(f"_r.{x}.lo"), F.col(f"_r.{x}.hi"), nx)
    by_ = equal_width_bin(F.col(y), F.col(f"_r.{y}.lo"), F.col(f"_r.{y}.hi"), ny)
    aggs = [F.count("*").alias("n")] + ([F.avg(z).alias(f"mean_{z}")] if z else [])
    return (spanned.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(*by, bx.alias("x_bin"), by_.alias("y_bin")).agg(*aggs))


def pair_grids(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = (),
               bins: int = 20) -> DataFrame:
    """Two-dimensional counts for many column pairs in one pass: rows ``(by…, x, y, x_bin, y_bin, n)``."""
    cols = sorted({c for pair in pairs for c in pair})
    spanned = df.select(*by, *cols, _range_row(df, cols).alias("_r"))
    place = {c: equal_width_bin(F.col(c), F.col(f"_r.{c}.lo"), F.col(f"_r.{c}.hi"), bins) for c in cols}
    placed = spanned.select(*by, *[place[c].alias(f"_b_{c}") for c in cols])
    cells = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"_b_{a}").alias("x_bin"),
                               F.col(f"_b_{b}").alias("y_bin")) for a, b in pairs])
    return (placed.select(*by, F.inline(cells)).filter("x_bin is not null and y_bin is not null")
            .groupBy(*by, "x", "y", "x_bin", "y_bin").agg(F.count("*").alias("n")))


def log_hist(df: DataFrame, col: str, by: Sequence[str] = (), per_decade: int = 10,
             floor: float = 1e-6) -> DataFrame:
    """Counts in logarithmic bins, ``per_decade`` to a power of ten; values are floored first."""
    bin_ = F.floor(F.log10(F.greatest(F.col(col), F.lit(floor))) * per_decade).cast("int")
    return (df.filter(F.col(col).isNotNull()).groupBy(*by, bin_.alias("log_bin"))
            .agg(F.count("*").alias("n"))
            .withColumn("left", F.pow(F.lit(10.0), F.col("log_bin") / per_decade)))


def pattern_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How often each combination of missing columns occurs."""
    from plumbline.functions.rowwise import miss_pattern

    return df.groupBy(miss_pattern(cols).alias("pattern")).agg(F.count("*").alias("n"))


def pattern_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The patterns present in ``df`` numbered in text order; at most 2^columns rows."""
    from pyspark.sql import Window

    seen = pattern_counts(df, cols).select("pattern")
    return seen.select("pattern", (F.dense_rank().over(Window.orderBy("pattern")) - 1).alias("miss_pattern_code"))


def with_pattern_code(df: DataFrame, codes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Attach fitted pattern codes; a pattern not seen at fitting gets NULL."""
    from plumbline.functions.rowwise import miss_pattern

    return (df.withColumn("pattern", miss_pattern(cols)).join(F.broadcast(codes), "pattern", "left")
            .drop("pattern"))
