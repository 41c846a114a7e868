"""Column relationships and two-sample tests, each from one or two aggregates over the rows."""
from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.pvalues import chi2_1dof, kolmogorov, normal_two_sided, t_two_sided
from plumbline.operators.audit import per_column
from plumbline.operators.bins import qcut
from plumbline.operators.ordered import running_counts
from plumbline.operators.ranks import spearman_sums, two_sample_sums


def no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def pearson(a: Column | str, b: Column | str) -> Column:
    """Pairwise-complete Pearson correlation; NULL when a side is constant.

    Written out, because the built-in one raises on a constant column under ANSI arithmetic.
    """
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))


def corr_matrix(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every column pair, pairwise complete: rows ``(by…, col_a, col_b, r)``."""
    return _pair_corr(df, {(a, b): (F.col(a), F.col(b)) for a, b in combinations(cols, 2)}, by)


def _pair_corr(df: DataFrame, pairs: Mapping[tuple[str, str], tuple[Column, Column]], by: Sequence[str] = ()) -> DataFrame:
    """Correlation of many pairs: each row meets every pair inside its task, sums combine there."""
    cells = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), x.cast("double").alias("_x"),
                               y.cast("double").alias("_y")) for (a, b), (x, y) in pairs.items()])
    return df.select(*by, F.inline(cells)).groupBy(*by, "col_a", "col_b").agg(pearson("_x", "_y").alias("r"))


def spearman_matrix(df: DataFrame, cols: Sequence[str], id: str) -> DataFrame:
    """Spearman correlation of every pair, average ranks over each pair's complete rows.

    Ranks depend on which rows the partner column has, so each value gets one rank among all rows and
    one for each column with gaps; all partners without gaps share the first. The ranks meet again by ``id``.
    """
    return spearman_sums(df, cols, id)


def _t_of_r(r: Column, n: Column) -> Column:
    return r * F.sqrt((n - 2) / F.nullif(1 - r * r, F.lit(0.0)))


def feature_corr(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Pearson r of each column with ``y``, its t statistic, two-sided p-value and row count."""
    base = per_column(df, cols, {"r": lambda c: pearson(c, y),
                                 "n": lambda c: F.count_if(F.col(c).isNotNull() & F.col(y).isNotNull())})
    return (base.withColumn("t", _t_of_r(F.col("r"), F.col("n")))
            .withColumn("p", t_two_sided(F.col("t"), F.col("n") - 2)))


def point_biserial(df: DataFrame, cols: Sequence[str], flag: Column) -> DataFrame:
    """Correlation of each column with a 0/1 flag."""
    return feature_corr(df.withColumn("_flag", flag.cast("double")), cols, "_flag")


def rank_by_corr(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Absolute correlation with ``y``, largest first."""
    r = _pair_corr(df, {(c, y): (F.col(c), F.col(y)) for c in cols})
    return (r.select(F.col("col_a").alias("column"), F.abs("r").alias("abs_r"))
            .orderBy(F.col("abs_r").desc_nulls_last(), "column"))


def irrelevance(df: DataFrame, col: str, others: Sequence[str]) -> DataFrame:
    """Largest absolute correlation of one column with any other."""
    return df.agg(F.greatest(*[F.abs(pearson(col, c)) for c in others]).alias("max_abs_r")).select(
        F.lit(col).alias("column"), "max_abs_r")


def linear_r2(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """R² of the straight line through each column and ``y``."""
    return per_column(df, cols, {"r2": lambda c: no_nan(F.regr_r2(F.col(y).cast("double"), F.col(c).cast("double")))})


def poly_moments(df: DataFrame, cols: Sequence[str], y: str, degree: int) -> DataFrame:
    """One pass of centred and scaled power sums per column, enough to fit any degree up to ``degree``."""
    ends = df.agg(F.struct(*[F.struct(
        F.avg(F.when(F.col(y).isNotNull(), F.col(c))).alias("m"),
        F.nullif(F.stddev_pop(F.when(F.col(y).isNotNull(), F.col(c))), F.lit(0.0)).alias("s"))
        .alias(c) for c in cols]).alias("_e")).scalar()
    base = df.select(*dict.fromkeys([*cols, y]), ends.alias("_e")).filter(F.col(y).isNotNull())

    def power(c: str, k: int) -> Column:
        z = (F.col(c) - F.col(f"_e.{c}.m")) / F.col(f"_e.{c}.s")
        out = F.when(F.col(c).isNotNull(), F.lit(1.0))
        for _ in range(k):
            out = out * z
        return out

    return per_column(base, cols, {
        "n": lambda c: F.count(c), "center": lambda c: F.max(F.col(f"_e.{c}.m")),
        "scale": lambda c: F.max(F.col(f"_e.{c}.s")),
        "xs": lambda c: F.array(*[F.sum(power(c, k)) for k in range(2 * degree + 1)]),
        "xy": lambda c: F.array(*[F.sum(power(c, k) * F.col(y)) for k in range(degree + 1)]),
        "yy": lambda c: F.sum(F.when(F.col(c).isNotNull(), F.col(y) * F.col(y)))})


def poly_fit(df: DataFrame, cols: Sequence[str], y: str, degrees: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Least-squares polynomial of each degree through each column and ``y``.

    Rows ``(column, degree, n, r2, center, scale, coefficients)``; coefficients are in powers of
    ``(x - center) / scale``, lowest first.
    """
    moments = poly_moments(df, cols, y, max(degrees))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                for d in degrees:
                    if row.scale is None or math.isnan(row.scale):
                        out.append((row.column, d, row.n, None, row.center, row.scale, None))
                        continue
                    a = np.array([[row.xs[i + j] for j in range(d + 1)] for i in range(d + 1)])
                    b = np.asarray(row.xy[:d + 1])
                    w = np.linalg.lstsq(a, b, rcond=None)[0]
                    total = row.yy - row.xy[0] ** 2 / row.n
                    r2 = 1 - (row.yy - w @ b) / total if total > 0 else None
                    out.append((row.column, d, row.n, r2, row.center, row.scale, list(w)))
            yield pd.DataFrame(out, columns=["column", "degree", "n", "r2", "center", "scale", "coefficients"])

    return moments.mapInPandas(solve, "column string, degree int, n long, r2 double, center double, "
                                      "scale double, coefficients array<double>")


def trend_curve(df: DataFrame, cols: Sequence[str], y: str, degrees: Sequence[int] = (1, 2, 3),
                grid: int = 50) -> DataFrame:
    """Fitted polynomial curves sampled on an even grid over each column's range."""
    ends = per_column(df.filter(F.col(y).isNotNull()), cols, {
        "_lo": lambda c: F.min(c).cast("double"), "_hi": lambda c: F.max(c).cast("double")})
    fits = poly_fit(df, cols, y, degrees).filter("coefficients is not null")
    points = (fits.join(F.broadcast(ends), "column")
              .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
              .withColumn("x", F.col("_lo") + F.col("point") * (F.col("_hi") - F.col("_lo")) / (grid - 1)))
    z = (F.col("x") - F.col("center")) / F.col("scale")
    curve = F.aggregate(F.reverse("coefficients"), F.lit(0.0), lambda acc, w: acc * z + w)
    return points.select("column", "degree", "point", "x", curve.alias("y"))


def mutual_info(df: DataFrame, cols: Sequence[str], y: str, bins: int = 10, classes: bool = False,
                accuracy: int | None = None) -> DataFrame:
    """Mutual information (nats) of each column with ``y`` over equal-frequency bins.

    ``y`` is binned too, or taken as it is when it holds ``classes``. Bin pairs are counted for
    all columns in one aggregate. Rows where a side is NULL are left out.
    """
    binned = qcut(df, cols if classes else [*cols, y], bins, accuracy=accuracy)
    target = F.col(y if classes else f"{y}_bin").cast("string")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_bin").alias("bx")) for c in cols])
    joint = (binned.select(target.alias("by"), F.inline(cells)).filter("bx is not null and by is not null")
             .groupBy("column", "bx", "by").agg(F.count("*").alias("n")))
    return _information(joint)


def _information(joint: DataFrame) -> DataFrame:
    """Mutual information from a table of bin-pair counts; the table has bins² rows per column."""
    from pyspark.sql import Window

    per = Window.partitionBy("column")
    sums = joint.select("column", "n", F.sum("n").over(per).alias("t"),
                        F.sum("n").over(Window.partitionBy("column", "bx")).alias("nx"),
                        F.sum("n").over(Window.partitionBy("column", "by")).alias("ny"))
    p = F.col("n") / F.col("t")
    return sums.groupBy("column").agg(
        F.sum(p * F.log(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny").cast("double")))).alias("mutual_info"))


def cross_products(df: DataFrame, cols: Sequence[str], centred: bool) -> DataFrame:
    """One row holding the matrix of pairwise products over complete rows, for a few columns.

    ``centred`` gives population covariances, otherwise raw sums of products.
    """
    complete = df.select(*cols).dropna()
    pair = (lambda a, b: F.covar_pop(a, b)) if centred else (lambda a, b: F.sum(F.col(a) * F.col(b)))
    flat = [pair(a, b) if i <= j else pair(b, a) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return complete.agg(F.count("*").alias("n"), F.array(*flat).alias("g"))


def partial_corr(df: DataFrame, cols: Sequence[str], y: str, controls: Sequence[str]) -> DataFrame:
    """Correlation of each column with ``y`` once the controls are regressed out of both.

    Each column uses its own complete rows. The inverse of a small covariance matrix gives the
    result, so the rows are read once per column.
    """
    controls = list(controls)
    size = len(controls) + 2

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                g = np.asarray(row.g, dtype=float).reshape(size, size)
                scale = np.sqrt(np.diag(g))
                r = None
                if np.all(scale > 0):
                    inv = np.linalg.pinv(g / np.outer(scale, scale), hermitian=True)
                    r = float(-inv[-2, -1] / math.sqrt(inv[-2, -2] * inv[-1, -1]))
                out.append((row.column, row.n, r))
            yield pd.DataFrame(out, columns=["column", "n", "partial_r"])

    # one aggregate for all columns: a pair counts only where the column and all others are present
    needed = [*controls, y]
    there = df.dropna(subset=needed)

    def gram(c: str) -> Column:
        names = [*controls, c, y]
        on = [F.when(F.col(c).isNotNull(), F.col(v)) for v in names]
        return F.array(*[F.covar_pop(on[min(i, j)], on[max(i, j)]) for i in range(size) for j in range(size)])

    return per_column(there, cols, {"n": F.count, "g": gram}).mapInPandas(
        solve, "column string, n long, partial_r double")


def vif(df: DataFrame, cols: Sequence[str], intercept: bool = False) -> DataFrame:
    """Variance inflation factor over complete rows.

    Without ``intercept`` the columns are not centred, which is what regressing each column on the
    others through the origin gives; with it, the usual centred factor.
    """
    cols = list(cols)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                g = np.asarray(row.g, dtype=float).reshape(len(cols), len(cols))
                scale = np.sqrt(np.diag(g))
                scaled = g / np.outer(scale, scale)
                yield pd.DataFrame({"column": cols, "vif": np.diag(np.linalg.inv(scaled))})

    return cross_products(df, cols, intercept).mapInPandas(solve, "column string, vif double")


def bootstrap_corr(df: DataFrame, cols: Sequence[str], y: str, id: str, resamples: int = 1000,
                   seed: int = 42, level: float = 0.95) -> DataFrame:
    """Percentile interval of each Pearson correlation under resampling of rows.

    Each row gets a Poisson(1) weight per resample, drawn from a hash of its id, so the draw does not
    depend on partitioning. A task turns a few rows at a time into a matrix of weights, multiplies it
    with their products and sends on one row per column and resample.
    """
    cols = list(cols)
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    used = list(dict.fromkeys([*cols, y]))
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in used]).alias("m")).scalar()
    centred = df.select(F.xxhash64(F.col(id), F.lit(seed)).alias("_h"), means.alias("_m"), *used).select(
        "_h", *[(F.col(c) - F.col(f"_m.{c}")).cast("double").alias(c) for c in used])
    names = ["w", "x", "y", "xx", "yy", "xy"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((resamples, 6 * len(cols)))
        steps = np.arange(1, resamples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at:at + 1024]
                z = part["_h"].to_numpy().astype(np.int64).view(np.uint64)[:, None] + steps[None, :]
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
                u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53
                weight = np.searchsorted(cdf, u).astype(float)
                b = part[y].to_numpy(float)
                terms = []
                for c in cols:
                    a = part[c].to_numpy(float)
                    both = ~(np.isnan(a) | np.isnan(b))
                    p, q = np.where(both, a, 0.0), np.where(both, b, 0.0)
                    terms += [both.astype(float), p, q, p * p, q * q, p * q]
                total += weight.T @ np.stack(terms, 1)
        for k, c in enumerate(cols):
            yield pd.DataFrame({"column": c, "_b": np.arange(resamples),
                                **{n: total[:, 6 * k + i] for i, n in enumerate(names)}})

    per = centred.mapInPandas(run, "column string, _b long, " + ", ".join(f"{n} double" for n in names)).groupBy(
        "column", "_b").agg(*[F.sum(n).alias(n) for n in names])
    s = {n: F.col(n) for n in names}
    cov = s["xy"] - s["x"] * s["y"] / s["w"]
    spread = F.sqrt((s["xx"] - s["x"] * s["x"] / s["w"]) * (s["yy"] - s["y"] * s["y"] / s["w"]))
    tail = (1 - level) / 2
    # at most `resamples` values per column
    return (per.filter("w > 0").withColumn("r", cov / F.nullif(spread, F.lit(0.0)))
            .groupBy("column").agg(F.count("r").alias("resamples"), F.avg("r").alias("mean_r"),
                                   F.percentile("r", tail).alias("ci_low"),
                                   F.percentile("r", 1 - tail).alias("ci_high")))


def corr_by_fold(df: DataFrame, cols: Sequence[str], y: str, fold: str) -> DataFrame:
    """Mean and population deviation over folds of each column's correlation with ``y``."""
    per_fold = _pair_corr(df, {(c, y): (F.col(c), F.col(y)) for c in cols}, [fold]).withColumnRenamed("col_a", "column")
    return per_fold.groupBy("column").agg(F.count("r").alias("folds"), F.avg("r").alias("mean_r"),
                                          F.stddev_pop("r").alias("std_r"))


def cohens_d(df: DataFrame, cols: Sequence[str], flag: Column, population: bool = True) -> DataFrame:
    """Standardised mean difference, flagged minus unflagged.

    ``population`` pools population variances weighted by n - 1; otherwise sample variances.
    """
    var = F.var_pop if population else F.var_samp
    marked = df.withColumn("_f", flag)
    on = lambda c, v: F.when(F.col("_f") == F.lit(v), F.col(c))
    base = per_column(marked, cols, {
        "n0": lambda c: F.count(on(c, False)), "n1": lambda c: F.count(on(c, True)),
        "m0": lambda c: F.avg(on(c, False)), "m1": lambda c: F.avg(on(c, True)),
        "v0": lambda c: var(on(c, False)), "v1": lambda c: var(on(c, True))})
    pooled = F.sqrt(((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1"))
                    / F.nullif((F.col("n0") + F.col("n1") - 2).cast("double"), F.lit(0.0)))
    d = F.when(pooled > 0, (F.col("m1") - F.col("m0")) / pooled).otherwise(F.lit(0.0))
    return base.select("column", "n0", "n1", d.alias("cohens_d"))


def welch_t(df: DataFrame, cols: Sequence[str], flag: Column) -> DataFrame:
    """Welch's t of unflagged against flagged rows, its degrees of freedom and two-sided p-value."""
    marked = df.withColumn("_f", flag)
    on = lambda c, v: F.when(F.col("_f") == F.lit(v), F.col(c))
    base = per_column(marked, cols, {
        "n0": lambda c: F.count(on(c, False)), "n1": lambda c: F.count(on(c, True)),
        "m0": lambda c: F.avg(on(c, False)), "m1": lambda c: F.avg(on(c, True)),
        "v0": lambda c: F.var_samp(on(c, False)), "v1": lambda c: F.var_samp(on(c, True))})
    e0, e1 = F.col("v0") / F.col("n0"), F.col("v1") / F.col("n1")
    se2 = e0 + e1
    t = (F.col("m0") - F.col("m1")) / F.nullif(F.sqrt(se2), F.lit(0.0))
    dof = se2 * se2 / F.nullif(e0 * e0 / (F.col("n0") - 1) + e1 * e1 / (F.col("n1") - 1), F.lit(0.0))
    both = (F.col("n0") > 1) & (F.col("n1") > 1)
    out = base.filter(both).select("column", "n0", "n1", t.alias("t"), dof.alias("dof"))
    return out.withColumn("p", t_two_sided(F.col("t"), F.col("dof")))


def rank_sums(df: DataFrame, cols: Sequence[str], flag: Column, by: Sequence[str] = ()) -> DataFrame:
    """Per column: class sizes, rank sum of flagged rows and the tie term, all exact.

    Rows ``(by…, column, n0, n1, rank_sum, ties)`` where ``ties`` sums ``t³ - t`` over equal values.
    """
    if not by:
        return df.sparkSession.createDataFrame([r[:-1] for r in two_sample_sums(df, cols, flag)],
                                               "column string, n0 long, n1 long, rank_sum double, ties double")
    marked = df.withColumn("_f", flag)
    run = running_counts(marked, cols, by, {"n": F.count("*"), "n1": F.count_if(F.col("_f"))}, ["_f"])
    n = F.col("n").cast("double")
    return run.groupBy(*by, "column").agg(
        (F.sum("n") - F.sum("n1")).alias("n0"), F.sum("n1").alias("n1"),
        F.sum(F.col("n1") * (F.col("n_below") + (n + 1) / 2)).alias("rank_sum"),
        F.sum(n * n * n - n).alias("ties"))


def univariate_auc(df: DataFrame, cols: Sequence[str], flag: Column) -> DataFrame:
    """Area under the ROC curve of each column as a score, whichever direction separates better."""
    u = F.col("rank_sum") - F.col("n1") * (F.col("n1") + 1) / 2
    auc = u / F.nullif(F.col("n0").cast("double") * F.col("n1"), F.lit(0.0))
    return rank_sums(df, cols, flag).select(
        "column", "n0", "n1", F.coalesce(F.greatest(auc, 1 - auc), F.lit(0.5)).alias("auc"))


def mann_whitney(df: DataFrame, cols: Sequence[str], flag: Column) -> DataFrame:
    """Mann–Whitney U of unflagged rows, tie-corrected normal score with continuity correction, p."""
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    n = n0 + n1
    u1 = F.col("rank_sum") - n1 * (n1 + 1) / 2
    u0 = n0 * n1 - u1
    var = n0 * n1 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1)))
    z = (F.greatest(u0, u1) - n0 * n1 / 2 - 0.5) / F.nullif(F.sqrt(var), F.lit(0.0))
    out = rank_sums(df, cols, flag).filter("n0 > 0 and n1 > 0").select(
        "column", "n0", "n1", u0.alias("u"), z.alias("z"))
    return out.withColumn("p", F.least(F.lit(1.0), F.when(F.col("z") > 0, normal_two_sided(F.col("z")))
                                       .otherwise(F.lit(1.0))))


def chi2_2x2(df: DataFrame, flags: Sequence[str], y: Column) -> DataFrame:
    """Chi-squared of each 0/1 flag column against ``y``, with Yates' correction; NULL if degenerate."""
    marked = df.withColumn("_y", y)
    counts = per_column(marked, flags, {
        "n11": lambda c: F.count_if((F.col(c) == 1) & F.col("_y")),
        "n10": lambda c: F.count_if((F.col(c) == 1) & ~F.col("_y")),
        "n01": lambda c: F.count_if((F.col(c) == 0) & F.col("_y")),
        "n00": lambda c: F.count_if((F.col(c) == 0) & ~F.col("_y"))})
    a, b, c, d = (F.col(x).cast("double") for x in ("n00", "n01", "n10", "n11"))
    n = a + b + c + d
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    gap = F.abs(a * d - b * c)
    # the correction never exceeds the deviation itself
    chi2 = n * F.pow(gap - F.least(gap, n / 2), F.lit(2.0)) / F.nullif(margins, F.lit(0.0))
    return counts.withColumn("chi2", chi2).withColumn("p", chi2_1dof(F.col("chi2")))


def ks_2samp(df: DataFrame, cols: Sequence[str], is_a: Column, alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov per column: largest gap of the two empirical distributions.

    ``is_a`` says which sample a row belongs to. The p-value is asymptotic.
    """
    found = two_sample_sums(df.filter(is_a.isNotNull()), cols, is_a)
    out = df.sparkSession.createDataFrame([(c, n1, n0, gap) for c, n0, n1, _, _, gap in found if n0 and n1],
                                          "column string, n_a long, n_b long, ks double")
    en = F.sqrt(F.col("n_a").cast("double") * F.col("n_b") / (F.col("n_a") + F.col("n_b")))
    return out.withColumn("p", kolmogorov(en * F.col("ks"))).withColumn("drift", F.col("p") < alpha)


def ks_tables(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """``ks_2samp`` of two tables over their common numeric columns."""
    if cols is None:
        numeric = {f.name for f in a.schema if f.dataType.typeName() in ("double", "float", "integer", "long")}
        cols = [c for c in a.columns if c in b.columns and c in numeric]
    both = a.select(*cols, F.lit(True).alias("_is_a")).unionByName(b.select(*cols, F.lit(False).alias("_is_a")))
    return ks_2samp(both, cols, F.col("_is_a"), alpha)
