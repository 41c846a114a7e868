"""Regression and classification scores, sweeps over thresholds and weights, leaderboards."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ordered import quantiles, running_counts


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))


def r2_of(y: Column, p: Column) -> Column:
    """1 - SSE/SST over the rows where both are present."""
    both = y.isNotNull() & p.isNotNull()
    on_y = F.when(both, y)
    return 1 - F.sum((y - p) * (y - p)) / F.nullif(F.var_pop(on_y) * F.count(on_y), F.lit(0.0))


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), median: bool = True) -> DataFrame:
    """MAE, RMSE, R², exact median and largest absolute error, per group when ``by`` is given."""
    by = list(by)
    err = F.abs(F.col(y) - F.col(p))
    out = df.groupBy(*by).agg(
        F.count(F.col(y) - F.col(p)).alias("n"), F.avg(err).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"), r2_of(F.col(y), F.col(p)).alias("r2"), F.max(err).alias("max_error"))
    if not median:
        return out
    med = quantiles(df.select(*by, err.alias("e")), ["e"], {"median_ae": 0.5}, by)
    if not by:
        return out.withColumn("median_ae", med.select("median_ae").scalar())
    keyed = med.select(F.struct(*by).alias("_key"), "median_ae")  # one row per class
    return (out.withColumn("_key", F.struct(*by)).join(F.broadcast(keyed), "_key", "left").drop("_key"))


def fold_summary(per_fold: DataFrame, metrics: Sequence[str] = ("mae", "r2"), worst: str = "mae") -> DataFrame:
    """Mean and population deviation over folds, and the worst fold, of a per-fold metric table."""
    return per_fold.agg(
        F.count("*").alias("folds"),
        *[F.avg(m).alias(f"{m}_mean") for m in metrics], *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics],
        F.max(worst).alias(f"{worst}_worst"))


def scores(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Scores from confusion counts; a zero denominator gives 0."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    f1, f1_neg = _div(2 * tp, 2 * tp + fp + fn), _div(2 * tn, 2 * tn + fp + fn)
    recall, recall_neg = _div(tp, tp + fn), _div(tn, tn + fp)
    spread = F.sqrt((tp + fp)) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return {"precision": _div(tp, tp + fp), "recall": recall, "f1": f1, "macro_f1": (f1 + f1_neg) / 2,
            "balanced_accuracy": (recall + recall_neg) / 2, "mcc": _div(tp * tn - fp * fn, spread)}


def classification_metrics(df: DataFrame, y: Column, p: Column, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and scores of boolean predictions ``p`` against truth ``y``."""
    y, p = F.coalesce(y, F.lit(False)), F.coalesce(p, F.lit(False))
    counts = df.groupBy(*by).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return counts.withColumns(scores(*(F.col(c) for c in ("tp", "fp", "fn", "tn"))))


def roc_auc(df: DataFrame, y: Column, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve of a score, ties counted half: rows ``(by…, roc_auc)``."""
    from plumbline.operators.stats import rank_sums

    u = F.col("rank_sum") - F.col("n1") * (F.col("n1") + 1) / 2
    return rank_sums(df, [score], y, by).select(
        *by, (u / F.nullif(F.col("n0").cast("double") * F.col("n1"), F.lit(0.0))).alias("roc_auc"))


def average_precision(df: DataFrame, y: Column, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Step-wise area under the precision–recall curve over the distinct scores."""
    marked = df.withColumn("_y", F.coalesce(y, F.lit(False)))
    run = running_counts(marked, [score], by, {"n": F.count("*"), "p": F.count_if(F.col("_y"))}, ["_y"])
    tp, seen = F.col("p_total") - F.col("p_below"), F.col("n_total") - F.col("n_below")
    return run.groupBy(*by).agg(
        F.sum(F.col("p") / F.nullif(F.col("p_total").cast("double"), F.lit(0.0)) * tp / seen).alias("average_precision"))


def threshold_sweep(df: DataFrame, y: Column, score: str, grid: Sequence[float] = (1.1, 1.5, 2.0, 3.0, 4.0),
                    always: Column | None = None) -> DataFrame:
    """Scores of ``score > threshold`` for each threshold, all from one aggregate.

    ``always`` marks rows flagged whatever the threshold.
    """
    y = F.coalesce(y, F.lit(False))
    always = F.lit(False) if always is None else F.coalesce(always, F.lit(False))

    def counts(th: float) -> Column:
        p = always | F.coalesce(F.col(score) > th, F.lit(False))
        return F.struct(F.lit(float(th)).alias("threshold"), F.count_if(y & p).alias("tp"),
                        F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"),
                        F.count_if(~y & ~p).alias("tn"))

    swept = df.agg(F.array(*[counts(th) for th in grid]).alias("g")).select(F.inline("g"))
    all_scores = scores(*(F.col(c) for c in ("tp", "fp", "fn", "tn")))
    return swept.withColumns({k: all_scores[k] for k in ("precision", "recall", "f1")})


def blend_sweep(df: DataFrame, y: str, a: str, b: str, steps: int = 20) -> DataFrame:
    """MAE of ``w·a + (1-w)·b`` for ``steps + 1`` even weights, all from one aggregate."""
    def cell(i: int) -> Column:
        w = i / steps
        blend = F.lit(w) * F.col(a) + F.lit(1 - w) * F.col(b)
        return F.struct(F.lit(w).alias("weight"), F.avg(F.abs(F.col(y) - blend)).alias("mae"))

    return df.agg(F.array(*[cell(i) for i in range(steps + 1)]).alias("g")).select(F.inline("g"))


def best_weight(sweep: DataFrame) -> DataFrame:
    """The weight of smallest MAE; the smaller weight wins a tie."""
    return sweep.agg(F.min(F.struct("mae", "weight")).alias("b")).select("b.weight", "b.mae")


def leaderboard(df: DataFrame, metric: str, ascending: bool, n: int, name: str) -> DataFrame:
    order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return df.orderBy(order, name).limit(n)


def rank_within(df: DataFrame, task: str, metric: str, ascending: bool = True, out: str = "rank") -> DataFrame:
    """Rank of each result row within its task, best first. Result tables only."""
    order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return df.withColumn(out, F.rank().over(Window.partitionBy(task).orderBy(order)))


def disagreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of each verdict pair, and whether the pair disagrees."""
    return (df.groupBy(a, b).agg(F.count("*").alias("n"))
            .withColumn("disagrees", ~F.col(a).eqNullSafe(F.col(b))))
