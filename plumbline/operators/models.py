"""Imputation, scaling, expansions and estimators, with parameters in their usual statistical meaning.

Estimators are ``pyspark.ml`` pipelines from named columns to ``prediction``.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from math import comb, factorial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.ordered import class_rows, quantile_values

SEED = 42


# --- transforms ----------------------------------------------------------------------------------
def fit_median(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> dict[str, float]:
    """Median of each column over the given rows; fit it on training rows only."""
    return {c: q["m"] for c, q in quantile_values(df, cols, {"m": 0.5}, accuracy).items()}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()})


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column scales by 1."""
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]).first()
    return {c: (row[c]["m"], row[c]["s"] or 1.0) for c in cols}


def scaled(c: str, by: tuple[float, float]) -> Column:
    return (F.col(c) - F.lit(float(by[0]))) / F.lit(float(by[1]))


def standardise(df: DataFrame, cols: Sequence[str], suffix: str = "_z",
                scale: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    scale = scale or fit_scale(df, cols)
    return df.withColumns({f"{c}{suffix}": scaled(c, scale[c]) for c in cols})


def poly(df: DataFrame, cols: Sequence[str], degree: int, out: str = "poly") -> DataFrame:
    """Vector of all monomials up to ``degree`` without the constant."""
    stages = [VectorAssembler(inputCols=list(cols), outputCol="_x"),
              PolynomialExpansion(inputCol="_x", outputCol=out, degree=degree)]
    return reduce(lambda d, s: s.transform(d), stages, df).drop("_x")


def bspline(c: Column, lo: float, hi: float, knots: int = 5, degree: int = 3) -> list[Column]:
    """B-spline basis on even knots over ``[lo, hi]``: ``knots + degree - 1`` columns, constant outside."""
    step = (hi - lo) / (knots - 1)
    u = (F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))) - F.lit(float(lo))) / F.lit(float(step))
    u = F.when(c.isNotNull(), u)

    order = degree + 1

    def cardinal(s: Column) -> Column:
        # truncated powers: the signed sum of max(s - j, 0)^degree
        total = F.lit(0.0)
        for j in range(order):
            cut = F.greatest(s - j, F.lit(0.0))
            total = total + reduce(lambda a, _: a * cut, range(degree - 1), cut) * F.lit((-1.0) ** j * comb(order, j))
        return F.when((s >= 0) & (s < order), total / factorial(degree)).otherwise(F.lit(0.0))

    return [F.when(u.isNotNull(), cardinal(u - i + degree)) for i in range(knots + degree - 1)]


def spline_columns(df: DataFrame, cols: Sequence[str], knots: int = 5, degree: int = 3) -> tuple[DataFrame, list[str]]:
    """Add the spline basis of each column, on knots over its range in ``df``."""
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]).first()
    added = {f"{c}_sp{i}": b for c in cols
             for i, b in enumerate(bspline(F.col(c), ends[c]["lo"], ends[c]["hi"], knots, degree))}
    return df.withColumns(added), list(added)


# --- estimators ----------------------------------------------------------------------------------
def assembled(df: DataFrame, estimator, x: Sequence[str], y: str) -> PipelineModel:
    """Fit ``estimator`` on rows where inputs and target are present."""
    rows = df.dropna(subset=[*x, y])
    return Pipeline(stages=[VectorAssembler(inputCols=list(x), outputCol="_features"), estimator]).fit(rows)


def _spread(df: DataFrame, y: str) -> tuple[int, float]:
    row = df.agg(F.count(y).alias("n"), F.stddev_pop(y).alias("s")).first()
    return row["n"], row["s"] or 1.0


def ols(df: DataFrame, x: Sequence[str], y: str) -> PipelineModel:
    return assembled(df, LinearRegression(featuresCol="_features", labelCol=y, solver="normal"), x, y)


def ridge(df: DataFrame, x: Sequence[str], y: str, alpha: float = 1.0) -> PipelineModel:
    """Least squares plus ``alpha`` times the squared norm of the standardised coefficients.

    Spark scales the penalty by the number of rows and by the target's deviation.
    """
    rows = df.dropna(subset=[*x, y])
    n, s = _spread(rows, y)
    return assembled(rows, LinearRegression(featuresCol="_features", labelCol=y, solver="normal",
                                            regParam=alpha * s / n, elasticNetParam=0.0), x, y)


def elastic_net(df: DataFrame, x: Sequence[str], y: str, alpha: float = 1.0, l1_ratio: float = 0.5) -> PipelineModel:
    """Mean squared error / 2 plus ``alpha`` times the mixed penalty on standardised coefficients."""
    rows = df.dropna(subset=[*x, y])
    _, s = _spread(rows, y)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * s
    return assembled(rows, LinearRegression(featuresCol="_features", labelCol=y, regParam=l1 + l2,
                                            elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0), x, y)


def huber(df: DataFrame, x: Sequence[str], y: str, epsilon: float = 1.35, alpha: float = 0.0001,
          max_iter: int = 100) -> PipelineModel:
    rows = df.dropna(subset=[*x, y])
    n, _ = _spread(rows, y)
    return assembled(rows, LinearRegression(featuresCol="_features", labelCol=y, loss="huber", epsilon=epsilon,
                                            regParam=alpha / n, maxIter=max_iter), x, y)


def gbt_reg(df: DataFrame, x: Sequence[str], y: str, iters: int = 100, depth: int = 5, step: float = 0.1,
            bins: int = 256, seed: int = SEED) -> PipelineModel:
    return assembled(df, GBTRegressor(featuresCol="_features", labelCol=y, maxIter=iters, maxDepth=depth,
                                      stepSize=step, maxBins=bins, seed=seed, cacheNodeIds=False), x, y)


def gbt_cls(df: DataFrame, x: Sequence[str], y: str, iters: int = 100, depth: int = 5, step: float = 0.1,
            bins: int = 256, seed: int = SEED) -> PipelineModel:
    return assembled(df, GBTClassifier(featuresCol="_features", labelCol=y, maxIter=iters, maxDepth=depth,
                                       stepSize=step, maxBins=bins, seed=seed), x, y)


def forest_reg(df: DataFrame, x: Sequence[str], y: str, trees: int = 100, depth: int = 10, bins: int = 64,
               seed: int = SEED) -> PipelineModel:
    return assembled(df, RandomForestRegressor(featuresCol="_features", labelCol=y, numTrees=trees, maxDepth=depth,
                                               maxBins=bins, seed=seed, featureSubsetStrategy="all"), x, y)


def balanced(df: DataFrame, y: str, out: str = "_weight") -> DataFrame:
    """Weight of each row so that both classes of a 0/1 target weigh the same: n / (2 · class size)."""
    row = df.agg(F.count(y).alias("n"), F.count_if(F.col(y) == 1).alias("n1")).first()
    n, n1 = row["n"], row["n1"]
    return df.withColumn(out, F.when(F.col(y) == 1, F.lit(n / (2.0 * n1) if n1 else 1.0))
                         .otherwise(F.lit(n / (2.0 * (n - n1)) if n > n1 else 1.0)))


def forest_cls(df: DataFrame, x: Sequence[str], y: str, trees: int = 100, depth: int = 10, bins: int = 64,
               balance: bool = True, seed: int = SEED) -> PipelineModel:
    est = RandomForestClassifier(featuresCol="_features", labelCol=y, numTrees=trees, maxDepth=depth, maxBins=bins,
                                 seed=seed)
    if balance:
        est.setWeightCol("_weight")
        df = balanced(df, y)
    return assembled(df, est, x, y)


def logistic(df: DataFrame, x: Sequence[str], y: str, c: float = 1.0, balance: bool = True,
             max_iter: int = 100) -> PipelineModel:
    """Logistic regression with an L2 penalty of ``1 / (2c)`` on standardised coefficients."""
    rows = df.dropna(subset=[*x, y])
    n, _ = _spread(rows, y)
    est = LogisticRegression(featuresCol="_features", labelCol=y, regParam=1.0 / (c * n), maxIter=max_iter)
    if balance:
        est.setWeightCol("_weight")
        rows = balanced(rows, y)
    return assembled(rows, est, x, y)


class Constant:
    """A baseline that predicts one value for every row."""

    def __init__(self, value):
        self.value = value

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(self.value))


def dummy_cls(df: DataFrame, y: str) -> Constant:
    """Always the most frequent class; the smaller label wins a tie."""
    top = df.groupBy(y).agg(F.count("*").alias("n")).orderBy(F.desc("n"), y).first()
    return Constant(top[y])


def dummy_reg(df: DataFrame, y: str) -> Constant:
    """Always the median of the target."""
    return Constant(fit_median(df, [y])[y])


def probability(c: str = "probability") -> Column:
    """Probability of class 1 from a classifier's probability vector."""
    from pyspark.ml.functions import vector_to_array

    return F.get(vector_to_array(F.col(c)), F.lit(1))


def importances(df: DataFrame, model: PipelineModel, x: Sequence[str], out: str) -> DataFrame:
    """A tree model's feature importances as a table."""
    rows = [(c, float(v)) for c, v in zip(x, model.stages[-1].featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, f"feature string, {out} double")


def gbt_importance(df: DataFrame, x: Sequence[str], y: str, classify: bool = False, iters: int = 100,
                   depth: int = 5) -> DataFrame:
    fit = gbt_cls if classify else gbt_reg
    return importances(df, fit(df, x, y, iters, depth), x, "gb_importance")


# --- out-of-fold ---------------------------------------------------------------------------------
def fold_values(df: DataFrame, fold: str = "fold") -> list:
    """The folds that there are, in order."""
    return sorted(r[0] for r in class_rows(df.filter(F.col(fold).isNotNull()).select(fold).distinct()))


def oof_predict(df: DataFrame, fit: Callable[[DataFrame], object], folds: Sequence, fold: str = "fold") -> DataFrame:
    """Rows of each of ``folds`` predicted by a model fitted on the other folds."""
    parts = [fit(df.filter(F.col(fold) != i)).transform(df.filter(F.col(fold) == i)) for i in folds]
    return reduce(DataFrame.unionByName, parts)
