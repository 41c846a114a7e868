"""The target model: a settings polynomial blended with boosted trees, and its stress tests."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.rowwise import clip_range
from plumbline.operators import metrics
from plumbline.operators.features import assert_no_sensor, assert_valid_only
from plumbline.operators.trees import Job, TreeModel, bin_table, boost, held_out
from plumbline.operators.twin import Twin, fold_twins, with_fold_expectations
from plumbline.roles import Roles
from plumbline.sources.shared import settled


@dataclass(frozen=True)
class ReferenceModel:
    poly: Twin
    trees: TreeModel
    weight: float
    low: float
    high: float
    target: str

    def blend(self, poly: Column, trees: Column) -> Column:
        return F.lit(self.weight) * poly + F.lit(1 - self.weight) * trees


def oof_candidates(df_valid: DataFrame, fold: str, roles: Roles = Roles(), degree: int = 4, alpha: float = 1e-3,
                   boosts: int = 100, depth: int = 5, step: float = 0.1) -> tuple[DataFrame, Twin, TreeModel]:
    """Held-out predictions ``p_poly`` and ``p_trees`` of the target, and both models of all rows.

    The trees of all folds and of the whole table grow in the same passes.
    """
    twins = fold_twins(df_valid, fold, roles, degree, alpha, targets=[roles.target])
    with_poly = with_fold_expectations(df_valid, twins, fold).withColumnRenamed(f"expected_{roles.target}", "p_poly")
    data = bin_table(with_poly, roles.settings, [roles.target], roles.id, fold, keep=with_poly.columns)
    try:
        inputs = data.at(roles.settings)
        grown = boost(data, [Job(inputs, 0, g) for g in (None, *data.folds())], boosts, depth, step)
        oof = settled(held_out(data, {"p_trees": dict(zip(data.folds(), grown[1:]))}).select(*with_poly.columns, "p_trees"), "held-out")
    finally:
        data.unpersist()
    return oof, twins[None], TreeModel(data.edges, {"_trees": grown[0]})


def fit_reference(df_valid: DataFrame, fold: str, roles: Roles = Roles(), inputs: Sequence[str] | None = None,
                  degree: int = 4, alpha: float = 1e-3, boosts: int = 100, depth: int = 5,
                  step: float = 0.1) -> ReferenceModel:
    """Fit on Valid rows and settings only; the blend weight comes from held-out predictions."""
    assert_no_sensor(inputs or roles.settings, roles)
    rows = assert_valid_only(df_valid, roles).dropna(subset=[*roles.settings, roles.target]).persist()
    try:
        oof, poly, trees = oof_candidates(rows, fold, roles, degree, alpha, boosts, depth, step)
        best = metrics.best_weight(metrics.blend_sweep(oof, roles.target, "p_poly", "p_trees")).first()
        ends = rows.agg(F.min(roles.target).alias("lo"), F.max(roles.target).alias("hi")).first()
    finally:
        rows.unpersist()
    return ReferenceModel(poly, trees, best["weight"], ends["lo"], ends["hi"], roles.target)


def predict_reference(df: DataFrame, model: ReferenceModel, out: str = "predicted") -> DataFrame:
    """Blended prediction clipped to the training range widened by 20 %, and whether it was clipped."""
    done = model.poly.expect(model.trees.transform(df), "_poly_")
    raw = model.blend(F.col(f"_poly_{model.target}"), F.col("_trees"))
    return (done.withColumn("_raw", raw)
            .withColumn(out, clip_range(F.col("_raw"), F.lit(model.low), F.lit(model.high)))
            .withColumn("clipped", F.col(out) != F.col("_raw"))
            .drop("_raw", "_trees", f"_poly_{model.target}"))


def extrapolation(df: DataFrame, predict, id: str, column: str, factors: Sequence[float] = (1.0, 1.2, 1.5),
                  out: str = "predicted") -> DataFrame:
    """Predictions at inputs scaled to and beyond the largest training value of a column.

    Every row is evaluated with ``column`` set to each factor times the table's maximum. Rows
    ``(factor, n, n_negative, min, max, n_not_increasing)``; the last counts rows whose prediction did
    not rise from the factor before.
    """
    top = df.agg(F.max(column)).scalar()
    stressed = (df.withColumn("_factor", F.explode(F.array(*[F.lit(float(f)) for f in factors])))
                .withColumn(column, F.col("_factor") * top))
    done = predict(stressed)
    before = F.lag(out).over(Window.partitionBy(id).orderBy("_factor"))
    return done.withColumn("_before", before).groupBy(F.col("_factor").alias("factor")).agg(
        F.count("*").alias("n"), F.count_if(F.col(out) < 0).alias("n_negative"), F.min(out).alias("min"),
        F.max(out).alias("max"), F.count_if(F.col(out) < F.col("_before")).alias("n_not_increasing"))
