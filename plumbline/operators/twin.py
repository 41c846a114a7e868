"""The sensor twin: what each sensor should read given the settings, and verdicts from the difference.

A degree-4 ridge polynomial per sensor is fitted on Valid rows. One pass collects the products of all
monomials with all sensors; every fold's model comes from the same pass. Scoring is one nested
polynomial per sensor, an expression where only the values are read and Arrow batches where verdicts follow.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import rowwise as rw
from plumbline.operators.dedup import is_duplicate
from plumbline.operators.features import assert_valid_only, valid_rows
from plumbline.operators.gram import Moments, design, exponents, moments, polynomial, polynomial_values, solve_ridge
from plumbline.operators.models import fit_scale, scaled
from plumbline.operators.ordered import quantile_values
from plumbline.roles import Roles


@dataclass(frozen=True)
class Twin:
    """Expected sensor values as polynomials of the standardised settings."""

    settings: tuple[str, ...]
    scale: Mapping[str, tuple[float, float]]
    powers: Sequence[tuple[int, ...]]
    coef: Mapping[str, np.ndarray]

    @property
    def sensors(self) -> list[str]:
        return list(self.coef)

    def standardised(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """The scaled settings as columns of their own, so that no term repeats the scaling."""
        names = [f"_z_{c}" for c in self.settings]
        # never NULL, so that the generated arithmetic needs no NULL checks; `known` restores them
        return df.withColumns({n: F.coalesce(scaled(c, self.scale[c]), F.lit(0.0))
                               for n, c in zip(names, self.settings)}), names

    def known(self, value: Column) -> Column:
        return F.when(~rw.any_missing(self.settings), value)

    def expect(self, df: DataFrame, prefix: str = "expected_") -> DataFrame:
        """Add each sensor's expected value, for a reader that leaves the generated code short enough to compile."""
        ready, z = self.standardised(df)
        return ready.withColumns({f"{prefix}{s}": self.known(polynomial(z, self.powers, w))
                                  for s, w in self.coef.items()}).drop(*z)

    def expect_in_batches(self, df: DataFrame, prefix: str = "expected_") -> DataFrame:
        """The same values from Arrow batches of the scaled settings.

        As expressions the polynomials of all sensors, with residuals and duplicate marks after them, make one
        generated method too long for the JVM to compile.
        """
        powers, weights = list(self.powers), dict(self.coef)

        @F.arrow_udf(T.StructType([T.StructField(s, T.DoubleType()) for s in weights]))
        def expected(*z: pa.Array) -> pa.Array:
            cells = [v.to_numpy(zero_copy_only=False) for v in z]
            return pa.StructArray.from_arrays([pa.array(polynomial_values(cells, powers, w)) for w in weights.values()], list(weights))

        ready, z = self.standardised(df)
        return ready.withColumn("_e", expected(*z)).withColumns({f"{prefix}{s}": self.known(F.col("_e")[s]) for s in weights}).drop("_e", *z)


@dataclass(frozen=True)
class LineTwin:
    """Expected sensor values as straight lines in one expression of the settings."""

    x: str
    lines: Mapping[str, tuple[float, float]]

    @property
    def sensors(self) -> list[str]:
        return list(self.lines)

    def expected(self, sensor: str) -> Column:
        slope, intercept = self.lines[sensor]
        return F.lit(slope) * F.expr(self.x) + F.lit(intercept)

    def expect(self, df: DataFrame, prefix: str = "expected_") -> DataFrame:
        return df.withColumns({f"{prefix}{s}": self.expected(s) for s in self.lines})

    expect_in_batches = expect  # lines are short


def twin_moments(df_valid: DataFrame, roles: Roles, degree: int, fold: str | None = None,
                 targets: Sequence[str] | None = None) -> tuple[Moments, dict[str, tuple[float, float]]]:
    """Monomial products over Valid rows, per fold when one is given, and the settings' scale."""
    targets = list(targets or roles.sensors)
    scale = fit_scale(df_valid, roles.settings)
    z = df_valid.select(*[scaled(c, scale[c]).alias(c) for c in roles.settings], *targets,
                        *([fold] if fold else []))
    return moments(z, roles.settings, targets, exponents(len(roles.settings), degree), fold), scale


def twin_of(m: Moments, scale, roles: Roles, alpha: float, leave_out=None) -> Twin:
    coef = {}
    for t in m.targets:
        xx, xy, _ = m.total(t, leave_out)
        coef[t] = solve_ridge(xx, xy, alpha)
    return Twin(tuple(roles.settings), scale, m.terms, coef)


def fit_twin(df_valid: DataFrame, roles: Roles = Roles(), degree: int = 4, alpha: float = 1e-3,
             checked: bool = True) -> Twin:
    """One polynomial per sensor from Valid rows where that sensor is present."""
    if checked and roles.label in df_valid.columns:
        assert_valid_only(df_valid, roles)
    m, scale = twin_moments(df_valid, roles, degree)
    return twin_of(m, scale, roles, alpha)


def fit_line_twin(df_valid: DataFrame, sensors: Sequence[str], x: str) -> LineTwin:
    """Straight-line twin by one aggregate."""
    row = df_valid.agg(*[F.struct(F.regr_slope(F.col(s), F.expr(x)).alias("b"),
                                  F.regr_intercept(F.col(s), F.expr(x)).alias("a")).alias(s) for s in sensors]).first()
    return LineTwin(x, {s: (row[s]["b"], row[s]["a"]) for s in sensors})


def residual_name(sensor: str) -> str:
    return f"residual_{sensor}"


def with_residuals(df: DataFrame, twin: Twin | LineTwin) -> DataFrame:
    """Add actual minus expected per sensor (NULL where missing), the largest size and its sensor."""
    return _residuals(twin.expect_in_batches(df, "_expected_"), twin.sensors, "_expected_").drop(
        *[f"_expected_{s}" for s in twin.sensors])


def _residuals(df: DataFrame, sensors: Sequence[str], prefix: str) -> DataFrame:
    names = [residual_name(s) for s in sensors]
    out = df.withColumns({n: F.col(s) - F.col(f"{prefix}{s}") for n, s in zip(names, sensors)})
    return out.withColumns({"max_abs_residual": rw.max_abs(names), "suspect_sensor": rw.arg_max_abs(names, sensors)})


def derive_threshold(df_valid: DataFrame, twin: Twin | LineTwin, k: float = 7.0, floor: float = 1e-6,
                     accuracy: int | None = None) -> float:
    """Spike threshold from Valid residuals: ``k`` robust deviations of the noisiest sensor.

    The robust deviation is 1.4826 times the median absolute residual. With bounded or Gaussian noise
    ``k`` of 6 to 8 sits above every Valid residual and well below a spike.
    """
    size = twin.expect(df_valid, "_expected_").select(
        *[F.abs(F.col(s) - F.col(f"_expected_{s}")).alias(s) for s in twin.sensors])
    med = quantile_values(size, twin.sensors, {"m": 0.5}, accuracy)
    if not med:
        raise ValueError("no Valid residuals to derive a threshold from")
    return max(k * 1.4826 * max(q["m"] for q in med.values()), floor)


def fault_bucket(threshold: Column | float, sensors: Sequence[str], duplicate: str = "is_dup",
                 residual: str = "max_abs_residual") -> Column:
    """The first fault that applies: missing, duplicate, spike, none."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (F.when(rw.any_missing(sensors), "missing").when(F.coalesce(F.col(duplicate), F.lit(False)), "duplicate")
            .when(F.coalesce(F.col(residual) > limit, F.lit(False)), "spike").otherwise("none"))


def duplicate_keys(df: DataFrame, roles: Roles) -> list[str]:
    """Measurement columns that are present and not wholly absent extras."""
    return [c for c in roles.measurements if c in df.columns]


def predict_validity(df: DataFrame, twin: Twin | LineTwin, threshold: float, roles: Roles = Roles(),
                     keys: Sequence[str] | None = None) -> DataFrame:
    """Add residuals, duplicate mark, fault bucket and verdict; the verdict is never NULL.

    Duplicates are found within this table. A missing extra sensor has no effect.
    """
    marked = is_duplicate(df, keys or duplicate_keys(df, roles))
    out = with_residuals(marked, twin).withColumn("bucket", fault_bucket(threshold, roles.sensors))
    return out.withColumn("verdict", F.when(F.col("bucket") == "none", roles.valid).otherwise(roles.invalid))


def taxonomy(scored: DataFrame, roles: Roles = Roles(), only_invalid: bool = True) -> DataFrame:
    """Rows per fault bucket, and for spikes per suspect sensor."""
    rows = scored.filter(F.col(roles.label) == roles.invalid) if only_invalid else scored
    sensor = F.when(F.col("bucket") == "spike", F.col("suspect_sensor"))
    return rows.groupBy("bucket", sensor.alias("sensor")).agg(F.count("*").alias("n"))


def gap(scored: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Largest residual among Valid rows and smallest among labelled spikes, with their ratio."""
    spiked = (F.col(roles.label) == roles.invalid) & ~rw.any_missing(roles.sensors) & ~F.col("is_dup")
    out = scored.agg(
        F.max(F.when(F.col(roles.label) == roles.valid, F.col("max_abs_residual"))).alias("valid_max"),
        F.min(F.when(spiked, F.col("max_abs_residual"))).alias("spike_min"),
        F.stddev_samp(F.when(F.col(roles.label) == roles.valid, F.col("max_abs_residual"))).alias("valid_sigma"))
    return out.withColumn("ratio", F.col("spike_min") / F.nullif(F.col("valid_max"), F.lit(0.0)))


def fold_twins(df: DataFrame, fold: str, roles: Roles = Roles(), degree: int = 4, alpha: float = 1e-3,
               min_rows: int = 200, targets: Sequence[str] | None = None) -> dict[int, Twin]:
    """For every fold the twin fitted on the Valid rows of the other folds, all from one pass.

    A fold that would leave fewer than ``min_rows`` rows gets the twin of all Valid rows.
    """
    m, scale = twin_moments(valid_rows(df, roles), roles, degree, fold, targets)
    full = twin_of(m, scale, roles, alpha)
    out = {}
    for g in m.groups():
        enough = all(m.total(t, g)[0][0, 0] >= min_rows for t in m.targets)
        out[g] = twin_of(m, scale, roles, alpha, leave_out=g) if enough else full
    out[None] = full
    return out


def with_fold_expectations(df: DataFrame, twins: Mapping[int, Twin], fold: str, prefix: str = "expected_") -> DataFrame:
    """Add each target's expected value from the twin that did not see the row's fold.

    One pass for all folds: Arrow batches carry the scaled settings and the fold to numpy and bring
    the expectations back; all other columns stay where they are.
    """
    full = twins[None]
    targets, powers = full.sensors, list(full.powers)
    weights = {int(g): np.stack([t.coef[s] for s in targets], axis=1) for g, t in twins.items() if g is not None}

    @F.pandas_udf(T.StructType([T.StructField(s, T.DoubleType()) for s in targets]))
    def expected(z: pd.DataFrame, g: pd.Series) -> pd.DataFrame:
        terms = design(z.to_numpy(dtype=float), powers)
        out = np.full((len(g), len(targets)), np.nan)
        for f, w in weights.items():
            on = (g == f).to_numpy()
            out[on] = terms[on] @ w
        return pd.DataFrame(out, columns=targets)

    ready, z = full.standardised(df)
    scored = ready.withColumn("_e", expected(F.struct(*z), F.col(fold)))
    return scored.withColumns({f"{prefix}{s}": full.known(F.col("_e")[s]) for s in targets}).drop("_e", *z)


def oof_verdict(df: DataFrame, fold: str, threshold: float | None = None, roles: Roles = Roles(), degree: int = 4,
                alpha: float = 1e-3, min_rows: int = 200, k: float = 7.0) -> DataFrame:
    """Out-of-fold verdicts: twins refitted per fold, duplicates found within the held-out fold.

    Needs folds that keep duplicate groups together. Without a threshold one is derived from the twin
    of all Valid rows. ``fold_left_out`` is false where the other folds had fewer than ``min_rows``
    rows, so that the row was judged by the twin of all Valid rows, its own included.
    """
    twins = fold_twins(df, fold, roles, degree, alpha, min_rows)
    thin = [g for g, t in twins.items() if g is not None and t is twins[None]]
    if threshold is None:
        threshold = derive_threshold(valid_rows(df, roles), twins[None], k)
    marked = is_duplicate(df, [fold, *duplicate_keys(df, roles)])
    out = _residuals(with_fold_expectations(marked, twins, fold), roles.sensors, "expected_")
    out = out.withColumn("bucket", fault_bucket(threshold, roles.sensors))
    return out.withColumn("verdict", F.when(F.col("bucket") == "none", roles.valid).otherwise(roles.invalid)).withColumn(
        "fold_left_out", ~F.col(fold).isin(thin) if thin else F.lit(True))


def attention(scored: DataFrame, threshold: float, prediction: str, roles: Roles = Roles()) -> DataFrame:
    """Mean of four parts in 0–1: verdict, residual over threshold, missing share, prediction rank.

    The scored rows are written once, since their ranks come back to them.
    """
    from plumbline.operators.ordered import percent_ranks
    from plumbline.operators.skew import attach_groups
    from plumbline.sources.shared import settled

    scored = settled(scored, "scored")
    ranks = percent_ranks(scored, [prediction]).select(F.col("value").alias(prediction), "n",
                                                       F.col("pct_rank").alias("part_prediction"))
    sensors = [c for c in roles.all_sensors if c in scored.columns]
    ranked = attach_groups(scored, ranks, [prediction], "n").drop("n").withColumns({
        "part_invalid": (F.col("verdict") == roles.invalid).cast("double"),
        "part_residual": F.coalesce(F.least(F.col("max_abs_residual") / F.lit(float(threshold)), F.lit(1.0)), F.lit(0.0)),
        "part_missing": rw.n_missing(sensors) / F.lit(float(len(sensors))),
        "part_prediction": F.coalesce(F.col("part_prediction"), F.lit(0.0))})
    parts = ["part_invalid", "part_residual", "part_missing", "part_prediction"]
    return ranked.withColumn("attention", sum((F.col(p) for p in parts[1:]), F.col(parts[0])) / 4)


def top_attention(scored: DataFrame, id: str, n: int = 3) -> DataFrame:
    """The rows most worth a look; the smaller id wins a tie."""
    return scored.orderBy(F.desc("attention"), id).limit(n).select(id, "attention")


def diagnostics(scored: DataFrame, id: str) -> DataFrame:
    """Every per-record component behind a verdict and an attention score."""
    parts = [c for c in scored.columns if c.startswith(("residual_", "part_"))]
    return scored.select(id, "verdict", "bucket", "is_dup", "max_abs_residual", "suspect_sensor", *parts, "attention")
