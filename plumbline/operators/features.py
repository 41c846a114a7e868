"""Derived features of a measurement table, named feature sets, and row and column selections."""
from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import rowwise as rw
from plumbline.functions.rowwise import present
from plumbline.operators.bins import pattern_codes, with_pattern_code
from plumbline.operators.dedup import group_facts
from plumbline.roles import Roles

_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType)


def is_invalid(roles: Roles = Roles()) -> Column:
    return (F.col(roles.label) == roles.invalid).cast("int")


def valid_rows(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.filter(F.col(roles.label) == roles.valid)


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return present(df, cols)


def columns_like(df: DataFrame, prefixes: Sequence[str] = (), contains: Sequence[str] = (),
                 excluding: Sequence[str] = (), numeric: bool = False) -> list[str]:
    """Column names by prefix or substring, optionally numeric only; no pattern means all."""
    out = []
    for f in df.schema:
        hit = (not prefixes and not contains) or f.name.startswith(tuple(prefixes) or ("\0",)) \
            or any(s in f.name for s in contains)
        if hit and not any(s in f.name for s in excluding) and (not numeric or isinstance(f.dataType, _NUMERIC)):
            out.append(f.name)
    return out


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def hstack(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """Add columns whose names are new; a repeated name keeps the first."""
    return df.withColumns({k: v for k, v in added.items() if k not in df.columns})


def prepare_x(df: DataFrame, cols: Sequence[str], roles: Roles = Roles(), keep: Sequence[str] = ()) -> DataFrame:
    """The model inputs among ``cols``. Id, target and label are never inputs."""
    denied = {roles.id, roles.target, roles.label}
    return df.select(*keep, *[c for c in dict.fromkeys(cols) if c in df.columns and c not in denied])


def assert_valid_only(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    if not df.filter(~F.coalesce(F.col(roles.label) == roles.valid, F.lit(False))).isEmpty():
        raise AssertionError("training rows must all be Valid")
    return df


def assert_no_sensor(inputs: Sequence[str], roles: Roles = Roles()) -> None:
    sensors = [c for c in inputs if c in roles.all_sensors]
    if sensors:
        raise AssertionError(f"sensors among the model inputs: {sensors}")


# --- derived columns -----------------------------------------------------------------------------
def electrical(roles: Roles = Roles()) -> dict[str, Column]:
    """Products, squares, roots and ratios of the four settings: voltage, current, ambient, time."""
    v, i, a, t = (F.col(c) for c in roles.settings)
    return {
        "Power_VI": v * i, "Energy_VIt": v * i * t, "I_squared": i * i, "I2t": i * i * t, "V_squared": v * v,
        "sqrt_t": rw.sqrt_clip(roles.settings[3]), "log1p_t": rw.log1p_clip(roles.settings[3]),
        "V_over_I": rw.safe_ratio(v, i), "I_over_V": rw.safe_ratio(i, v),
        "V_I_interact": v * i, "V_t_interact": v * t, "I_t_interact": i * t, "T_I_interact": a * i,
        "T_t_interact": a * t,
    }


def sensor_summaries(sensors: Sequence[str]) -> list[dict[str, Column]]:
    """Where a row's sensors lie and how far they spread, in batches: a later batch reads columns of an earlier one."""
    return [
        {"sensor_mean": rw.row_mean(sensors), "sensor_median": rw.row_median(sensors),
         "sensor_min": rw.row_min(sensors), "sensor_max": rw.row_max(sensors),
         "n_sensors_available": rw.n_available(sensors), "n_sensors_missing": rw.n_missing(sensors),
         "sensor_trimmed_mean": rw.row_trimmed_mean(sensors)},
        {"sensor_range": F.col("sensor_max") - F.col("sensor_min"),
         "sensor_var": rw.row_var(sensors, F.col("sensor_mean")),
         "sensor_mad": rw.row_mad(sensors, F.col("sensor_median")),
         "sensor_std": F.sqrt(rw.row_var(sensors, F.col("sensor_mean")))},
        {"sensor_cv": rw.safe_ratio(F.col("sensor_std"), F.col("sensor_mean"))},
    ]


def sensor_agreement(sensors: Sequence[str]) -> dict[str, Column]:
    """How far each sensor of a row is from their median; reads the summaries."""
    med, mad, std = F.col("sensor_median"), F.col("sensor_mad"), F.col("sensor_std")
    return {**{f"{s}_dev_from_median": rw.deviation(s, med) for s in sensors},
            "max_dev_from_median": rw.max_abs_deviation(sensors, med),
            "n_sensors_outside_consensus": rw.n_outside_consensus(sensors, 2.0, med, mad, std)}


def sensor_statistics(sensors: Sequence[str]) -> list[dict[str, Column]]:
    """Row statistics over the sensors, in batches to be added one after another."""
    return [*sensor_summaries(sensors), sensor_agreement(sensors)]


def sensor_flags(sensors: Sequence[str]) -> dict[str, Column]:
    return {**{f"miss_{s}": rw.missing_flag(s) for s in sensors},
            **{f"neg_{s}": rw.negative_flag(s) for s in sensors},
            **{f"zero_{s}": rw.zero_flag(s) for s in sensors}}


def pairwise(sensors: Sequence[str]) -> dict[str, Column]:
    """Difference, absolute difference and ratio of every sensor pair."""
    out = {}
    for a, b in combinations(sensors, 2):
        out[f"diff_{a}_{b}"] = F.col(a) - F.col(b)
        out[f"absdiff_{a}_{b}"] = F.abs(F.col(a) - F.col(b))
        out[f"ratio_{a}_{b}"] = rw.safe_ratio(a, b)
    return out


def minus_ambient(sensors: Sequence[str], ambient: str) -> dict[str, Column]:
    return {f"{s}_minus_ambient": F.col(s) - F.col(ambient) for s in sensors}


def electrical_names(roles: Roles = Roles()) -> list[str]:
    return list(electrical(roles))


def summary_names(sensors: Sequence[str]) -> list[str]:
    return [name for batch in sensor_summaries(sensors) for name in batch]


def agreement_names(roles: Roles = Roles()) -> list[str]:
    """Every feature that compares sensors with each other, the ambient or what other columns predict."""
    sensors = roles.all_sensors
    return [*pairwise(sensors), *minus_ambient(sensors, roles.settings[2]), *sensor_agreement(sensors),
            *[f"{kind}_{s}" for kind in ("residual", "abs_residual") for s in sensors]]


def row_features(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """All features that need nothing but their own row: expressions only, no shuffle.

    Each projection that Spark makes of the batches holds a function of arrays with a lambda (median,
    MAD, largest deviation). Spark evaluates such projections by many small methods, while whole-stage
    code would put all features into one that is too long for the JVM to compile.
    """
    sensors = [s for s in roles.all_sensors if s in df.columns]
    first = {**electrical(roles), **sensor_flags(sensors), **pairwise(sensors),
             **minus_ambient(sensors, roles.settings[2])}
    for batch in [first, *sensor_statistics(sensors)]:
        df = df.withColumns(batch)
    return df


def engineer(df: DataFrame, roles: Roles = Roles(), codes: DataFrame | None = None) -> DataFrame:
    """Every derived feature: row features, duplicate facts and the missing-pattern code.

    ``codes`` comes from ``pattern_codes`` of the training table, so that train and test agree; by
    default it is taken from ``df``.
    """
    sensors = [s for s in roles.all_sensors if s in df.columns]
    keys = [c for c in roles.measurements if c in df.columns]
    codes = pattern_codes(df, sensors) if codes is None else codes
    counted = group_facts(df, keys, {}, size="dup_group_size", flag="is_exact_dup")
    counted = counted.withColumn("is_exact_dup", F.col("is_exact_dup").cast("int"))
    return row_features(with_pattern_code(counted, codes, sensors), roles)


def engineered_names(df: DataFrame, engineered: DataFrame) -> list[str]:
    return [c for c in engineered.columns if c not in df.columns]


def feature_sets(names: Sequence[str], roles: Roles = Roles(), top_reg: Sequence[str] = (),
                 top_cls: Sequence[str] = ()) -> dict[str, list[str]]:
    """The named feature sets over engineered column ``names``."""
    built = set(names)
    consistency = [c for c in agreement_names(roles) if c in built]
    without = [c for c in [*roles.measurements, *names] if not any(x in c for x in roles.extra)]
    return {
        "raw_operating": list(roles.settings),
        "raw_sensors": roles.all_sensors,
        "all_raw": roles.measurements,
        "ops_plus_electrical": [*roles.settings, *electrical_names(roles)],
        "sensors_plus_consistency": [*roles.all_sensors, *summary_names(roles.all_sensors), *consistency],
        "all_engineered": list(names),
        "no_S4": without,
        "top_compact_reg": list(top_reg),
        "top_compact_cls": list(top_cls),
    }


def feature_set(name: str, names: Sequence[str], roles: Roles = Roles(), **tops) -> list[str]:
    """One named set; an unknown name gives no columns."""
    return feature_sets(names, roles, **tops).get(name, [])
