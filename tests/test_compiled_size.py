"""Work per row must stay in methods that the JVM compiles."""
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import audit, features, twin
from plumbline.operators.gram import exponents
from plumbline.roles import Roles

COMPILED = 8000  # bytes of a method beyond which the JVM leaves it interpreted


@pytest.fixture
def plain_plans(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


def measurements(spark):
    roles = Roles()
    cells = [(F.pmod(F.col("id") * (7 + 2 * i), F.lit(11)) + 1).cast("double").alias(c) for i, c in enumerate(roles.measurements)]
    rows = spark.range(200).select(F.col("id").alias(roles.id), *cells)
    return rows.withColumns({s: F.when(F.pmod(F.col(roles.id) + i, F.lit(5)) != 0, F.col(s)) for i, s in enumerate(roles.all_sensors)})


def test_engineered_features_stay_in_compiled_methods(spark, plain_plans):
    rows = measurements(spark)
    df = features.row_features(rows)
    df = df.select("test_id", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in features.engineered_names(rows, df)])
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    assert max([int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)], default=0) <= COMPILED


def test_verdicts_stay_in_compiled_methods(spark, plain_plans):
    roles = Roles()
    powers = exponents(len(roles.settings), 4)
    weights = {s: np.random.default_rng(i).normal(size=len(powers) + 1) for i, s in enumerate(roles.sensors)}
    model = twin.Twin(roles.settings, {c: (3.0, 7.0 / 3) for c in roles.settings}, powers, weights)
    rows = measurements(spark).withColumns({"label": F.lit("Valid"), "voltage": F.when(F.col("test_id") != 9, F.col("voltage"))})
    df = twin.gap(twin.predict_validity(rows, model, 1.0, roles), roles)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    assert max([int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)], default=0) <= COMPILED
    one, two = ({r[0]: r[1:] for r in x.select("test_id", *[f"e_{s}" for s in weights]).collect()}
                for x in (model.expect(rows, "e_"), model.expect_in_batches(rows, "e_")))
    assert one == two and one[9] == (None, None, None) and None not in one[8]


def test_row_statistics_skip_nulls(spark):
    rows = spark.createDataFrame([(1, 1.0, None, 4.0, 3.0), (2, None, None, None, None), (3, float("nan"), 2.0, None, 1.0)],
                                 "test_id long, s1 double, s2 double, s3 double, s4 double")
    df = rows
    for batch in features.sensor_statistics(["s1", "s2", "s3", "s4"]):
        df = df.withColumns(batch)
    one, two, three = df.orderBy("test_id").collect()
    assert (one.sensor_median, one.sensor_mad, one.max_dev_from_median) == (3.0, 1.0, 2.0)
    assert one.sensor_std == math.sqrt(one.sensor_var)
    assert (two.sensor_median, two.sensor_mad, two.max_dev_from_median, two.sensor_std) == (None, None, None, None)
    assert three.sensor_median == 2.0 and math.isnan(three.max_dev_from_median)


def test_column_moments_are_sparks_aggregates(spark):
    rows = spark.range(1000).select(
        (F.col("id") * 37 % 101 + 1e6).cast("double").alias("a"), F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias("b"),
        F.when(F.col("id") == 5, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("c"),
        F.lit(None).cast("double").alias("d"), F.when(F.col("id") == 7, F.lit(2)).alias("e")).repartition(7)
    got = {r["column"]: r for r in audit.column_moments(rows, list("abcde")).collect()}
    for c in "abcde":
        want = rows.select(F.col(c).cast("double").alias("v")).agg(
            F.count_if(F.col("v").isNull()).alias("n_missing"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
            F.min("v").alias("min"), F.max("v").alias("max")).first()
        for k in want.asDict():
            assert got[c][k] == pytest.approx(want[k], rel=1e-9, nan_ok=True) if want[k] is not None else got[c][k] is None, (c, k)
    assert audit.column_moments(rows.filter("a < 0"), ["a"]).count() == 0
