"""Tests and correlations on small samples with known answers."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.pvalues import t_tail
from plumbline.operators import audit, dedup, gram, metrics, models, stats


@pytest.fixture(scope="module")
def two(spark):
    rows = [(i, float(v), f) for i, (v, f) in enumerate(
        [(1, False), (2, False), (2, False), (3, False), (5, False), (2, True), (4, True), (6, True), (7, True)])]
    return spark.createDataFrame(rows, "id int, x double, f boolean")


def test_student_tail_known_values(spark):
    assert t_tail(2.0, 10) == pytest.approx(0.07338803477074, abs=1e-12)
    assert t_tail(0.0, 5) == 1.0 and t_tail(12.706204736, 1) == pytest.approx(0.05, abs=1e-9)
    jvm = spark._jvm.org.apache.commons.math3.distribution.TDistribution(37.5)
    assert t_tail(2.3, 37.5) == pytest.approx(2 * jvm.cumulativeProbability(-2.3), rel=1e-9)


def test_ks_and_auc(two):
    row = stats.ks_2samp(two, ["x"], ~F.col("f")).first()
    assert row["ks"] == pytest.approx(0.55, abs=1e-12) and (row["n_a"], row["n_b"]) == (5, 4)
    # pairs won by flagged rows: 2 ties with value 2, the rest by comparison
    assert stats.univariate_auc(two, ["x"], F.col("f")).first()["auc"] == pytest.approx((2 * 0.5 + 1 + 4 + 5 + 5) / 20)


def test_mann_whitney_tie_correction(two):
    row = stats.mann_whitney(two, ["x"], F.col("f")).first()
    var = 5 * 4 / 12 * (10 - (3 ** 3 - 3) / (9 * 8))
    assert row["u"] == pytest.approx(4.0)
    assert row["z"] == pytest.approx((16 - 10 - 0.5) / math.sqrt(var))


def test_yates_matches_the_published_table(spark):
    # 12 pairs of copies, all Invalid, among 1000 rows with 134 Invalid
    rows = [(1, True)] * 24 + [(0, True)] * 110 + [(0, False)] * 866
    row = stats.chi2_2x2(spark.createDataFrame(rows, "d int, y boolean"), ["d"], F.col("y")).first()
    assert row["chi2"] == pytest.approx(151.3643, abs=1e-4)


def test_degenerate_columns_give_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, True), (1.0, 2.0, False)], "c double, x double, f boolean")
    assert stats.corr_matrix(df, ["c", "x"]).first()["r"] is None
    assert stats.chi2_2x2(df.withColumn("z", F.lit(0)), ["z"], F.col("f")).first()["chi2"] is None


def test_extremes_fall_back_to_the_deviation(spark):
    df = spark.createDataFrame([(5.0,)] * 30 + [(50.0,)], "x double")
    row = audit.extremes(df, ["x"]).first()
    assert row["mad"] == 0.0 and row["robust_z_outliers"] == 1 and row["iqr_outliers"] == 1


def test_duplicates_treat_null_as_equal(spark):
    rows = [(1, 1.0, None, 5.0), (2, 1.0, None, 6.0), (3, 1.0, 2.0, 5.0), (4, -0.0, 2.0, 1.0), (5, 0.0, 2.0, 1.0),
            (6, 9.0, 9.0, 9.0), (7, 9.00001, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double, t double")
    marks = {r["id"]: r["is_dup"] for r in dedup.is_duplicate(df, ["a", "b"]).collect()}
    assert [marks[i] for i in range(1, 8)] == [True, True, False, True, True, False, False]
    near = {r["id"]: r["is_dup"] for r in dedup.is_duplicate(df, ["a", "b"], decimals=4).collect()}
    assert near[6] and near[7]
    got = dedup.conflicts(df, ["a", "b"], ["t"]).first()
    assert (got["n_groups"], got["n_conflicting"]) == (2, 1)
    ids = {r["id"]: r["group_id"] for r in dedup.group_id(df, ["a", "b"], "id").collect()}
    assert ids[2] == 1 and ids[5] == 4 and ids[3] == 3


def test_scores_with_empty_classes(spark):
    df = spark.createDataFrame([(False, False), (False, False)], "y boolean, p boolean")
    row = metrics.classification_metrics(df, F.col("y"), F.col("p")).first()
    assert (row["f1"], row["recall"], row["mcc"], row["tn"]) == (0.0, 0.0, 0.0, 2)


def test_ridge_equals_its_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 10, 3]
    y = x @ [1.5, -0.3, 4.0] + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + 2.0 * np.eye(3), z.T @ (y - y.mean())) / x.std(0)
    m = gram.moments(df, ["a", "b", "c"], ["y"])
    assert np.allclose(gram.solve_ridge(*m.total("y")[:2], 2.0)[1:], want, atol=1e-9)
    assert np.allclose(models.ridge(df, ["a", "b", "c"], "y", 2.0).stages[-1].coefficients.toArray(), want, atol=1e-7)


def test_moments_skip_only_the_missing_target(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 3.0, 4.0), (None, 1.0, 1.0)], "x double, y double, z double")
    m = gram.moments(df, ["x"], ["y", "z"])
    assert m.total("y")[0][0, 0] == 2 and m.total("z")[0][0, 0] == 1 and m.total("z")[1][1] == 8.0


def test_spline_basis_sums_to_one(spark):
    df = spark.range(101).select((F.col("id") / 10.0).alias("x"))
    out, names = models.spline_columns(df, ["x"])
    assert len(names) == 7
    sums = out.select(sum((F.col(c) for c in names[1:]), F.col(names[0])).alias("s")).toPandas().s
    assert np.allclose(sums, 1.0, atol=1e-9)


def test_distinct_counts_travel_in_packed_blocks(spark, monkeypatch):
    rows = spark.range(5000).select(
        (F.col("id") % 1237 / 7).alias("a"), F.when(F.col("id") % 5 > 0, F.sqrt(F.col("id").cast("double"))).alias("b"),
        F.expr("CASE id % 4 WHEN 0 THEN DOUBLE('NaN') WHEN 1 THEN -0D WHEN 2 THEN 0D END").alias("c"), F.lit(None).cast("double").alias("d"),
        (F.col("id") % 3).cast("string").alias("e"), (F.col("id") % 9).cast("float").alias("f")).repartition(6)
    cols = list("abcdef")
    want = rows.agg(*[F.count_distinct(c).alias(c) for c in cols]).first().asDict()
    found = audit.distinct_counts(rows, cols)
    assert [tuple(r) for r in found.collect()] == [(c, want[c]) for c in cols] and want["c"] == 2
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan  # which makes a wide row of every cell
    monkeypatch.setattr(audit, "CELLS_HELD", 100)
    blocks = list(audit._distinct_blocks(rows.select("a", "b").coalesce(1).toArrow().to_batches(max_chunksize=64)))
    assert len(blocks) > 4
    assert audit.distinct_counts(rows.limit(0), ["a"]).collect() == [("a", 0)]
