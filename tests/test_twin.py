"""The twin against the planted truth, folds, robustness to absent and shuffled columns."""
import pytest
from pyspark.sql import functions as F

from plumbline.operators import anomaly, damage, features, folds, ranking, reference, twin
from plumbline.operators import dedup, models
from plumbline.plans.registry import ROLES, bench
from plumbline.sources.tables import align_schema

M = ROLES.measurements


@pytest.fixture(scope="module")
def table(spark, small):
    return bench(spark, small).persist()


@pytest.fixture(scope="module")
def fitted(table):
    valid = features.valid_rows(table.filter("split = 'train'"), ROLES)
    model = twin.fit_twin(valid, ROLES)
    return model, twin.derive_threshold(valid, model)


def test_buckets_equal_the_planted_truth(table, fitted):
    for part in ("train", "test"):
        scored = twin.predict_validity(table.filter(F.col("split") == part), *fitted, ROLES)
        assert scored.filter("bucket <> planted").isEmpty()
        assert scored.filter("verdict is null or verdict <> label").isEmpty()
    assert 1.1 < fitted[1] < 4.0


def test_out_of_fold_verdicts(table):
    df = folds.group_kfold(table.filter("split = 'train'"), M, 5)
    dedup.assert_no_group_leakage(df, M, "fold")
    scored = twin.oof_verdict(df, "fold", roles=ROLES)
    assert scored.count() == df.count() and scored.filter("bucket <> planted").isEmpty()


def test_fold_expectations_equal_separate_fits(table):
    df = folds.group_kfold(features.valid_rows(table, ROLES), M, 3)
    twins = twin.fold_twins(df, "fold", ROLES)
    joint = twin.with_fold_expectations(df, twins, "fold").filter("fold = 1")
    alone = twins[1].expect(df.filter("fold = 1"), "alone_").select("test_id", "alone_s1")
    gap = joint.join(alone, "test_id").agg(F.max(F.abs(F.col("expected_s1") - F.col("alone_s1")))).first()[0]
    assert gap < 1e-9


def test_absent_and_shuffled_columns_change_nothing(table, fitted):
    rows = table.filter("split = 'test'")
    want = twin.predict_validity(rows, *fitted, ROLES).groupBy("verdict").count().collect()
    for kind in ("drop_extra", "shuffle_columns"):
        hurt = damage.damage(rows, kind, ROLES)
        got = twin.predict_validity(align_schema(hurt, ROLES), *fitted, ROLES, keys=twin.duplicate_keys(hurt, ROLES))
        assert sorted(got.groupBy("verdict").count().collect()) == sorted(want)


def test_copies_and_zero_rows_are_invalid(table, fitted):
    rows = table.filter("split = 'test'")
    zero = twin.predict_validity(damage.damage(rows, "zero_sensors", ROLES, share=1.0), *fitted, ROLES)
    assert zero.filter("verdict = 'Valid'").isEmpty()
    copied = twin.predict_validity(damage.append_copies(rows, F.lit(True)), *fitted, ROLES)
    assert copied.filter("verdict = 'Valid'").isEmpty()


def test_noise_keeps_the_gap(table, fitted):
    train = table.filter("split = 'train'")
    noisy = damage.add_noise(train.filter("label = 'Valid'"), ROLES.sensors, 0.25, "test_id").unionByName(
        train.filter("label <> 'Valid'"))
    gap = twin.gap(twin.predict_validity(noisy, *fitted, ROLES), ROLES).first()
    assert gap["valid_max"] < gap["spike_min"]


def test_guards(table):
    with pytest.raises(AssertionError):
        twin.fit_twin(table, ROLES)
    with pytest.raises(AssertionError):
        features.assert_no_sensor(["voltage", "s1"], ROLES)


def test_stratified_folds_are_even(table):
    counts = folds.stratified_kfold(table, "test_id", "label", 5).groupBy("label", "fold").count().toPandas()
    spread = counts.groupby("label")["count"].agg(lambda s: s.max() - s.min())
    assert (spread <= 1).all() and counts["count"].sum() == table.count()


def test_target_model_is_finite_and_accurate(table):
    df = folds.group_kfold(features.valid_rows(table.filter("split = 'train'"), ROLES), M, 2)
    model = reference.fit_reference(df, "fold", ROLES, boosts=3, depth=3)
    out = reference.predict_reference(table.filter("split = 'test'"), model)
    bad = F.count_if(F.col("predicted").isNull() | F.isnan("predicted"))
    err = F.avg(F.when(F.col("label") == "Valid", F.abs(F.col("ref") - F.col("predicted"))))
    row = out.agg(bad.alias("bad"), err.alias("mae")).first()
    assert row["bad"] == 0 and row["mae"] < 0.6


def test_permutation_importance_finds_the_inputs_that_matter(table):
    rows = features.valid_rows(table, ROLES).dropna(subset=["s4"])
    x = ["current_a", "s4"]
    model = models.forest_reg(rows, x, "ref", 3, 5)
    got = {r["feature"]: r["importance"] for r in
           ranking.permutation_importance(rows, model, x, "ref", "test_id", repeats=2).collect()}
    assert got["current_a"] > 0.5 and abs(got["s4"]) < 0.1


def test_anomaly_scores_prefer_spikes(table):
    df = table.filter("split = 'train'")
    ellipse = anomaly.fit_robust_cov(features.valid_rows(df, ROLES), M)
    share = {r["planted"]: r["s"] for r in df.filter(ellipse.distance().isNotNull()).groupBy("planted").agg(
        F.avg(ellipse.outlier().cast("int")).alias("s")).collect()}
    assert share["none"] == pytest.approx(0.05, abs=0.01) and share["spike"] > 0.9
    iso = anomaly.isolation_score(df, M, "test_id", F.col("label") == "Valid", trees=20)
    mean = {r["planted"]: r["m"] for r in iso.groupBy("planted").agg(F.avg("isolation_score").alias("m")).collect()}
    assert mean["spike"] < mean["none"]
