"""Results must not depend on partitions, on limits or on how many groups there are."""
import pytest
from pyspark.sql import functions as F

from plumbline.operators import benchmark, dedup, folds, ordered, ranking
from plumbline.operators.models import fold_values, oof_predict


def test_more_than_ten_thousand_repeated_groups(spark):
    rows = spark.range(30_000).select("id", (F.col("id") % 12_000).alias("v"), F.lit(None).cast("double").alias("w"))
    hot = spark.range(20_000).select((F.col("id") + 100_000).alias("id"), F.lit(-1).cast("long").alias("v"), F.lit(1.0).alias("w"))
    got = dedup.group_id(dedup.is_duplicate(rows.union(hot), ["v", "w"]), ["v", "w"], "id")
    assert got.count() == 50_000
    assert got.filter("not is_dup").count() == 0
    assert got.filter("v >= 0 and group_id <> v").count() == 0
    assert got.filter("v < 0 and group_id <> 100000").count() == 0


def test_group_join_keeps_null_keys(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "b"), (5, "b")], "id long, k string")
    got = {r.id: (r.is_dup, r.group_size) for r in dedup.group_facts(rows, ["k"], {}, flag="is_dup").collect()}
    assert got == {1: (True, 2), 2: (True, 2), 3: (False, 1), 4: (True, 2), 5: (True, 2)}


@pytest.fixture
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_permutation_importance_does_not_depend_on_partitions(spark, partitions):
    rows = spark.range(1000).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"),
                                    (F.col("id") * 17 % 89).cast("double").alias("b")).withColumn("y", 2 * F.col("a") + F.col("b"))
    found = []
    for n in (4, 40, 200):
        partitions(n)
        out = ranking.permutation_importance(rows, lambda x: 2 * F.get(x, F.lit(0)) + F.get(x, F.lit(1)), ["a", "b"], "y", "id", repeats=3)
        found.append({r.feature: (round(r.importance, 9), round(r["std"], 9)) for r in out.collect()})
    assert found[0] == found[1] == found[2]
    assert found[0]["a"][0] > found[0]["b"][0] > 0.1


def test_shifts_never_leave_a_row_in_place():
    for n in (2, 3, 10, 1000):
        assert all(1 <= s < n for s in ranking.shift_of(n, 10))


def test_a_missing_class_gets_folds_too(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 2).alias("label"))
    got = folds.stratified_kfold(rows, "id", "label", 5)
    assert got.count() == 1000 and got.filter("fold is null").count() == 0
    counts = got.groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("d"))
    assert counts.agg(F.max("d")).first()[0] <= 1


def test_folds_need_not_start_at_zero(spark):
    rows = spark.range(200).select((F.col("id") % 5 + 1).cast("int").alias("fold"), F.col("id").cast("double").alias("x"),
                                   (F.col("id") * 2.0).alias("y"))
    assert fold_values(rows) == [1, 2, 3, 4, 5]
    seen = []

    class Model:
        def transform(self, df):
            seen.append(df)
            return df.withColumn("prediction", F.lit(0.0))

    assert oof_predict(rows, lambda d: Model(), fold_values(rows)).count() == 200 and len(seen) == 5


def test_quantiles_of_many_groups_and_columns(spark):
    cols = [f"c{i}" for i in range(8)]
    rows = spark.range(13_000).select((F.col("id") % 1300).alias("g"), *[(F.col("id") * (i + 1)).cast("double").alias(c)
                                                                     for i, c in enumerate(cols)])
    got = ordered.quantiles(rows, cols, {"m": 0.5}, by=["g"])
    assert got.count() == 1300 * 8
    # members of group g are g, g + 1300, ..., g + 11700: their median is g + 5850
    assert got.filter("column = 'c0' and m <> g + 5850").count() == 0


def test_ridge_on_columns_of_very_different_sizes(spark):
    rows = spark.range(400).select((F.col("id") % 4).cast("int").alias("fold"), (1e9 + F.col("id") * 1.0).alias("big"),
                                   (F.col("id") % 7 * 1e-6).alias("tiny")).withColumn("y", F.col("big") - 1e9 + 1e6 * F.col("tiny"))
    per = benchmark.ridge_by_set(rows, {"both": ["big", "tiny"]}, "y", "fold", alpha=1e-6).collect()
    assert len(per) == 4 and all(r.r2 > 0.999999 for r in per)


def test_rows_numbered_by_id_are_spread_over_ranges(spark):
    from plumbline.operators.folds import numbered

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select((F.col("id") * 7 % 4001 - 2000).alias("id"))
        got = numbered(df, [F.col("id")], hashed=False).withColumn("_task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r._i for r in sorted(got)] == list(range(4000))
    tasks = [r._task for r in got]
    assert max(tasks.count(t) for t in set(tasks)) < 3000


def test_histogram_counts_cells_by_number(spark):
    """One small expression bins every cell: one per column left the generated code too large to be compiled."""
    from plumbline.operators import bins

    cols = [f"c{i}" for i in range(9)]
    rows = [("a" if k % 3 else "b", *[None if k == i else float(k * (i + 1)) for i in range(8)], 2.0) for k in range(40)]
    df = spark.createDataFrame(rows, "label string, " + ", ".join(f"{c} double" for c in cols))
    out = bins.histogram(df, cols, 4, ["label"], density=True)
    plan = bins.histogram(df, cols, 4, ["label"])._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("floor(") == 1
    got = {(r.label, r.column, r.bin): (r.left, r.n) for r in out.collect()}
    want = {}
    for i, c in enumerate(cols):
        values = [(r[0], r[1 + i]) for r in rows if r[1 + i] is not None]
        lo, hi = min(v for _, v in values), max(v for _, v in values)
        start, width = (lo - 0.5, 1.0) if lo == hi else (lo, hi - lo)
        for label, v in values:
            b = min(int((v - start) / width * 4), 3)
            left, n = want.get((label, c, b), (start + b * (width / 4), 0))
            want[label, c, b] = left, n + 1
    assert got == want


def test_near_duplicates_shuffle_hashes_not_vectors(spark):
    from plumbline.operators import dedup

    rows = [(None, 1.0), (1.0, None), (None, 1.0004), (None, None), (0.0, 2.0), (-0.0, 2.0), (0.26, 5.0), (0.34, 5.0), (float("nan"), 3.0), (float("nan"), 3.0)]
    out = dedup.near_duplicates(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], (4, 3, 0))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(decimals" in plan.replace(" ", "") and "knownfloatingpointnormalized" not in plan  # no measurement is a key
    got = {r.decimals: (r.n_rows, r.n_groups) for r in out.collect()}
    assert got == {4: (4, 2), 3: (6, 3), 0: (8, 4)}


def test_isolation_forest_scores_fitted_rows_once(spark, monkeypatch):
    import numpy as np
    from plumbline.operators import anomaly

    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 2)).round(2)
    df = spark.createDataFrame([(i, float(a), None if i == 7 else float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    kept = []
    monkeypatch.setattr(anomaly, "settled", lambda d, purpose: kept.append(d.localCheckpoint()) or kept[-1])
    forest = anomaly.fit_isolation(df, ["a", "b"], "id", trees=5, sample=64)
    assert [d.columns for d in kept] == [["s"]]  # the quantile reads written scores

    def walked(row):
        depth = 0.0
        for feature, cut, left, right, leaf in forest.trees:
            at = 0
            while feature[at] >= 0:
                at = left[at] if row[feature[at]] < cut[at] else right[at]
            depth += leaf[at]
        return -np.exp2(-depth / len(forest.trees) / anomaly.average_depth(forest.sample))

    got = {r.id: r.s for r in df.select("id", forest.score().alias("s")).collect()}
    assert got[7] is None and all(got[i] == walked(x[i]) for i in range(600) if i != 7)
    assert sorted(r.s for r in kept[0].collect()) == sorted(v for v in got.values() if v is not None)


def test_ablations_of_the_same_rows_share_their_passes(spark, monkeypatch):
    from plumbline.operators import benchmark

    rows = [(i % 5, i % 11 > 0, float(i % 13), float(i % 7), float((i * i) % 29)) for i in range(300)]
    df = spark.createDataFrame(rows, "fold int, ok boolean, a double, b double, y double").withColumn("_score", F.col("ok"))
    ok = F.col("ok")
    cfg = {"one": {"inputs": ["a", "b"], "degree": 1, "train": ok}, "three": {"inputs": ["a", "b"], "degree": 3, "train": ok},
           "all": {"inputs": ["a", "b"], "degree": 3}}
    apart = {c: benchmark.ablate(df, {c: cfg[c]}, "y", "fold").first() for c in cfg}
    passes, real = [], benchmark.moments
    monkeypatch.setattr(benchmark, "moments", lambda *args: passes.append(1) or real(*args))
    got = {r.config: r for r in benchmark.ablate(df, cfg, "y", "fold").collect()}
    assert len(passes) == 2
    for c, want in apart.items():
        assert got[c].n == want.n and all(abs(got[c][k] - want[k]) < 1e-9 for k in ("mae", "mae_std", "mae_worst", "r2_mean"))
    assert abs(got["one"].mae - got["three"].mae) > 1e-6
