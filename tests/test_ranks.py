"""Ranks of many columns at once, against plain numpy."""
import numpy as np
from pyspark.sql import functions as F

from plumbline.operators import ranks, stats


def _average_ranks(v):
    values, at, n = np.unique(v, return_inverse=True, return_counts=True)
    below = np.cumsum(n) - n
    return (below + (n + 1) / 2)[at]


def test_spearman_sends_only_values_between_edges(spark, monkeypatch):
    monkeypatch.setattr(ranks, "EDGES", 16)
    monkeypatch.setattr(ranks, "EDGE_ACCURACY", 200)
    rng = np.random.default_rng(3)
    n = 4000
    a, b = rng.normal(size=n), rng.integers(0, 5, n).astype(float)
    c = np.where(rng.random(n) < 0.4, 1.5, a + rng.normal(size=n))
    c[rng.random(n) < 0.1] = np.nan  # a gap, below
    rows = [(i, float(x), float(y), None if np.isnan(z) else float(z)) for i, (x, y, z) in enumerate(zip(a, b, c))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")

    values = ranks.marked_values(df, ["b"], [])
    slots = ranks.fit_slots(values, 1, 0)
    assert slots.in_gaps == 0 and slots.counts.sum() == n  # five values, all of them edges: nothing is shuffled

    got = {(r.col_a, r.col_b): r.r for r in stats.spearman_matrix(df, ["a", "b", "c"], "id").collect()}
    cols = {"a": a, "b": b, "c": c}
    for (x, y), r in got.items():
        on = ~np.isnan(cols[x]) & ~np.isnan(cols[y])
        want = np.corrcoef(_average_ranks(cols[x][on]), _average_ranks(cols[y][on]))[0, 1]
        assert abs(r - want) < 1e-12
    assert len(got) == 3


def test_spearman_of_repeated_ids_and_constants(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 5.0), (1, 3.0, None, 5.0), (2, 2.0, 1.0, 5.0), (None, 4.0, 3.0, 5.0), (3, None, 7.0, 5.0)],
                               "id long, a double, b double, k double")
    got = {(r.col_a, r.col_b): r.r for r in stats.spearman_matrix(df, ["a", "b", "k"], "id").collect()}
    # the rows of id 1 count as one with its largest values; its a of 3 lies between the others that have b
    x, y = np.array([2.5, 2.0, 3.0]), np.array([2.0, 1.0, 3.0])
    assert abs(got["a", "b"] - np.corrcoef(x, y)[0, 1]) < 1e-12
    assert got["a", "k"] is None and got["b", "k"] is None


def test_submission_checks_with_ids_near_64_bits(spark, small, tmp_path):
    from plumbline.plans.twin_queries import submission_checks

    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    lines.withColumn("l_orderkey", F.col("l_orderkey") + 9_000_000).write.parquet(f"{tmp_path}/lineitem.parquet")
    far, near = submission_checks(spark, str(tmp_path)).first(), submission_checks(spark, small).first()
    assert far.repeated_ids == 0 and near.repeated_ids == 0
    assert min(far.missing_ids, far.extra_ids, far.bad_values, far.bad_labels) > 0


def test_two_sample_sums_with_nan_and_infinite_values(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(5)
    a = np.round(rng.normal(size=3000), 2)
    a[rng.random(3000) < 0.4] = nan
    a[:40], a[40:90] = inf, -inf
    f = rng.random(3000) < 0.3
    df = spark.createDataFrame([(float(x), None if i % 50 == 0 else float(x > 0), None if i % 7 == 0 else bool(y)) for i, (x, y) in enumerate(zip(a, f))],
                               "a double, b double, f boolean")
    nans = spark.createDataFrame([(nan,)] * 50 + [(inf,)] * 50, "a double")
    assert ranks.fit_slots(ranks.marked_values(nans, ["a"], []), 1, 0).in_gaps == 0  # a value many rows share does not travel

    known = np.arange(3000) % 7 > 0
    got = {r[0]: r[1:] for r in ranks.two_sample_sums(df, ["a", "b"], F.col("f"))}
    flagged = f & known  # an unknown flag is no flag
    for c, v, there in (("a", a, np.ones(3000, bool)), ("b", (a > 0).astype(float), np.arange(3000) % 50 > 0)):
        code = np.unique(v[there], return_inverse=True)[1]
        y, n = flagged[there], np.bincount(code)
        rank = _average_ranks(code)
        n0, n1, rank_sum, ties, gap = got[c]
        assert (n0, n1) == ((~y).sum(), y.sum()) and rank_sum == rank[y].sum() and ties == (n.astype(float) ** 3 - n).sum()
        apart = np.cumsum(np.bincount(code, y)) / y.sum() - np.cumsum(np.bincount(code, ~y)) / (~y).sum()
        assert abs(gap - np.abs(apart).max()) < 1e-12
    row = {r.column: r for r in stats.ks_2samp(df, ["a", "b"], F.col("f")).collect()}
    assert row["a"].n_a == flagged.sum() and row["a"].n_a + row["a"].n_b == known.sum()  # rows of unknown sample are in neither
