"""Neighbour joins and group folds against plain search."""
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.operators import dedup, folds, neighbours


def lof(x, k):
    """By full search over rows, neighbourhoods with all ties."""
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    d = np.sqrt(((z[:, None] - z[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    reach = np.sort(d, 1)[:, k - 1]
    near = d <= reach[:, None] + 1e-12
    lrd = np.array([1 / (np.maximum(reach[n], d[i, n]).mean() + 1e-10) for i, n in enumerate(near)])
    return np.array([lrd[n].mean() / lrd[i] for i, n in enumerate(near)])


@pytest.mark.parametrize("cell, k", [(20, 5), (1024, 5), (8, 20)])
def test_outlier_factors_equal_full_search(spark, monkeypatch, cell, k):
    monkeypatch.setattr(neighbours, "CELL_POINTS", cell)
    monkeypatch.setattr(neighbours, "SAMPLE_A_CELL", 4)
    monkeypatch.setattr(neighbours, "QUERIES_A_TASK", 30)
    rng = np.random.default_rng(k + cell)
    x = np.concatenate([rng.normal(size=(150, 3)), rng.normal(size=(60, 3)) * 0.1 + 4, np.full((30, 3), 2.5),
                        rng.integers(0, 3, (60, 3)).astype(float)])  # clusters, copies, a grid with ties
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(900, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(5)
    got = {r.id: r for r in neighbours.local_outlier_factor(df, ["a", "b", "c"], k, 0.1).collect()}
    want = lof(x, k)
    assert len(got) == len(rows) and got[900].lof is None
    assert np.allclose([got[i].lof for i in range(len(x))], want, rtol=1e-9)
    assert {i for i in range(len(x)) if got[i].outlier} == set(np.flatnonzero(want > np.quantile(want, 0.9)))


def test_a_cell_with_too_few_points_looks_everywhere(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(6)], "id long, a double")
    assert neighbours.local_outlier_factor(df, ["a"], 20).filter("lof is null").count() == 0
    assert neighbours.local_outlier_factor(df.limit(0), ["a"], 20).count() == 0


GROUPS = "id long, a double, b double, label string"


def grouped(rng, n):
    rows = []
    for g in range(n):
        size = 1 if rng.random() < 0.7 else int(rng.integers(2, 6))
        rows += [(len(rows) + i, float(g), None if g % 7 == 0 else 1.0, ["x", "y", None][int(rng.choice(3, p=[0.7, 0.25, 0.05]))]) for i in range(size)]
    return rows


def test_group_folds_are_whole_even_and_independent_of_partitions(spark):
    rows = grouped(np.random.default_rng(4), 300)
    one, two = ({r.id: r.fold for r in folds.stratified_group_kfold(spark.createDataFrame(rows, GROUPS).repartition(p), ["a", "b"], "label").collect()}
                for p in (1, 6))
    assert one == two and len(one) == len(rows)
    by_group = {}
    for id_, a, *_ in rows:
        by_group.setdefault(a, set()).add(one[id_])
    assert all(len(f) == 1 for f in by_group.values())
    for label in ("x", "y", None):
        n = np.bincount([one[r[0]] for r in rows if r[3] == label], minlength=5)
        assert n.max() - n.min() <= 5


def test_group_folds_write_hashes_in_place_of_vectors(spark, monkeypatch):
    written, write = [], folds.settled
    monkeypatch.setattr(folds, "settled", lambda df, purpose="table": written.append(df.columns) or write(df, purpose))
    # one vector in half the rows, and vectors that differ only in which column is NULL
    rows = [(i, 1.00001 + i * 1e-9, 2.0, "x" if i % 3 else "y") for i in range(3000)]
    rows += [(3000 + i, *((float(i // 2), None) if i % 2 else (None, float(i // 2))), ["x", "y", None][i % 7 % 3]) for i in range(3000)]
    done = folds.stratified_group_kfold(spark.createDataFrame(rows, GROUPS).repartition(5), ["a", "b"], "label").collect()
    assert not [c for cols in written for c in cols if c in ("a", "b") or c.startswith("_r_")]
    assert sorted(r.id for r in done) == list(range(6000))
    assert len({r.fold for r in done if r.id < 3000}) == 1
    assert max(abs(n - 600) for n in np.bincount([r.fold for r in done if r.id >= 3000 and r.id % 2], minlength=5) * 2) < 1500
    found = dedup.split_groups(spark.createDataFrame(done), ["a", "b"], "fold", hashed=True)
    assert found.isEmpty()
    halves = spark.createDataFrame(done).withColumn("fold", F.when(F.col("id") < 3002, F.col("id") % 2).otherwise(F.col("fold")))
    assert dedup.split_groups(halves, ["a", "b"], "fold", hashed=True).select("n", "first_fold", "last_fold").collect() == [(3000, 0, 1)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 6), st.integers(0, 6)).filter(any), st.integers(1, 40), min_size=1, max_size=12))
def test_dealing_keeps_every_class_within_one_group(found):
    vectors = list(found.items())
    dealt = folds.deal_vectors(vectors, 5)
    loads = np.zeros((5, 2))
    for v, m in vectors:
        turns, rest = dealt[v]
        assert turns + len(rest) == m and turns % 5 == 0
        for f in [i % 5 for i in range(turns)] + rest:
            loads[f] += v
    for c in range(2):
        assert np.abs(loads[:, c] - loads[:, c].mean()).max() <= 2 * max(v[c] for v, _ in vectors)
