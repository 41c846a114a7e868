"""Exact order statistics against numpy and pandas, with a value shared by a third of the rows."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import bins, ordered, skew

PROBS = {"p0": 0.0, "q": 0.25, "m": 0.5, "r": 0.731, "p1": 1.0}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 20_000
    pdf = pd.DataFrame({"id": np.arange(n), "a": np.where(rng.random(n) < 0.34, 3.0, np.round(rng.normal(size=n) * 5, 2)),
                        "b": rng.exponential(size=n), "g": rng.integers(0, 3, n)})
    pdf.loc[rng.random(n) < 0.1, "b"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("b", F.when(~F.isnan("b"), F.col("b"))).repartition(5)
    return pdf, df


@pytest.mark.parametrize("bracket", [4_000_000, 200])
def test_quantiles_are_exact(data, bracket, monkeypatch):
    pdf, df = data
    monkeypatch.setattr(ordered, "BRACKET_ROWS", bracket)
    got = ordered.quantile_values(df, ["a", "b"], PROBS)
    for c in "ab":
        assert np.allclose(list(got[c].values()), pdf[c].quantile(list(PROBS.values())), rtol=0, atol=1e-12)
    by = {(r["g"], r["column"]): r for r in ordered.quantiles(df, ["a", "b"], PROBS, ["g"]).collect()}
    for (g, c), r in by.items():
        assert np.allclose([r[k] for k in PROBS], pdf[pdf.g == g][c].quantile(list(PROBS.values())), rtol=0, atol=1e-12)


def test_sketched_quantiles_are_close(data):
    pdf, df = data
    got = ordered.quantile_values(df, ["b"], {"m": 0.5}, accuracy=1000)["b"]["m"]
    assert abs((pdf.b < got).sum() / pdf.b.notna().sum() - 0.5) < 0.01


def test_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "a double, b double")
    assert ordered.quantile_values(df, ["a", "b"], {"m": 0.5}) == {"a": {"m": 1.0}}
    assert ordered.quantile_values(df.filter("a > 5"), ["a"], {"m": 0.5}) == {}


def test_average_and_percent_ranks(data):
    pdf, df = data
    want = pdf.drop_duplicates("a").set_index("a").index
    ranks = {r["value"]: r["avg_rank"] for r in ordered.average_ranks(df, ["a"]).collect()}
    assert set(ranks) == set(want)
    expected = pdf.a.rank().groupby(pdf.a).first()
    assert all(ranks[v] == expected[v] for v in ranks)
    pct = {r["value"]: r["pct_rank"] for r in ordered.percent_ranks(df, ["a"]).collect()}
    low = (pdf.a.rank(method="min") - 1).groupby(pdf.a).first() / (len(pdf) - 1)
    assert all(abs(pct[v] - low[v]) < 1e-15 for v in pct)


@pytest.mark.parametrize("share", [1024, 2])
def test_attach_groups_keeps_every_row(data, share, monkeypatch):
    pdf, df = data
    monkeypatch.setattr(skew, "HOT_SHARE", share)
    keyed = df.withColumn("k", F.when(F.col("b").isNull(), None).otherwise(F.col("g"))).select("id", "a", "k")
    sizes = keyed.groupBy("a", "k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    out = skew.attach_groups(keyed, sizes, ["a", "k"], "n")
    assert out.count() == len(pdf) and out.filter("first is null").isEmpty()
    assert out.agg(F.sum(1 / F.col("n"))).first()[0] == pytest.approx(sizes.count())


def test_qcut_matches_pandas(data):
    pdf, df = data
    got = bins.qcut(df, "a", 4).select("id", "a_bin").toPandas().set_index("id").a_bin.sort_index()
    want = pd.qcut(pdf.a, 4, labels=False, duplicates="drop")
    assert (got.to_numpy() == want.to_numpy()).all()
