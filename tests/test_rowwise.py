"""Row functions on hand-made rows: 0 to 4 sensors present, zero spread, zero denominators."""
import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import rowwise as rw

S = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(0, None, None, None, None), (1, 5.0, None, None, None), (2, 1.0, 3.0, None, None),
            (3, 1.0, None, 2.0, 9.0), (4, 1.0, 2.0, 3.0, 100.0), (5, 7.0, 7.0, 7.0, 7.0), (6, 7.0, 7.0, 7.0, 9.0),
            (7, -1.0, 0.0, 1.0, -0.0)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, d double")
    out = df.select("id", rw.row_mean(S).alias("mean"), rw.row_median(S).alias("median"), rw.row_mad(S).alias("mad"),
                    rw.row_std(S).alias("std"), rw.row_cv(S).alias("cv"), rw.row_trimmed_mean(S).alias("trimmed"),
                    rw.n_available(S).alias("n"), rw.n_missing(S).alias("gone"), rw.row_range(S).alias("range"),
                    rw.n_outside_consensus(S).alias("outside"), rw.miss_pattern(S).alias("pattern"),
                    rw.safe_ratio("a", "b").alias("ratio"), rw.arg_max_abs(S).alias("top"),
                    rw.negative_flag("a").alias("neg"), rw.zero_flag("d").alias("zero"), rw.sqrt_clip("a").alias("root"))
    return {r["id"]: r for r in out.collect()}


def test_counts_and_patterns(rows):
    assert [rows[i]["n"] for i in range(8)] == [0, 1, 2, 3, 4, 4, 4, 4]
    assert rows[3]["gone"] == 1 and rows[3]["pattern"] == "0100"


def test_empty_row_is_null(rows):
    assert all(rows[0][k] is None for k in ("mean", "median", "mad", "std", "cv", "trimmed", "range", "top"))
    assert rows[0]["outside"] == 0


def test_means_and_medians(rows):
    assert rows[2]["mean"] == 2.0 and rows[2]["median"] == 2.0 and rows[2]["trimmed"] == 2.0
    assert rows[3]["median"] == 2.0 and rows[3]["trimmed"] == 2.0
    assert rows[4]["median"] == 2.5 and rows[4]["trimmed"] == 2.5 and rows[4]["mad"] == 1.0


def test_spread(rows):
    assert rows[1]["std"] is None and rows[5]["std"] == 0.0
    assert math.isclose(rows[2]["std"], math.sqrt(2.0))
    assert rows[7]["cv"] is None  # mean 0


def test_consensus(rows):
    assert rows[4]["outside"] == 1  # 100 against MAD 1
    assert rows[5]["outside"] == 0  # no spread at all
    assert rows[6]["outside"] == 1  # MAD 0, falls back to the deviation
    assert rows[1]["outside"] == 0


def test_flags_and_ratios(rows):
    assert rows[7]["neg"] == 1 and rows[7]["zero"] == 1 and rows[0]["neg"] == 0
    assert rows[7]["ratio"] is None and rows[2]["ratio"] == 1 / 3
    assert rows[7]["root"] == 0.0 and rows[7]["top"] == "a"


def test_rounding_is_half_even_on_the_scaled_value(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.675,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(rw.round_half_even("x", 0)).collect()] == [0.0, 2.0, 3.0, -0.0]


def test_clip_widens_the_range(spark):
    df = spark.createDataFrame([(-100.0,), (5.0,), (100.0,)], "x double")
    got = [r[0] for r in df.select(rw.clip_range(F.col("x"), F.lit(0.0), F.lit(10.0))).collect()]
    assert got == [-2.0, 5.0, 12.0]


def test_fingerprint_ignores_small_differences(spark):
    df = spark.createDataFrame([(1.00001, None), (1.00002, None), (1.1, 2.0)], "a double, b double")
    f = [r[0] for r in df.select(rw.fingerprint(["a", "b"])).collect()]
    assert f[0] == f[1] == "1.0000|-9000000000.0000" and f[2] == "1.1000|2.0000"
