"""Sources, sinks and streams."""
import pytest
from pyspark.sql import functions as F

from plumbline.operators import folds
from plumbline.plans import stream_queries as sq
from plumbline.plans.registry import table
from plumbline.sources import sinks, tables
from plumbline.streaming import live


def test_nan_becomes_null_and_schema_is_checked(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id long, x double")
    df.write.parquet(str(tmp_path / "t.parquet"))
    got = tables.load_tables(spark, str(tmp_path), {"t": df.schema})["t"]
    assert got.filter("x is null").count() == 1 and got.filter("x > 1").count() == 1
    wrong = spark.createDataFrame([], "id long, y double").schema
    with pytest.raises(ValueError):
        tables.load_table(spark, str(tmp_path / "t.parquet"), wrong)


def test_csv_and_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "id long, x double")
    sinks.write_csv(df, str(tmp_path / "c.csv"))
    back = tables.load_table(spark, str(tmp_path / "c.csv"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.schema(df.schema).json(str(tmp_path / "j")).count() == 2


def test_fold_table_is_built_once(spark, tmp_path):
    df = spark.range(100).withColumnRenamed("id", "test_id")
    calls = []

    def build(d):
        calls.append(1)
        return folds.kfold(d, "test_id", 5)

    first = tables.get_folds(df, str(tmp_path / "folds.csv"), build).collect()
    second = tables.get_folds(df, str(tmp_path / "folds.csv"), build).collect()
    assert sorted(first) == sorted(second) and len(calls) == 1
    folds.assert_all_matched(df, tables.get_folds(df, str(tmp_path / "folds.csv"), build), "test_id")


def test_submission_is_checked_and_ordered(spark, tmp_path):
    template = spark.createDataFrame([(7, 0), (3, 1), (5, 2)], "id long, ord int")
    pred = spark.createDataFrame([(3, 1.0, "Valid"), (5, 2.0, "Invalid"), (7, 3.0, "Valid")], "id long, p double, v string")
    got = sinks.submission(pred, template, "id", ["id", "p", "v"]).collect()
    assert [r["id"] for r in got] == [7, 3, 5]
    sinks.write_submission(pred, template, str(tmp_path / "s"), "id", "p", "v")
    for bad in (pred.filter("id <> 3"), pred.withColumn("p", F.lit(float("nan"))), pred.withColumn("v", F.lit("maybe")),
                pred.unionByName(pred)):
        with pytest.raises(ValueError):
            sinks.write_submission(bad, template, str(tmp_path / "never"), "id", "p", "v")


def test_late_rows_are_counted_apart_from_open_windows(spark, small, tmp_path):
    ev = table(spark, small, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                                              F.lit("none").alias("bucket"))
    day = F.to_date("ts")
    first = ev.agg(F.min(day)).first()[0]
    src = str(tmp_path / "in")
    ev.filter(day > F.date_add(F.lit(first), 5)).coalesce(1).write.parquet(src)
    spark.read.parquet(src).count()
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = live.bucket_counts(stream, "ts", "1 hour", "1 hour")
    early, q1 = live.run_available(out, str(tmp_path / "o1"), str(tmp_path / "c"), "append")
    ev.filter(day <= F.date_add(F.lit(first), 5)).coalesce(1).write.mode("append").parquet(src)
    _, q2 = live.run_available(out, str(tmp_path / "o1"), str(tmp_path / "c"), "append")
    assert q2.rows_read > 0 and q2.groups_late > 0 and q1.groups_open > 0
    total = ev.filter(day > F.date_add(F.lit(first), 5)).count()
    assert 0 < early.agg(F.sum("n")).first()[0] <= total


def test_hot_vectors_are_spread_and_added_up(spark, small):
    cols = ["event_type"]
    out = live.stream_duplicates(sq.events(spark, small), cols, "ts", "event_id", "1 day", "30 days", parts=8)
    latest = live.upsert_latest(sq.run(spark, out, "update"), [*cols, "part", "span"])
    assert latest.groupBy(*cols, "span").count().agg(F.max("count")).first()[0] == 8
    n = live.duplicate_groups(latest, cols).agg(F.sum("n")).first()[0]
    assert n == table(spark, small, "events").count()


def test_rolling_thresholds_merge_slides_and_keep_windows_without_residuals(spark, tmp_path):
    rows = [(f"2024-01-0{1 + d} 0{i}:00:00", float(v) if d != 4 else None) for d in range(8) for i, v in enumerate([-3 - d, 1, 2 + d])]
    rows = spark.createDataFrame(rows, "ts string, r double").withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "in")
    rows.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    out = live.rolling_threshold(stream, "r", "ts", "2 days", "1 day", "1 hour", k=1 / 1.4826)
    got, _ = live.run_available(out, str(tmp_path / "o"), str(tmp_path / "c"), "append")
    found = {r.day: (r.n, r.threshold) for r in got.select(F.dayofmonth("span.start").alias("day"), "n", "threshold").collect()}
    # sizes of day d are 3 + d, 1, 2 + d; day 4 has none, and the window from the seventh day on is still open
    assert {d: n for d, (n, _) in found.items()} == {31: 3, 1: 6, 2: 6, 3: 6, 4: 3, 5: 3, 6: 6}
    assert found[31][1] == 2.0 and found[4][1] == 5.0 and 2.0 <= found[1][1] <= 3.0
