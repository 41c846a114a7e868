"""Streams over the events table, run to the end of the data and compared with batch SQL."""
from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators.twin import LineTwin
from plumbline.plans.registry import query, table
from plumbline.sources.shared import shared_folder
from plumbline.streaming import live


def events(spark, sf_dir):
    """The events table as a stream; one file per trigger."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = table(spark, sf_dir, "events").schema
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
        "pathGlobFilter", "events.parquet").parquet(sf_dir)
    return live.event_time(sdf, "ts")


def run(spark, sdf, mode):
    return live.run_available(sdf, shared_folder(spark, "emitted"), shared_folder(spark, "stream"), mode)[0]


# reading = value, expected by a fixed line in the rig number
TWIN = LineTwin("user_id", {"value": (0.01, 8.0)})
SCORED_SQL = """s AS (SELECT *, value - (0.01e0 * user_id + 8e0) AS r,
       CASE WHEN abs(value - (0.01e0 * user_id + 8e0)) > 20 THEN 'spike' ELSE 'none' END AS bucket FROM events)"""


def scored(spark, sf_dir):
    return live.score_stream(events(spark, sf_dir), TWIN, 20.0)


@query(f"WITH {SCORED_SQL} SELECT event_id, round(r, 9) AS residual, bucket, CASE bucket WHEN 'none' THEN 'Valid' ELSE 'Invalid' END AS verdict FROM s")
def stream_verdicts(spark, sf_dir):
    out = scored(spark, sf_dir).select("event_id", F.round("residual_value", 9).alias("residual"), "bucket", "verdict")
    return run(spark, out, "append").drop("emission")


@query("""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, user_id, event_type, count(*) AS n,
       min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY ALL HAVING count(*) > 1""")
def stream_duplicates(spark, sf_dir):
    cols = ["user_id", "event_type"]
    emitted = run(spark, live.stream_duplicates(events(spark, sf_dir), cols, "ts", "event_id", "1 day", "1 day"), "update")
    latest = live.upsert_latest(emitted, [*cols, "part", "span"])
    return live.duplicate_groups(latest, cols).select(
        F.date_format("span.start", "yyyy-MM-dd").alias("day"), *cols, "n", "first_id", "last_id")


@query(f"""WITH {SCORED_SQL} SELECT strftime(date_trunc('day', ts) - k * INTERVAL 1 DAY, '%Y-%m-%d') AS day, count(r) AS n, true AS near_median
       FROM s, (VALUES (0), (1)) AS o(k)
       WHERE date_trunc('day', ts) - k * INTERVAL 1 DAY + INTERVAL 2 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM s) GROUP BY 1""")
def stream_rolling_threshold(spark, sf_dir):
    """Two-day windows that are over, and whether each threshold belongs to a rank within two per cent of the exact median."""
    window = ("2 days", "1 day")
    out = run(spark, live.rolling_threshold(scored(spark, sf_dir), "residual_value", "ts", *window, "1 day"), "append")
    rows = live.score_stream(live.event_time(table(spark, sf_dir, "events"), "ts"), TWIN, 20.0).select(
        F.window("ts", *window).alias("span"), (F.abs("residual_value") * F.lit(7.0 * 1.4826)).alias("size"))
    limits = out.select("span", "n", "threshold")
    # the threshold is a residual of the window, so ranks below it and up to it must enclose the middle
    return (rows.join(limits, "span").groupBy("span", "n")
            .agg(F.count_if(F.col("size") < F.col("threshold")).alias("below"), F.count_if(F.col("size") <= F.col("threshold")).alias("upto"))
            .select(F.date_format("span.start", "yyyy-MM-dd").alias("day"), "n",
                    ((F.col("below") <= 0.52 * F.col("n") + 1) & (F.col("upto") >= 0.48 * F.col("n") - 1)).alias("near_median")))


@query(f"WITH {SCORED_SQL} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, bucket, count(*) AS n FROM s GROUP BY ALL")
def stream_bucket_counts(spark, sf_dir):
    out = live.bucket_counts(scored(spark, sf_dir), "ts", "1 hour", "1 hour")
    latest = live.upsert_latest(run(spark, out, "update"), ["span", "bucket"])
    return latest.select(F.date_format("span.start", "yyyy-MM-dd HH").alias("hour"), "bucket", "n")


def arriving(spark, sf_dir):
    """The events in three arrivals of several files each, the last with rows of the first days that come too late.

    An arrival has a file a core, and as many files make a micro-batch. A micro-batch drops what the watermark of the one before it has passed, so it takes two to make rows late.
    """
    path, day, files = shared_folder(spark, "arrivals"), F.to_date("ts"), spark.sparkContext.defaultParallelism
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = rows.agg(F.min(day)).scalar()
    late = (F.col("event_id") % 9 == 4) & (day <= F.date_add(first, 5))
    even = F.col("event_id") % 2 == 0
    for part in (rows.filter(~late & even), rows.filter(~late & ~even), rows.filter(late)):
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


ARRIVING_SQL = f"""{SCORED_SQL}, d AS (SELECT *, event_id % 9 = 4 AND CAST(ts AS DATE) <= (SELECT min(CAST(ts AS DATE)) FROM events) + 5
       AS late FROM s), w AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm,
       max(ts) FILTER (event_id % 2 = 0) - INTERVAL 1 HOUR AS before FROM d WHERE NOT late)"""


@query(f"""WITH {ARRIVING_SQL}, g AS (SELECT date_trunc('hour', ts) AS hour, bucket, late FROM d)
       SELECT (SELECT count(*) FROM events) AS rows_read,
       (SELECT count(DISTINCT (hour, bucket)) FROM g, w WHERE late AND hour + INTERVAL 1 HOUR <= before) AS groups_late,
       (SELECT count(DISTINCT (hour, bucket)) FROM g, w WHERE NOT late AND hour + INTERVAL 1 HOUR > wm) AS groups_open""")
def stream_late_and_open(spark, sf_dir):
    """What a windowed count dropped as late and what it still holds back when the data ends."""
    out = live.bucket_counts(live.score_stream(arriving(spark, sf_dir), TWIN, 20.0), "ts", "1 hour", "1 hour")
    _, counts = live.run_available(out, shared_folder(spark, "emitted"), shared_folder(spark, "stream"), "append")
    return spark.createDataFrame([(counts.rows_read, counts.groups_late, counts.groups_open)],
                                 "rows_read bigint, groups_late bigint, groups_open bigint")


@query(f"""WITH {ARRIVING_SQL}, h AS (SELECT date_trunc('hour', ts) AS h, bucket, count(*) AS n FROM d WHERE NOT late GROUP BY ALL)
       SELECT strftime(h, '%Y-%m-%d %H') AS hour, bucket, n FROM h, w WHERE h + INTERVAL 1 HOUR <= wm""")
def stream_closed_counts(spark, sf_dir):
    """Counts of windows that no row can change any more, each emitted once."""
    out = live.bucket_counts(live.score_stream(arriving(spark, sf_dir), TWIN, 20.0), "ts", "1 hour", "1 hour")
    return run(spark, out, "append").select(F.date_format("span.start", "yyyy-MM-dd HH").alias("hour"), "bucket", "n")


@query(f"""WITH {SCORED_SQL}, a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR
         THEN 0 ELSE 1 END AS fresh FROM s WHERE bucket = 'spike'),
       g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM a)
       SELECT user_id, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_alarm,
         strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_alarm FROM g GROUP BY user_id, k
       HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM a)""")
def stream_alarm_episodes(spark, sf_dir):
    """Episodes that are over, each emitted once; the state holds only those that may go on."""
    out = live.alarm_sessions(scored(spark, sf_dir), F.col("bucket") == "spike", "ts", "6 hours", "1 hour", ["user_id"])
    form = "yyyy-MM-dd HH:mm:ss"
    return run(spark, out, "append").select(
        "user_id", "n", F.date_format("first_alarm", form).alias("first_alarm"), F.date_format("last_alarm", form).alias("last_alarm"))


@query(f"WITH {SCORED_SQL} SELECT bucket, count(*) AS n, round(avg(r), 6) AS mean_residual FROM s GROUP BY bucket")
def stream_recalibration_log(spark, sf_dir):
    path = shared_folder(spark, "log")
    live.recalibration_sink(scored(spark, sf_dir), path, shared_folder(spark, "stream")).awaitTermination()
    log = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return log.groupBy("bucket").agg(F.count("*").alias("n"), F.round(F.avg("residual_value"), 6).alias("mean_residual"))
