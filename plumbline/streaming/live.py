"""The twin on a stream of readings: scoring, duplicates, rolling threshold, counts, alarms, logs.

Event time must be a ``timestamp``; ``event_time`` casts a zone-less one, read as UTC when the
session time zone is UTC. Aggregating sinks receive a group again when it changes and must replace
rows by key; ``upsert_latest`` keeps the last value per key.
"""
from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from plumbline.functions import rowwise as rw
from plumbline.operators.twin import LineTwin, Twin, with_residuals
from plumbline.roles import Roles


def event_time(sdf: DataFrame, ts: str) -> DataFrame:
    return sdf.withColumn(ts, F.col(ts).cast("timestamp"))


def score_stream(sdf: DataFrame, twin: Twin | LineTwin, threshold: float, roles: Roles = Roles()) -> DataFrame:
    """Residuals, bucket and verdict of each reading by itself; duplicates need ``stream_duplicates``."""
    out = with_residuals(sdf, twin)
    bucket = (F.when(rw.any_missing(twin.sensors), "missing")
              .when(F.coalesce(F.col("max_abs_residual") > F.lit(float(threshold)), F.lit(False)), "spike")
              .otherwise("none"))
    return out.withColumn("bucket", bucket).withColumn(
        "verdict", F.when(F.col("bucket") == "none", roles.valid).otherwise(roles.invalid))


def stream_duplicates(sdf: DataFrame, cols: Sequence[str], ts: str, id: str, delay: str, span: str,
                      parts: int = 64) -> DataFrame:
    """Repeated vectors inside each time span: count and id range, emitted again as copies arrive.

    Use update mode. The first copy is corrected by the group's next emission: every row of a group
    with ``n > 1`` is a duplicate, and a reader finds its rows by the vector and the span. Ids are not
    listed, so a group of any size has one small state per part; ``parts`` spreads a hot vector over
    that many states, and ``duplicate_groups`` adds the parts up.
    """
    part = F.pmod(F.xxhash64(id), F.lit(parts)).alias("part")
    return (sdf.withWatermark(ts, delay).groupBy(*cols, part, F.window(ts, span).alias("span"))
            .agg(F.count("*").alias("n"), F.min(id).alias("first_id"), F.max(id).alias("last_id")))


def duplicate_groups(latest: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The repeated vectors in the latest state of ``stream_duplicates``."""
    return (latest.groupBy(*cols, "span").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"),
                                              F.max("last_id").alias("last_id")).filter("n > 1"))


def rolling_threshold(sdf: DataFrame, residual: str, ts: str, window: str, slide: str, delay: str, k: float = 7.0,
                      floor: float = 1e-6, size: int = 400) -> DataFrame:
    """Spike threshold per sliding window: ``k`` robust deviations of the residuals inside it.

    A row enters the one sketch of its slide; a window's sketch is merged from those of its slides, so
    ``window`` must be a multiple of ``slide``. Use append mode: a window comes once, when the
    watermark has passed its end. With ``size`` 400 the median's rank is off by less than one per
    cent in 99 of 100 windows. A window without residuals has threshold NULL.
    """
    parts = (sdf.withWatermark(ts, delay).groupBy(F.window(ts, slide).alias("slide"))
             .agg(F.count(residual).alias("n"), F.kll_sketch_agg_double(F.abs(F.col(residual)).cast("double"), F.lit(size)).alias("sketch")))
    spans = (parts.groupBy(F.window(F.window_time("slide"), window, slide).alias("span"))
             .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")))
    middle = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5).cast("double")))
    scaled = middle * F.lit(k * 1.4826)
    return spans.select("span", "n", F.when(scaled.isNotNull(), F.greatest(scaled, F.lit(floor))).alias("threshold"))


def bucket_counts(sdf: DataFrame, ts: str, span: str, delay: str, bucket: str = "bucket",
                  by: Sequence[str] = ()) -> DataFrame:
    """Rows per fault bucket and tumbling window."""
    return (sdf.withWatermark(ts, delay).groupBy(F.window(ts, span).alias("span"), bucket, *by)
            .agg(F.count("*").alias("n")))


def alarm_sessions(sdf: DataFrame, alarm: Column, ts: str, gap: str, delay: str, by: Sequence[str] = ()) -> DataFrame:
    """Episodes of alarms no further apart than ``gap``, per source."""
    return (sdf.filter(alarm).withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("episode"), *by)
            .agg(F.count("*").alias("n"), F.min(ts).alias("first_alarm"), F.max(ts).alias("last_alarm")))


def recalibration_sink(sdf: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append every micro-batch to a log for later refits; exactly once by the batch id column."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (sdf.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


class StreamCounts(StreamingQueryListener):
    """Counts over all of a query's progress reports, however many: register it before the query starts.

    ``rows_read``; ``groups_late``, groups of a batch that came after the watermark and were dropped;
    ``groups_open``, groups in the state that may still change.
    """

    def __init__(self):
        self.rows_read = self.groups_late = self.groups_open = 0
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        report = event.progress
        self.rows_read += max(report.numInputRows, 0)
        self.groups_late += sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
        self.groups_open = sum(op.numRowsTotal for op in report.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def wait(self, seconds: float = 60.0) -> StreamCounts:
        if not self._ended.wait(seconds):
            raise TimeoutError("the query's last report did not arrive")
        return self


def run_available(sdf: DataFrame, path: str, checkpoint: str, mode: str) -> tuple[DataFrame, StreamCounts]:
    """Run a stream over what is there and write every emission, with its batch number, to ``path``."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("emission", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    spark, counts = sdf.sparkSession, StreamCounts()
    spark.streams.addListener(counts)
    try:
        query = (sdf.writeStream.outputMode(mode).foreachBatch(emit).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        counts.wait()
    finally:
        spark.streams.removeListener(counts)
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*").drop("batch"), counts


def upsert_latest(emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last emitted value per key."""
    rest = [c for c in emitted.columns if c not in (*keys, "emission")]
    return (emitted.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("emission")).alias("_v"))
            .select(*keys, *[F.col("_v")[c].alias(c) for c in rest]))
