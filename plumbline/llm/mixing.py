"""Mixing sources to target weights by weighted fair queueing."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import bucket_count, hash62, hash_bucket, running_total, word_count
from plumbline.sources.shared import settled


# parts of the copy that a source is being served at time 1
PACKETS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: int) -> DataFrame:
    """``_source``, ``source_size``, ``target`` from one row (``_source``, ``source_size``) a source.

    The budget, ``share`` of all sizes, is divided by weight; a target stops at ``max_repeats`` times
    its source and the excess goes to the others by weight. Sorted by cap over weight, the capped
    sources come first, so one running sum finds the level at which nobody else is above.
    """
    by_name = Window.orderBy("_source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    cap = F.col("source_size") * max_repeats
    weighed = sizes.select("*", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1).alias("_weight"),
                           cap.cast("double").alias("_cap"))
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_source")
    upto, after = (by_level.rowsBetween(Window.unboundedPreceding, -1),
                   by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    budget = F.sum("source_size").over(Window.partitionBy()) * share
    levels = weighed.withColumn("_level", (budget - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
                                / F.sum("_weight").over(after))
    free = F.when(F.col("_cap") / F.col("_weight") > F.col("_level"), F.col("_level"))
    # the first source that is not capped has the level of all that are not: later ones differ by rounding only
    level = F.first(free, ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.select("_source", "source_size", F.least(
        "_cap", F.coalesce(level * F.col("_weight"), F.col("_cap"))).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_repeats: int = 2,
        cut: bool = True, keep: Sequence[str] = ("doc_id",), size: Column | None = None, seed: int = 17) -> DataFrame:
    """The copies of documents that a mix takes, with their place in it.

    ``docs`` needs ``doc_id``, ``source`` and, unless ``size`` is given, ``text``. Every source is a
    queue of its documents in hashed order, repeated ``max_repeats`` times. A copy's virtual finish
    time is its queue's running words divided by the source's target in whole words, so at time 1 every source has
    been served its target. Copies are range-sorted by finish time over all sources and taken in that
    order until the running words reach the budget, the sum of those targets.

    The one copy of a source that is being served at time 1 goes in up to ``PACKETS`` packets of
    words, each with a finish time of its own, so that the budget can end inside it. Returns a row for
    each copy of each row: the columns ``keep``, ``row_id`` (one a row of ``docs``), ``copy`` from 0,
    ``size``, ``source_size``, ``target``, ``words`` (0: not taken), ``finish`` and ``position`` (words
    taken before it, in order of finish). Without ``cut`` copies are taken whole: one
    in packets is taken if the word in its middle is.

    Null or empty texts have size 0 and are never taken; a null source is the last source; a source
    without words has target 0; very long texts count whole; repeated rows are documents of their
    own, and documents of equal hash or doc_id are told apart by ``row_id``. An empty table gives no
    rows. Columns of ``docs`` that are not named here are not read, so their names cannot clash.
    """
    named = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    sized = settled(docs.select(
        *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.col("doc_id").alias("_doc"),
        named.alias("_source"), (word_count(F.col("text")) if size is None else size.cast("long")).alias("size"),
        F.monotonically_increasing_id().alias("row_id")), "mix-sizes")
    buckets = bucket_count(sized.count())
    # rows of one doc_id, or without one, spread over the buckets by their row_id
    shuffled = (F.lit(seed), "_doc", "row_id")
    sized = sized.withColumns({"_bucket": hash_bucket(buckets, *shuffled), "_order": hash62(*shuffled)})
    targets = settled(source_targets(sized.groupBy("_source").agg(F.sum("size").alias("source_size")),
                                     weights, share, max_repeats), "mix-targets")
    queued = running_total(sized, "_bucket", ["_order", "row_id"], "size", "_before", by=["_source"])
    # facts of a source go by (source, bucket), so that a hot source is not one key of the join
    facts = sized.select("_source", "_bucket").distinct().join(targets, "_source")
    start = F.col("_before") + F.col("copy") * F.col("source_size")
    copies = (queued.join(facts, ["_source", "_bucket"])
              .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))).withColumn("_start", start))
    due = F.round("target")
    served = (F.col("_start") < due) & (F.col("_start") + F.col("size") > due)
    copies = copies.withColumn("_served", F.coalesce(served, F.lit(False)))
    packet = F.when(F.col("_served"), F.greatest(F.lit(1), F.ceil(F.col("size") / PACKETS))).otherwise(F.greatest(F.lit(1), F.col("size"))).cast("long")
    copies = copies.withColumn("_packet", packet).withColumn("_p", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / F.col("_packet"))))))
    upto = F.least(F.col("size"), (F.col("_p") + 1) * F.col("_packet"))
    finish = (F.col("_start") + upto) / F.nullif(due, F.lit(0.0))
    copies = copies.withColumns({"_words": upto - F.col("_p") * F.col("_packet"), "_middle": F.floor((F.col("size") - 1) / 2 / F.col("_packet")) == F.col("_p"),
                                 "finish": F.coalesce(finish, F.lit(float("inf")))})
    # what ends long after the budget only has to come last: it is spread over ranges of its own
    ranges = F.when(F.col("finish") <= 2, F.floor(F.col("finish") * buckets).cast("long")).otherwise(
        2 * buckets + 1 + F.pmod("_order", F.lit(buckets)))
    copies = settled(copies.withColumn("_range", ranges).drop("_bucket", "_before", "_packet"), "mix-copies")
    placed = running_total(copies, "_range", ["finish", "_order", "copy", "row_id", "_p"], "_words", "_place")
    budget = targets.agg(F.sum(due.cast("long"))).first()[0] or 0
    taken = F.greatest(F.least(F.col("_words"), F.lit(budget) - F.col("_place")), F.lit(0))
    if not cut:
        taken = F.when(F.col("_middle") & (F.col("size") > 0) & (2 * taken >= F.col("_words")), F.col("size")).otherwise(0)
    kept = [f"_keep{i}" for i in range(len(keep))]
    facts = [*kept, "row_id", "copy", "size", "source_size", "target", "_order"]
    parts = settled(placed.select(*facts, taken.cast("long").alias("words"), "finish", "_served"), "mix-parts")
    # packets of a copy add up again: a copy or two a source
    whole = parts.filter("_served").groupBy("row_id", "copy").agg(
        *[F.first(c).alias(c) for c in facts if c not in ("row_id", "copy")], F.sum("words").alias("words"), F.max("finish").alias("finish"))
    joined = settled(parts.filter("not _served").drop("_served").unionByName(whole).withColumn("_range", ranges), "mix-taken")
    return (running_total(joined, "_range", ["finish", "_order", "copy", "row_id"], "words", "position").drop("_range", "_order")
            .select(*kept, "row_id", "copy", "size", "source_size", "target", "words", "finish", "position")
            .withColumnsRenamed(dict(zip(kept, keep))))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as the mix takes them: whole documents, each as often as it has copies in the mix, all columns as they were.

    Rows that share a doc_id are taken equally often.
    """
    copies = (mix(docs, cut=False, **how).filter("words > 0").groupBy("doc_id", "row_id").agg(F.count(F.lit(1)).alias("_n"))
              .groupBy(F.col("doc_id").alias("_id")).agg(F.max("_n").cast("int").alias("_copies")))
    # a row travels as one struct, so that no column of its own can clash
    rows = docs.select(F.col("doc_id").alias("_doc"), F.struct(*docs.columns).alias("_row"))
    return (rows.join(copies, F.col("_doc").eqNullSafe(F.col("_id")))
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*"))
