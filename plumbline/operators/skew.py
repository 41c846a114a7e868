"""Joining per-group facts back onto rows when one group may hold a large share of the rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.shared import settled

# A group is hot when it holds more than 1/HOT_SHARE of the rows the group table covers, so there are
# fewer than HOT_SHARE hot groups whatever the data: that is the size bound of their broadcast.
HOT_SHARE = 1024


def key_of(cols: Sequence[str]) -> Column:
    """One struct key out of several columns. Struct equality treats NULL as equal to NULL."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)])


def attach_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Left-join ``groups`` (one row per key, ``size`` rows each) onto ``rows``, NULL equal to NULL.

    The group table is worked out once and written to the shared folder. Hot groups are broadcast;
    all others are joined by key, and since the size of the written table is known, Spark broadcasts
    it too where it is small. In the join by key the rows of hot groups, which have their facts
    already, go to tasks by a hash of the whole row, so no task gets a hot key. ``rows`` is read once.
    """
    facts = [c for c in groups.columns if c not in keys]
    packed = settled(groups.select(key_of(keys).alias("_key"), F.struct(*facts).alias("_fact"),
                                   F.col(size).alias("_size")), "groups")
    return attach_packed(rows.withColumn("_key", key_of(keys)), packed, rows.columns, facts)


def attach_packed(rows: DataFrame, packed: DataFrame, columns: Sequence[str], facts: Sequence[str]) -> DataFrame:
    """``attach_groups`` of a written table ``(_key, _fact, _size)`` to rows that hold ``columns`` and their ``_key``."""
    is_hot = F.col("_size") * HOT_SHARE > packed.agg(F.sum("_size")).scalar()
    hot = packed.filter(is_hot).select("_key", F.col("_fact").alias("_hot"))
    cold = packed.filter(~is_hot).select(F.col("_key").alias("_cold_key"), F.col("_fact").alias("_cold"), F.lit(0).alias("_zero"))
    marked = (rows.join(F.broadcast(hot), "_key", "left")
              .withColumn("_deal", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
                  (F.pmod(F.xxhash64(*columns), F.lit(HOT_SHARE)) + 1).cast("int"))))
    joined = marked.join(cold, (F.col("_key") == F.col("_cold_key")) & (F.col("_deal") == F.col("_zero")), "left")
    fact = F.coalesce("_hot", "_cold")
    return joined.select(*[F.col(c) for c in columns], *[fact[c].alias(c) for c in facts])
