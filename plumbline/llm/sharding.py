"""Sharding along a Hilbert curve through document metadata."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bucket_count, running_total
from plumbline.sources.shared import settled


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points, one row a point, ``bits`` bits a dimension.

    From the highest bit down, each level either swaps a dimension's lower bits with the first
    dimension's or reflects them; the Gray code of the resulting axes, read bit by bit across the
    dimensions, is the index.
    """
    x = coords.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            set_here = (x[i] & level) != 0
            swap = np.where(set_here, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_here, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def string_cells(values: DataFrame, bits: int) -> list[str]:
    """The least string of every cell but the first: the distinct strings of ``value``, in order, in 2^bits even runs.

    Equal strings collapse first, so a string that very many rows hold is one row here; with at most
    2^bits distinct strings each has a cell of its own. Fewer than 2^bits strings reach the driver.
    """
    distinct = settled(values.groupBy("value").agg(F.lit(1).cast("long").alias("_one")), "distinct-strings")
    total = distinct.count()
    ranged = distinct.repartitionByRange(bucket_count(total), "value").withColumn("_bucket", F.spark_partition_id())
    ranked = running_total(settled(ranged, "string-order"), "_bucket", ["value"], "_one", "_rank")
    cell = F.expr(f"_rank * {1 << bits} div {max(total, 1)}").alias("cell")
    firsts = ranked.groupBy(cell).agg(F.min("value").alias("value")).orderBy("cell").collect()
    return [r["value"] for r in firsts[1:]]


def cuts_passed(value: Column, cuts: Sequence[str]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(v) for v in cuts]).cast("array<string>"), lambda cut: cut <= value))


def number_cells(rows: DataFrame, names: Sequence[str], bits: int) -> dict[str, Column]:
    """Cells of equal width between the least and greatest value of each column."""
    if not names:
        return {}
    scale = rows.agg(*[f(c).alias(f"{k}{c}") for c in names for k, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for c in names:
        low, high = scale[f"lo{c}"] or 0.0, scale[f"hi{c}"] or 0.0
        out[c] = F.floor((F.col(c) - F.lit(low)) / F.lit((high - low) or 1.0) * ((1 << bits) - 1)).cast("int")
    return out


def hilbert_shards(docs: DataFrame, dims: Sequence[str], shards: int = 40, bits: int = 6,
                   ties: Sequence[str] = ()) -> DataFrame:
    """Add ``curve`` (Hilbert index), ``shard`` and ``slot`` to every row, shards equal to one row.

    Each dimension becomes a cell of ``bits`` bits: numbers are scaled between their least and greatest
    value, strings go by the place among their column's distinct strings; null is 0 or empty. Rows are sorted by curve index, ``ties``, then a hash of all
    columns, and the order is cut into runs, so that files hold narrow ranges of every dimension.
    Columns of ``docs`` with the names of the result give way to it; equal rows get neighbouring
    slots. An empty table gives no rows; fewer rows than shards leave shards empty.
    """
    kinds = dict(docs.dtypes)
    kept = [c for c in docs.columns if c not in ("curve", "shard", "slot")]
    rows = settled(docs.select(
        F.struct(*kept).alias("_row"), F.xxhash64(*kept).alias("_mix"),
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(ties)],
        *[(F.coalesce(F.col(c), F.lit("")) if kinds[c] == "string" else F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"_d{i}")
          for i, c in enumerate(dims)]), "shard-rows")
    total = rows.count()
    scaled = number_cells(rows, [f"_d{i}" for i, c in enumerate(dims) if kinds[c] != "string"], bits)
    cells = []
    for i, c in enumerate(dims):
        if kinds[c] == "string":
            cuts = string_cells(rows.select(F.col(f"_d{i}").alias("value")), bits)
            passed = cuts_passed(F.col(f"_d{i}"), cuts)
            # few strings lie as far apart as many
            cells.append(F.floor(passed * (1 << bits) / (len(cuts) + 1)).cast("int").alias(f"_d{i}"))
        else:
            cells.append(scaled[f"_d{i}"].alias(f"_d{i}"))

    @F.pandas_udf("long")
    def curve(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    order = ["curve", *[f"_t{i}" for i in range(len(ties))], "_mix"]
    n = bucket_count(total)
    ranged = (rows.withColumn("curve", curve(F.struct(*cells)))
              .repartitionByRange(n, *order).withColumn("_bucket", F.spark_partition_id())
              .withColumn("_one", F.lit(1).cast("long")))
    ranked = running_total(settled(ranged, "shard-order"), "_bucket", order, "_one", "_rank")
    # integers only: a quotient of doubles may fall on the wrong side of a whole number
    shard = F.expr(f"_rank * {shards} div {max(total, 1)}").cast("int")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", shard).withColumn("slot", F.col("_rank") - first)
            .select("_row.*", "curve", "shard", "slot"))
