"""Helpers the text operators share: exact running totals, word counts and row numbers."""
from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space. bytes.split() cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows a bucket of a distributed running total holds on average; only the number of tasks depends on it.
BUCKET_ROWS = 4096


def whole_texts(texts: pa.Array) -> pa.Array:
    """Large strings without nulls that start at the beginning of their buffer.

    Arrow's ``ascii_lower`` returns other rows' bytes for a slice of an array, so a slice is copied.
    """
    if texts.offset:
        texts = texts.take(pa.array(np.arange(len(texts))))
    return texts.cast(pa.large_string()).fill_null("")


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most`` bytes, or one row that holds more.

    What a worker builds from a batch is many times the batch, so its memory is bounded by this.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // most
        edges = np.flatnonzero(np.diff(part, prepend=-1)) if batch.num_rows else np.zeros(0, int)
        for lo, hi in zip(edges, [*edges[1:], batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket_count(rows: int) -> int:
    return 1 + rows // BUCKET_ROWS


def hash_bucket(buckets: int, *cols: str) -> Column:
    """Equal ranges of a 62-bit hash, so that the order of buckets is the order of the hash."""
    width = (1 << 62) // buckets + 1
    return F.floor(hash62(*cols) / F.lit(width)).cast("long")


def hash62(*cols: str) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 62) - 1))


def running_total(rows: DataFrame, bucket: str, order: Sequence[str], value: str, out: str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the same ``by``.

    Rows are ordered by ``bucket``, then ``order``; buckets must follow the order and hold a bounded
    number of rows each. Only one total a bucket meets in one task. ``rows`` is read twice and must
    be settled; bucket and by must not be null.
    """
    keys = [*by, bucket]
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("_total"))
    offsets = totals.select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return (rows.join(offsets, keys)
            .withColumn(out, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_offset"))
