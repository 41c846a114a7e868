"""Exact duplicates by deterministic block naming."""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.skew import attach_groups
from plumbline.sources.shared import settled

BLOCK_BYTES = 4096
BATCH_BYTES = 8 << 20
BLOCKS = "row_id bigint, doc_id bigint, text_sha256 string, n_blocks int, place int, key binary"


def blocks_of(docs: DataFrame) -> DataFrame:
    """Fixed-size blocks of every row's text, A-Z lower-cased; an empty text is one empty block.

    ``row_id`` numbers the rows of a task. ``text_sha256`` stands on place 0 only.
    """
    names = [f.split()[0] for f in BLOCKS.split(", ")]

    def batch_of(columns: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, size = TaskContext.get().partitionId() << 33, 0
        out: list[list] = [[] for _ in names]
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                # lower() of bytes changes A-Z only
                data = (text.as_buffer().to_pybytes() if text.is_valid else b"").lower()
                digest = hashlib.sha256(data).hexdigest()
                count = max(1, -(-len(data) // BLOCK_BYTES))
                for i in range(count):
                    block = data[i * BLOCK_BYTES:(i + 1) * BLOCK_BYTES]
                    for column, value in zip(out, (row, doc, digest if i == 0 else None, count, i, block)):
                        column.append(value)
                    size += len(block)
                    if size > BATCH_BYTES:
                        yield batch_of(out)
                        out, size = [[] for _ in names], 0
                row += 1
        yield batch_of(out)

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def named_by_sort(rows: DataFrame, ties: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``name`` instead of the binary ``key``: its place among the distinct keys.

    One range sort, by two hashes of the key, the key itself and ``ties``. Ranges are cut by hashes
    and ties alone: what Spark samples on the driver for that stays small however long the keys are,
    and a key that a third of the rows share is spread over tasks like any other. A task counts the distinct keys it meets and shows its first and last key;
    running sums over the tasks make the counts global, and a key that goes on in the next task
    keeps its number. Different keys never get one name, since the keys themselves are compared; equal
    keys get the same one unless another key has both their hashes, 128 bits, at the end of a task.
    """
    kept = [c for c in rows.columns if c != "key"]
    kept_schema = rows.select(*kept).schema
    hashed = rows.withColumns({"_h0": F.xxhash64("key"), "_h1": F.xxhash64(F.lit(1), "key")})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, count, seen = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column("key")
            fresh = np.ones(n, bool)
            fresh[0] = keys[0].as_py() != last
            if n > 1:
                fresh[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            local = count + np.cumsum(fresh)
            count, last = int(local[-1]), keys[n - 1].as_py()
            edge = pa.array([keys[0].as_py()] + [None] * (n - 2) + [last] if n > 1 else [last], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(np.full(n, task)), pa.array(seen + np.arange(n)),
                 pa.array(local), edge], [*kept, "_task", "_seen", "_local", "_edge"])
            seen += n

    schema = kept_schema.add("_task", "long").add("_seen", "long").add("_local", "long").add("_edge", "binary")
    counted = settled(hashed.repartitionByRange("_h0", "_h1", *ties).sortWithinPartitions("_h0", "_h1", "key", *ties)
                      .mapInArrow(run, schema), purpose)
    tasks = counted.filter("_edge is not null").groupBy("_task").agg(
        F.min_by("_edge", "_seen").alias("first"), F.max_by("_edge", "_seen").alias("last"), F.max("_local").alias("n"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("first") == F.lag("last").over(Window.orderBy("_task")), F.lit(False)).cast("long")
    shifts = (tasks.withColumn("_goes_on", goes_on)
              .select("_task", (F.coalesce(F.sum(F.col("n") - F.col("_goes_on")).over(earlier), F.lit(0))
                                - F.col("_goes_on")).alias("_shift")))
    # one row a task: as many as the session's shuffle partitions
    return counted.join(F.broadcast(shifts), "_task").select(*kept, (F.col("_shift") + F.col("_local")).alias("name"))


def pair_key(first: Column, second: Column) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(first), 16, "0"), F.lpad(F.hex(second), 16, "0")))


def identities(docs: DataFrame) -> DataFrame:
    """``row_id``, ``doc_id``, ``text_sha256``, ``n_blocks`` and ``name``, for each row of ``docs``.

    Two rows have the same (n_blocks, name) exactly when their normalised texts are equal. Blocks are
    named by sorting; then adjacent names of a text are paired and the pairs named, until one name is
    left. A text of up to 4,096 bytes is done at once; each further round halves what is left.
    """
    names = named_by_sort(blocks_of(docs), ["row_id", "place"], "names-0")
    longest = names.agg(F.max("n_blocks").alias("m")).first()["m"] or 1
    facts = ["row_id", "doc_id", "text_sha256", "n_blocks"]
    done, width, level = [names.filter("n_blocks = 1").select(*facts, "name")], 1, 0
    names = names.filter("n_blocks > 1")
    while width < longest:
        width, level = 2 * width, level + 1
        even = F.col("place") % 2 == 0
        pairs = (names.groupBy("row_id", "n_blocks", F.expr("cast(place div 2 as int)").alias("place"))
                 .agg(F.max("doc_id").alias("doc_id"), F.max("text_sha256").alias("text_sha256"),
                      F.max(F.when(even, F.col("name"))).alias("_a"), F.max(F.when(~even, F.col("name"))).alias("_b"))
                 .select(*facts, "place", pair_key(F.col("_a"), F.coalesce("_b", F.lit(0))).alias("key")))
        names = named_by_sort(pairs, ["row_id", "place"], f"names-{level}")
        done.append(names.filter(F.col("n_blocks") <= width).select(*facts, "name"))
        names = names.filter(F.col("n_blocks") > width)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest
    doc_id stays; of repeated rows one. Null texts count as empty, and all empty texts are equal.
    A null doc_id is smaller than any other. An empty table gives no rows; further columns are not read.
    """
    rows = settled(identities(docs), "identities")
    groups = settled(rows.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row_id")).alias("_keep"), F.count(F.lit(1)).alias("group_size")), "identity-groups")
    placed = attach_groups(rows, groups, ["n_blocks", "name"], "group_size")
    return placed.select("doc_id", F.col("_keep.doc_id").alias("keep_id"), "group_size",
                         (F.col("row_id") == F.col("_keep.row_id")).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    kept = exact_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # a row travels as one struct, so that no column of its own can clash
    rows = docs.select(F.col("doc_id").alias("_doc"), F.sha2(lower, 256).alias("_text"), F.struct(*docs.columns).alias("_row"))
    match = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_sha"))
    # rows repeated with their doc_id meet again here; one of them goes on
    again = Window.partitionBy("_id", "_sha").orderBy("_sha")
    return rows.join(kept, match).withColumn("_again", F.row_number().over(again)).filter("_again = 1").select("_row.*")
