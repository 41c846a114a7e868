"""Near-duplicates by bottom-k sketches and inverted lists."""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices, whole_texts
from plumbline.llm.components import components
from plumbline.operators.skew import attach_groups
from plumbline.sources.shared import settled

SHINGLE = 5
# Retained values of a document, and the fewest that two documents of similarity 0.75 share: 4.9
# standard deviations below the mean of Binomial(48, 0.75), so a link is missed with chance 2e-7.
KEPT, LEAST_SHARED = 48, 18
# The same for the union sketches that filter pairs inside a block.
FINE_KEPT, FINE_LEAST = 192, 115
# Documents and shingles that meet in one task.
BLOCK_DOCS, BLOCK_VALUES = 1024, 2_000_000


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted 63-bit hashes of each text's distinct five-word shingles.

    A-Z are lower-cased; a text of fewer words is one shingle, which no longer text's equals; a null
    text or one without words has none. Each distinct word of the batch is hashed once.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(whole_texts(texts)))
    offsets = np.asarray(words.offsets, np.int64) - words.offsets[0].as_py()
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    codes = coded.indices.to_numpy()
    real = np.fromiter((w != "" for w in names), bool, len(names))[codes]  # white space at an end leaves empty strings
    flat = hashes[codes][real]
    ends = np.concatenate(([0], np.cumsum(real)))[offsets]
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
    spread = np.zeros(max(len(flat) - SHINGLE + 1, 0), np.uint64)
    for i in range(SHINGLE):
        spread += flat[i:len(spread) + i] * odd[i]
    spread = finish(spread)
    out = []
    for lo, hi in zip(ends[:-1], ends[1:]):
        n = hi - lo
        if n >= SHINGLE:
            out.append(np.unique(spread[lo:hi - SHINGLE + 1]))
        elif n:
            out.append(finish(np.array([(flat[lo:hi] * odd[:n]).sum() + np.uint64(n)], np.uint64)))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def finish(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit sums and drop the sign bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return ((x ^ (x >> np.uint64(33))) >> np.uint64(1)).astype(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """``row_id``, ``doc_id``, ``body`` (a hash of the text), ``n_shingles``, ``digest`` of the set (null if empty) and its ``sketch``, the smallest hashes."""
    names = ["row_id", "doc_id", "body", "n_shingles", "digest", "sketch"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(len(sets))), batch.column("doc_id"), batch.column("body"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest(s) for s in sets], pa.binary()),
                pa.array([s[:KEPT] for s in sets], pa.list_(pa.int64()))], names)
            row += len(sets)

    return docs.select("doc_id", "text", body_hash()).mapInArrow(
        run, "row_id bigint, doc_id bigint, body bigint, n_shingles bigint, digest binary, sketch array<bigint>")


def body_hash() -> Column:
    return F.xxhash64("text").alias("body")


def digest(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def least_shared(n: Column) -> Column:
    """Retained values that a document of ``n`` shingles shares with any document it links to."""
    return F.when(n <= math.floor(0.75 * KEPT), F.ceil(0.75 * n)).otherwise(LEAST_SHARED)


def inverted_lists(reps: DataFrame) -> DataFrame:
    """``value`` and ``rep``: each retained value's documents, as far as links can need them.

    Two linked documents share at least ``c`` of ``k`` retained values, so they share one of the
    ``k - c + 1`` that are rarest in the corpus; only those are listed. Values that a passage brings
    into very many documents come last in that order and are listed for documents made of them only.
    Values of one document link nothing, but count as its rarest.
    """
    postings = reps.select("rep", "n_shingles", F.explode("sketch").alias("value"))
    # written before it is joined, so that Spark can split the tasks of a value that very many documents retain
    shared = settled(postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df >= 2"), "shared-values")
    listed = (postings.join(shared, "value").groupBy("rep", "n_shingles")
              .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared")))
    rarest = F.greatest(F.size("shared") - (least_shared(F.col("n_shingles")) - 1), F.lit(0)).cast("int")
    return listed.select("rep", F.explode(F.slice("shared", F.lit(1), rarest)).alias("v")).select("v.value", "rep")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


class Links:
    """Documents of a block with their sets; joins those that are linked."""

    def __init__(self, reps: list[int], sets: list[np.ndarray], labels: list[int] | None = None):
        self.reps, self.sets = reps, sets
        self.size = np.array([len(s) for s in sets])
        first: dict[int, int] = {}
        self.parent = [first.setdefault(x, i) for i, x in enumerate(labels)] if labels else list(range(len(reps)))
        self.found: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def test(self, i: int, j: int) -> None:
        """Exact similarity of two documents that are not joined yet."""
        a, b = self.root(i), self.root(j)
        if a == b or 4 * min(self.size[i], self.size[j]) < 3 * max(self.size[i], self.size[j]):
            return
        both = overlap(self.sets[i], self.sets[j])
        if 100 * both >= 75 * (self.size[i] + self.size[j] - both):
            self.parent[max(a, b)] = min(a, b)
            self.found.append((self.reps[i], self.reps[j]))

    def test_all(self, side: np.ndarray | None = None) -> None:
        """All pairs that are not joined, of different ``side`` if given; sketches of the union filter first."""
        roots = np.array([self.root(i) for i in range(len(self.reps))])
        if len(np.unique(roots)) < 2:
            return
        n = len(self.reps)
        fine = [s[:FINE_KEPT] for s in self.sets]
        _, inverse, counts = np.unique(np.concatenate(fine), return_inverse=True, return_counts=True)
        rows = np.repeat(np.arange(n), [len(s) for s in fine])
        often = counts[inverse] > 1
        columns, rows = np.unique(inverse[often], return_inverse=True)[1], rows[often]
        shared = np.zeros((n, n), np.float32)
        width = columns.max() + 1 if len(columns) else 0
        for lo in range(0, width, 8192):  # a strip of values at a time
            mine = (columns >= lo) & (columns < lo + 8192)
            strip = np.zeros((n, min(8192, width - lo)), np.float32)
            strip[rows[mine], columns[mine] - lo] = 1
            shared += strip @ strip.T
        smaller = np.minimum(self.size[:, None], self.size[None, :])
        least = np.minimum(FINE_LEAST, np.ceil(0.75 * smaller))
        pairs = np.triu(shared >= least, 1) & (roots[:, None] != roots[None, :])
        if side is not None:
            pairs &= side[:, None] != side[None, :]
        i, j = np.nonzero(pairs)
        for k in np.argsort(-shared[i, j], kind="stable"):
            self.test(int(i[k]), int(j[k]))


def link_table(links: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def sets_in(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.int64) for v in table.column("values").combine_chunks()] if table.num_rows else []


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each row of ``docs`` (``doc_id``, ``text``).

    Documents are linked when 100 * intersection >= 75 * union of their shingle sets. Equal sets
    collapse first; their bottom-k sketches are laid out in inverted lists. The smallest document of
    a list is its pivot, and what shares a pivot meets in blocks of bounded size, where the pivot is
    compared with all, then all that are still apart with each other: union sketches filter and full
    sets decide. Pivots with several blocks get a second pass over the pairs of blocks, of documents
    that no link has joined to the pivot yet against all others. Only links that join something
    leave a task. ``component_id`` is the smallest doc_id reachable; documents without words are
    components of their own, as are rows with a null doc_id and no link. Repeated rows are equal
    sets. An empty table gives no rows; further columns are not read.
    """
    rows = settled(sketches(docs), "sketches")
    groups = settled(rows.filter("digest is not null").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id", "body")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("digest", "copies", F.col("first.row_id").alias("rep"), F.col("first.doc_id").alias("rep_doc"), F.col("first.body").alias("rep_body")), "sets")
    reps = rows.join(groups.select("rep"), rows.row_id == F.col("rep")).select("rep", "n_shingles", "sketch")
    labels = components(links_between(docs, reps, groups))
    smallest = (groups.join(labels, groups.rep == labels.node, "left")
                .withColumn("label", F.coalesce("label", "rep")))
    roots = smallest.groupBy("label").agg(F.min("rep_doc").alias("component_id"))
    facts = settled(smallest.join(roots, "label").select("digest", "copies", "component_id"), "set-components")
    placed = attach_groups(rows.select("doc_id", "n_shingles", "digest"), facts, ["digest"], "copies")
    return placed.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def links_between(docs: DataFrame, reps: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) that join all linked documents of ``reps``."""
    lists = settled(inverted_lists(reps), "lists")
    pivots = settled(lists.groupBy("value").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "pivots")
    members = settled(lists.join(pivots.select("value", "pivot"), "value").filter("rep <> pivot")
                      .select("pivot", "rep").distinct(), "pivot-members")
    needed = (members.select("rep").union(members.select(F.col("pivot").alias("rep"))).distinct()
              .join(groups.select("rep", "rep_doc", "rep_body", F.col("digest").alias("_digest")), "rep"))
    sets = settled(full_sets(docs, needed), "shingle-sets")
    n = F.col("n_values")
    sized = members.join(sets.select("rep", n), "rep")
    blocks = settled(sized.groupBy("pivot").agg(F.count(F.lit(1)).alias("_docs"), F.sum(n).alias("_values")).select(
        "pivot", F.ceil(F.greatest(F.col("_docs") / BLOCK_DOCS, F.col("_values") / BLOCK_VALUES)).alias("blocks")), "pivot-blocks")
    deal = lambda of: F.pmod(F.xxhash64(F.lit(3), "rep"), of)
    dealt = settled(members.join(blocks, "pivot").withColumn("block", deal(F.col("blocks"))), "dealt")
    with_pivot = dealt.select("pivot", "block", "rep").union(
        blocks.select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "pivot"))

    def inside(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        reps = table.column("rep").to_pylist()
        block = Links(reps, sets_in(table))
        pivot = reps.index(table.column("pivot")[0].as_py())
        for i in range(len(reps)):
            if i != pivot:
                block.test(pivot, i)
        block.test_all()
        return link_table(block.found)

    first = settled(with_pivot.join(sets, "rep").select("pivot", "block", "rep", "values")
                    .groupBy("pivot", "block").applyInArrow(inside, "a bigint, b bigint"), "links-inside")
    if not blocks.filter("blocks > 1").limit(1).count():
        return first
    labels = components(first)
    wide = (dealt.filter("blocks > 1").join(labels, dealt.rep == labels.node, "left")
            .select("pivot", "blocks", "block", "rep", F.coalesce("label", "rep").alias("label")))
    main = labels.select(F.col("node").alias("pivot"), F.col("label").alias("_main"))
    wide = settled(wide.join(main, "pivot", "left").withColumn(
        "_apart", F.col("label") != F.coalesce("_main", "pivot")), "across")
    apart = wide.filter("_apart")
    rest = apart.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).alias("rests"))
    left = apart.join(rest, "pivot").select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        deal(F.col("rests")).alias("part"), "rep", "label", F.lit(0).alias("side"))
    right = wide.join(rest, "pivot").select(
        "pivot", "block", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("part"), "rep", "label", F.lit(1).alias("side"))

    def across(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        block = Links(table.column("rep").to_pylist(), sets_in(table), table.column("label").to_pylist())
        block.test_all(np.array(table.column("side")))
        return link_table(block.found)

    second = settled(left.union(right).join(sets, "rep").select("pivot", "block", "part", "rep", "label", "side", "values")
                     .groupBy("pivot", "block", "part").applyInArrow(across, "a bigint, b bigint"), "links-across")
    return first.union(second)


def full_sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``rep``, ``values`` (the whole set, 64-bit little-endian) and ``n_values`` of the documents in ``needed``."""
    # by doc_id and text, so that rows without a doc_id spread by their texts and meet their own set only
    named = needed.select("rep", F.coalesce("rep_doc", F.lit(0)).alias("_doc"), F.col("rep_doc").isNull().alias("_unnamed"), "rep_body", "_digest")
    rows = docs.select("text", body_hash(), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_null"))
    wanted = rows.join(named, (F.col("body") == F.col("rep_body")) & (F.col("_id") == F.col("_doc")) & (
        F.col("_null") == F.col("_unnamed"))).select("rep", "_digest", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            # rows with the doc_id of another text are told apart by the digest
            mine = [i for i, (s, d) in enumerate(zip(sets, batch.column("_digest").to_pylist())) if digest(s) == d]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array(mine, pa.int64())), pa.array([sets[i].tobytes() for i in mine], pa.binary()),
                 pa.array([len(sets[i]) for i in mine], pa.int64())], ["rep", "values", "n_values"])

    return wanted.mapInArrow(run, "rep bigint, values binary, n_values bigint")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest doc_id of each component, all columns as they were; rows of one doc_id stay or go together."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    # a row travels as one struct, so that no column of its own can clash
    rows = docs.select(F.col("doc_id").alias("_doc"), F.struct(*docs.columns).alias("_row"))
    return rows.join(kept, F.col("_doc").eqNullSafe(F.col("_id")), "left_semi").select("_row.*")
