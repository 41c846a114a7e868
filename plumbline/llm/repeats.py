"""Repeated passages by a sparse enhanced suffix array and its common-prefix intervals."""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.skew import attach_groups
from plumbline.sources.shared import settled

GRAM = 16
# Contexts that are sorted in one task; a core with more of them is settled by counting its strings.
GROUP = 20_000


def anchors_of(data: bytes, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions that own the starts of all ``length``-byte strings of ``data``, and the first and last start of each.

    A start's owner is the position among the next ``window`` whose 16 bytes hash lowest, the
    leftmost of equals. It depends on the string alone, so equal strings have their owner at the same
    place, and only about two positions in ``window`` own anything.
    """
    starts = len(data) - length + 1
    if starts <= 0:
        return (np.zeros(0, np.int64),) * 3
    raw = np.frombuffer(data, np.uint8)
    words = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(data) - 7,), (1,))
    m = starts + window - 1
    key = words[:m] * np.uint64(0x9E3779B97F4A7C15)
    key ^= words[8:m + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key &= np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(m, dtype=np.uint64)
    # least of every window: what is least from a start to its block's end, and from the next block's start on
    padded = np.full(-(-m // window) * window, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = key
    blocks = padded.reshape(-1, window)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    owner = (np.minimum(backward[:starts], forward[window - 1:window - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    last = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True])
    first = np.r_[0, last[:-1] + 1]
    return owner[last], first, last


def anchor_rows(docs: DataFrame, length: int, window: int) -> DataFrame:
    """A row for each document: ``row_id``, ``doc_id``, ``digest`` and its ``anchors``.

    An anchor: ``at``, the first and last start it owns as ``back`` and ``fwd`` bytes before it, a hash of the
    ``core`` bytes that all strings it owns or an equal one elsewhere owns have, and of the ``hull`` of its own.
    """
    core_size = length - window + 1
    fields = [("at", pa.int64()), ("back", pa.int16()), ("fwd", pa.int16()), ("core", pa.int64()), ("hull", pa.int64())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            columns: list[list] = [[] for _ in fields]
            digests, counts = [], [0]
            for text in batch.column("text"):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                digests.append(xxhash.xxh3_128_digest(data))
                at, first, last = anchors_of(data, length, window)
                cores = [xxhash.xxh3_64_intdigest(data[a:a + core_size]) for a in at.tolist()]
                hulls = [xxhash.xxh3_64_intdigest(data[a:b + length], 1) for a, b in zip(first.tolist(), last.tolist())]
                for column, values in zip(columns, (at, at - first, at - last, np.array(cores, np.uint64).view(np.int64),
                                                    np.array(hulls, np.uint64).view(np.int64))):
                    column.append(values)
                counts.append(counts[-1] + len(at))
            flat = [pa.array(np.concatenate(c) if c else np.zeros(0), k) for c, (_, k) in zip(columns, fields)]
            anchors = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(flat, [n for n, _ in fields]))
            yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(len(batch))), batch.column("doc_id"),
                                              pa.array(digests, pa.binary()), anchors], ["row_id", "doc_id", "digest", "anchors"])
            row += len(batch)

    return docs.select("doc_id", "text").mapInArrow(
        run, "row_id bigint, doc_id bigint, digest binary, "
             "anchors array<struct<at:bigint,back:smallint,fwd:smallint,core:bigint,hull:bigint>>")


def common_prefixes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of bytes and the one before it; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[1:] = np.minimum(out[1:], np.minimum(sizes[1:], sizes[:-1]))
    return out


def byte_rows(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    return rows, np.array([len(s) for s in strings], np.int64)


def intervals(prefixes: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """All common-prefix intervals (first, last, length) of a sorted list, by one scan with a stack."""
    out, stack = [], []  # open intervals: (length, first)
    for i, shared in enumerate([*prefixes[1:].tolist(), 0], start=1):
        first = i - 1
        while stack and stack[-1][0] > shared:
            size, first = stack.pop()
            if size >= least:
                out.append((first, i - 1, size))
        if shared and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))
    return out


def repeated_starts(lefts: list[bytes], rights: list[bytes], open_: np.ndarray, back: np.ndarray, fwd: np.ndarray,
                    length: int) -> list[tuple[int, int, int]]:
    """(member, greatest, least) offsets before its anchor at which strings of ``length`` occur at another member too.

    Members are suffixes at anchors with what precedes them. Sorted by what follows, every
    common-prefix interval is a group of occurrences of one string. What the group's members share
    to the left tells whether it extends: sorted by their reversed left contexts, a member's longest
    left extension is the one it shares with a neighbour, and where neighbours differ the repeat is
    maximal. An interval of prefix r gives a member of left extension l the strings that begin
    ``length - r`` to l bytes before the anchor.
    """
    right, right_size = byte_rows(rights, length)
    order = np.array(sorted(range(len(rights)), key=lambda i: rights[i]))
    prefixes = common_prefixes(right[order], right_size[order])
    width = max(1, max(map(len, lefts), default=1))
    reversed_ = [s[::-1] for s in lefts]
    left, left_size = byte_rows(reversed_, width)
    rank = np.empty(len(lefts), np.int64)
    rank[sorted(range(len(lefts)), key=lambda i: reversed_[i])] = np.arange(len(lefts))
    found = []
    for first, last, shared in intervals(prefixes, length - width):
        members = order[first:last + 1]
        if not open_[members].any():
            continue
        members = members[np.argsort(rank[members], kind="stable")]
        extends = common_prefixes(left[members], left_size[members])
        extension = np.maximum(extends, np.r_[extends[1:], 0])
        most = np.minimum(extension, back[members])
        least = np.maximum(length - min(shared, length), fwd[members])
        for k in np.flatnonzero(open_[members] & (most >= least)):
            found.append((int(members[k]), int(most[k]), int(least[k])))
    return found


def packed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` and the text compressed, which halves what joins move."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            data = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([xxhash.xxh3_128_digest(d) for d in data], pa.binary()),
                 pa.array([pack(d) for d in data], pa.binary())], ["doc_id", "digest", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, digest binary, packed binary")


def of_document(facts: DataFrame, texts: DataFrame, how: str) -> DataFrame:
    """Texts with the facts of their document; equal rows share theirs."""
    named = facts.withColumnsRenamed({"doc_id": "_doc", "digest": "_digest"})
    return texts.join(named, texts.doc_id.eqNullSafe(F.col("_doc")) & (texts.digest == F.col("_digest")), how).drop("_doc", "_digest")


def repeat_starts(docs: DataFrame, length: int, window: int, group: int) -> DataFrame:
    """``doc_id``, ``digest`` and ``ranges`` (struct of first and last start) of strings that start elsewhere too."""
    rows = settled(anchor_rows(docs, length, window), "anchors")
    anchors = rows.select("row_id", F.explode("anchors").alias("a")).select("row_id", "a.*")
    # written before it is joined: only then can Spark split the tasks of a core that very many anchors share
    cores = settled(anchors.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "cores")
    repeated = settled(anchors.join(cores, "core"), "repeated-anchors")
    # anchors whose whole hull repeats are done; of the others and what they may equal, one each goes on
    hulls = settled(repeated.groupBy("core", "hull").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("row_id", "at", "back", "fwd")).alias("one")), "hulls")
    done = attach_groups(repeated, hulls.filter("copies > 1").select("core", "hull", "copies"), ["core", "hull"], "copies").filter(
        "copies is not null").select("row_id", (F.col("at") - F.col("back")).alias("lo"), (F.col("at") - F.col("fwd")).alias("hi"))
    mixed = hulls.groupBy("core").agg(F.count(F.lit(1)).alias("members"), F.min("copies").alias("least")).filter(
        "members > 1 and least = 1")
    open_ = settled(hulls.join(mixed, "core").select("core", "members", "copies", "one.*"), "open-anchors")
    per_doc = open_.groupBy("row_id").agg(F.collect_list(F.struct("core", "members", "copies", "at", "back", "fwd")).alias("open"))
    wanted = per_doc.join(rows.select("row_id", "doc_id", "digest"), "row_id")
    contexts = settled(cut_contexts(of_document(wanted, packed_texts(docs), "inner"), length, window), "contexts")

    def scan(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row_id", "ascending"), ("at", "ascending")])
        of = lambda name: np.array(table.column(name))
        found = repeated_starts(table.column("left").to_pylist(), table.column("right").to_pylist(), of("copies") == 1,
                                of("back").astype(np.int64), of("fwd").astype(np.int64), length)
        row, at = of("row_id"), of("at")
        return pa.table({"row_id": pa.array([row[i] for i, _, _ in found], pa.int64()),
                         "lo": pa.array([at[i] - most for i, most, _ in found], pa.int64()),
                         "hi": pa.array([at[i] - least for i, _, least in found], pa.int64())})

    scanned = (contexts.filter(F.col("members") <= group).groupBy("core")
               .applyInArrow(scan, "row_id bigint, lo bigint, hi bigint"))
    strings = counted_strings(contexts.filter(F.col("members") > group), length)
    ranges = done.union(scanned).union(strings)
    per_row = ranges.groupBy("row_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return (per_row.join(rows.select("row_id", "doc_id", "digest"), "row_id")
            .groupBy("doc_id", "digest").agg(F.flatten(F.collect_list("ranges")).alias("ranges")))


def counted_strings(contexts: DataFrame, length: int) -> DataFrame:
    """The same as a scan of each core, for cores with too many contexts for one task: all strings they own are counted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for core, row, at, back, fwd, left, right in zip(*(batch.column(c).to_pylist() for c in (
                    "core", "row_id", "at", "back", "fwd", "left", "right"))):
                both, middle = left + right, len(left)
                for o in range(fwd, back + 1):
                    for column, v in zip(out, (core, xxhash.xxh3_128_digest(both[middle - o:middle - o + length]), row, at - o)):
                        column.append(v)
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["core", "string", "row_id", "start"])

    strings = contexts.mapInArrow(run, "core bigint, string binary, row_id bigint, start bigint")
    often = strings.groupBy("core", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core", "string")
    return strings.join(often, ["core", "string"]).select("row_id", F.col("start").alias("lo"), F.col("start").alias("hi"))


def cut_contexts(texts: DataFrame, length: int, window: int) -> DataFrame:
    """What precedes and follows each open anchor, as far as strings it owns reach."""
    names = ["core", "members", "copies", "row_id", "at", "back", "fwd", "left", "right"]
    kinds = [pa.int64()] * 7 + [pa.binary()] * 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row, packed, open_ in zip(batch.column("row_id").to_pylist(), batch.column("packed"), batch.column("open")):
                data = unpack(packed.as_buffer().to_pybytes())
                for a in open_.as_py():
                    at = a["at"]
                    for column, v in zip(out, (a["core"], a["members"], a["copies"], row, at, a["back"], a["fwd"],
                                               data[max(0, at - window + 1):at], data[at:at + length])):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return texts.select("row_id", "packed", "open").mapInArrow(
        run, "core bigint, members bigint, copies bigint, row_id bigint, at bigint, back bigint, fwd bigint, left binary, right binary")


def remove_repeats(docs: DataFrame, length: int = 400, window: int = 200, group: int = GROUP) -> DataFrame:
    """What is left of each row's text without every byte of a ``length``-byte string that starts anywhere else too.

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and
    ``removed`` (the runs, first byte and end) for each row of ``docs`` (``doc_id``, ``text``). Texts are
    UTF-8 bytes and strings never cross documents; null counts as empty; repeated rows repeat each other; overlaps
    within one text count; an empty table gives no rows; further columns are not read.

    Only anchors that strings choose by their content enter the suffix array. Anchors whose core of
    ``length - window + 1`` bytes occurs once are dropped, those whose whole surroundings repeat are
    done by counting, and the rest, at the ends of repeats, are sorted by what follows them.
    """
    ranges = settled(repeat_starts(docs, length, window, group), "repeat-ranges")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, packed, ranges in zip(batch.column("doc_id").to_pylist(), batch.column("packed"), batch.column("ranges")):
                data = unpack(packed.as_buffer().to_pybytes())
                spans: list[list[int]] = []
                for r in sorted((r["lo"], r["hi"] + length) for r in (ranges.as_py() or ())):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append(list(r))
                kept, at = hashlib.sha256(), 0
                for first, end in spans:
                    kept.update(data[at:first])
                    at = end
                kept.update(data[at:])
                for column, v in zip(out, (doc, len(data), sum(e - f for f, e in spans), len(spans), kept.hexdigest(),
                                           [{"first": f, "end": e} for f, e in spans])):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    joined = of_document(ranges, packed_texts(docs), "left")
    return joined.select("doc_id", "packed", "ranges").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
             "removed array<struct<first:bigint,end:bigint>>")
