"""Packing token sequences by vector bin packing."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices
from plumbline.llm.tokens import chunker_for
from plumbline.sources.shared import settled

# Examples that meet in one task; a block leaves at most one sequence that is not full for want of examples.
BLOCK = 4096
PIECES = "array<struct<start:bigint,length:bigint,sequence:bigint,offset:bigint>>"


def pack_block(tokens: np.ndarray, loss: np.ndarray, capacity: tuple[int, int, int], cut: bool) -> list[tuple]:
    """(example, start, length, bin, offset) of a block's examples under limits on tokens, examples and loss tokens.

    Bins are filled one at a time. Of the examples that fit, the one whose demand has the largest dot
    product with what the bin has left comes next, each dimension scaled by its capacity and weighed
    by the block's average demand. With ``cut`` (loss must equal tokens) an example that doesn't fit
    fills up the bin and its rest stays in the pool. An example over a limit gets a bin of its own.
    """
    cap = np.array(capacity, float)
    weight = (np.array([tokens.mean(), 1.0, loss.mean()]) / cap) if len(tokens) else np.ones(3)
    start, left_tokens = np.zeros(len(tokens), np.int64), tokens.astype(np.int64)
    # examples of equal demand wait in one queue, so that only distinct demands are scored
    kinds, kind_of = np.unique(np.stack([tokens, loss], 1), axis=0, return_inverse=True)
    queues: list[list[int]] = [[] for _ in kinds]
    for i in range(len(tokens) - 1, -1, -1):
        queues[kind_of.ravel()[i]].append(i)
    need, bear = kinds[:, 0] / cap[0], kinds[:, 1] / cap[2]  # an empty queue needs infinitely many tokens
    out, number = [], 0
    n_alive = len(tokens)

    def take(kind: int) -> int:
        example = queues[kind].pop()
        if not queues[kind]:
            need[kind] = np.inf
        return example

    while n_alive:
        left, offset = np.ones(3), 0
        while n_alive:
            kind = -1
            if left[1] * cap[1] > 0.5:
                fits = np.flatnonzero((need <= left[0] + 1e-9) & (bear <= left[2] + 1e-9))
                if len(fits):  # the share that one example takes of a bin's examples is the same for all
                    kind = int(fits[(need[fits] * (weight[0] * left[0]) + bear[fits] * (weight[2] * left[2])).argmax()])
            if kind < 0:
                room = min(capacity[0] - offset, int(round(left[2] * cap[2])))
                if cut and room >= 1 and left[1] * cap[1] > 0.5:
                    kind = int(np.where(np.isfinite(need), need, -1.0).argmax())
                    pick = take(kind)
                    out.append((pick, int(start[pick]), room, number, offset))
                    start[pick] += room
                    left_tokens[pick] -= room
                    if queues[kind]:  # its queue goes on; the rest waits in a new one
                        kind = len(queues)
                        queues.append([])
                        need, bear = np.append(need, 0.0), np.append(bear, 0.0)
                    queues[kind].append(pick)
                    need[kind], bear[kind] = left_tokens[pick] / cap[0], left_tokens[pick] / cap[2]
                    break
                if offset:
                    break
                kind = int(np.isfinite(need).argmax())  # over a limit by itself
            share = np.array([need[kind], 1 / cap[1], bear[kind]])
            pick = take(kind)
            out.append((pick, int(start[pick]), int(left_tokens[pick]), number, offset))
            offset += int(left_tokens[pick])
            left = left - share
            n_alive -= 1
        number += 1
    return out


def place(examples: DataFrame, max_tokens: int, max_segments: int, max_loss: int, cut: bool) -> DataFrame:
    """``pieces`` of each example (``row_id``, ``tokens``, ``loss``): where its tokens go.

    Examples meet in blocks dealt by a hash of ``row_id``, about 4,096 each at any size, and a block's
    sequences get numbers of its own. With ``cut``, whole stretches of ``max_tokens`` come off first.
    """
    blocks = 1 + examples.count() // BLOCK
    capacity = (max_tokens, max_segments, max_loss)

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row_id", kind="stable")
        tokens, loss = part.tokens.to_numpy(np.int64), part.loss.to_numpy(np.int64)
        whole = tokens // max_tokens if cut else np.zeros_like(tokens)
        rest = tokens - whole * max_tokens
        packed = np.flatnonzero(rest > 0)
        pieces: list[list] = [[(k * max_tokens, max_tokens, -1, 0) for k in range(w)] for w in whole]
        number = 0
        for i, start, length, b, offset in pack_block(rest[packed], rest[packed] if cut else loss[packed], capacity, cut):
            i = packed[i]
            pieces[i].append((int(whole[i]) * max_tokens + start, length, b, offset))
            number = max(number, b + 1)
        base = int(key[0]) << 32
        rows = []
        for mine in pieces:
            got = []
            for start, length, b, offset in mine:
                if b < 0:
                    b, number = number, number + 1
                got.append({"start": start, "length": length, "sequence": base + b, "offset": offset})
            rows.append(got)
        return pd.DataFrame({"row_id": part.row_id.to_numpy(), "pieces": rows})

    dealt = examples.withColumn("_block", F.pmod(F.xxhash64("row_id"), F.lit(blocks)))
    return dealt.groupBy("_block").applyInPandas(run, f"row_id bigint, pieces {PIECES}")


def tokenise(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``row_id``, ``doc_id``, ``n`` and ``ids`` (little-endian, two bytes an id if the vocabulary allows, else four)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = chunker_for(path)
        kind = np.dtype("<u2" if chunker.tk.get_vocab_size() <= 1 << 16 else "<u4")
        for batch in slices(batches, "text"):
            ids, offsets = chunker.encode(batch.column("text"), end_id)
            places = (offsets * kind.itemsize).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(places), pa.py_buffer(ids.astype(kind))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(np.diff(offsets)), packed], ["row_id", "doc_id", "n", "ids"])

    return (docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
            .mapInArrow(run, "row_id bigint, doc_id bigint, n bigint, ids binary"))


def pack(docs: DataFrame, path: str, max_tokens: int = 2048, max_segments: int = 128, end_id: int = 1) -> DataFrame:
    """Pack the token ids of every document into sequences of at most ``max_tokens``.

    Returns a row for each piece: ``doc_id``, ``start`` (its document's ids before it), ``length``,
    ``ids`` (binary, unsigned 32-bit little-endian), ``doc_tokens``, ``sequence_id`` and ``offset``,
    gapless from 0 in a sequence. Every document ends with ``end_id``, so null and empty texts have
    one id; in plain text every token bears loss. Repeated rows are packed as often as they come, an
    empty table gives no rows, and further columns are not read. Ids are written once to the shared
    folder; only lengths are dealt for packing.
    """
    encoded = settled(tokenise(docs, path, end_id), "pack-ids")
    lengths = encoded.select("row_id", F.col("n").alias("tokens"), F.col("n").alias("loss"))
    placed = place(lengths, max_tokens, max_segments, max_tokens, cut=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for doc, n, ids, pieces in zip(*(batch.column(c) for c in ("doc_id", "n", "ids", "pieces"))):
                n = n.as_py()
                buffer = ids.as_buffer()
                values = np.frombuffer(buffer, "<u2" if buffer.size == 2 * n else "<u4")
                for p in pieces.as_py():
                    part = values[p["start"]:p["start"] + p["length"]].astype("<u4").tobytes()
                    for column, v in zip(rows, (doc.as_py(), p["start"], p["length"], part, n, p["sequence"], p["offset"])):
                        column.append(v)
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names)

    return encoded.join(placed, "row_id").select("doc_id", "n", "ids", "pieces").mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
