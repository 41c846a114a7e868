"""Token ids of a byte-level rank file, and the bytes they stand for."""
from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices

# Characters after which a long text is cut at the next safe place.
PIECE = 1 << 16
_ENCODINGS: dict = {}
_SAFE: list = []


def encoding(path: str, pattern: str):
    """The worker's own encoding of a local rank file, without special tokens."""
    if (path, pattern) not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def safe_cuts():
    """Where two matches of the pattern always meet, whatever stands around.

    Before a single space between two characters that are no white space: the space opens the match
    of what follows. Behind a single tab or line end between two such characters: the white space is
    a match of its own. Behind longer white space the pattern looks ahead, so no cut is made there.
    """
    if not _SAFE:
        import regex

        _SAFE.append(regex.compile(r"(?<=\P{White_Space})(?= \P{White_Space})|(?<=\P{White_Space}[\t\n\r])(?=\P{White_Space})"))
    return _SAFE[0]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text in parts whose ids in a row are the text's ids; a text without safe places stays whole."""
    at = 0
    while len(text) - at > size:
        cut = safe_cuts().search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids``: the ids of ``text`` as little-endian unsigned 32-bit integers, in place of ``text``.

    Each match of ``pattern`` is merged on its own by the ranks of the file at ``path``; strings that
    look like special tokens are ordinary text. Null and empty texts have no ids. Very long texts are
    coded piece by piece at places where matches always meet, so the ids are those of the whole
    text. Rows come out as they come in, repeated ones and ties too; an empty table stays empty; a
    column called ``ids`` gives way. No shuffle: a lost task repeats its own split.
    """
    others = [c for c in docs.columns if c not in (text, "ids")]
    rows = docs.select(*others, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoding(path, pattern)
        for batch in slices(batches, text):
            ids = [b"".join(code.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes() for p in pieces(t or ""))
                   for t in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.binary())], [*others, "ids"])

    return rows.mapInArrow(run, rows.drop(text).withColumn("ids", F.lit(b"")).schema)


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``decoded``: the bytes that ``ids`` stand for, which need not be valid UTF-8.

    Null ids decode to no bytes; an id that the rank file lacks is an error. Other columns, repeated
    rows and empty tables pass; a column called ``decoded`` gives way.
    """
    others = [c for c in coded.columns if c not in ("ids", "decoded")]
    rows = coded.select(*others, "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoding(path, pattern)
        for batch in slices(batches, "ids"):
            texts = [code.decode_bytes(np.frombuffer(i or b"", "<u4").tolist()) for i in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*others, "ids", "decoded"])

    return rows.mapInArrow(run, rows.withColumn("decoded", F.lit(b"")).schema)
