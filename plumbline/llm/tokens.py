"""Counting and producing token ids with public tokenizers, once per distinct piece of text."""
from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices, whole_texts

# Distinct pieces a Python worker remembers; beyond it starts afresh, so memory stays bounded.
REMEMBERED = 600_000
_TOKENIZERS: dict = {}


def tokenizer(path: str):
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker a core already
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def special_strings(tk) -> list[str]:
    return [t.content for t in tk.get_added_tokens_decoder().values()]


class PreTokens:
    """Cuts texts into pre-tokens, of which each can be encoded by itself.

    A pre-token here runs from a space that a non-space follows to the next such space. The
    tokenizer's own pattern always starts a piece at such a space, so counts add up over pre-tokens.
    Special strings are pre-tokens too; the library cuts a text at them first.
    """

    _after_space = re.compile(r" (?:\s|\Z)")
    _cut = re.compile(r" (?=\S)")

    def __init__(self, specials: list[str]):
        longest_first = sorted(specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")" if specials else r"(?!)")

    def irregular(self, text: str) -> bool:
        return self._after_space.search(text) is not None or self.special.search(text) is not None

    def cut(self, text: str) -> list[str]:
        out = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                first, *rest = self._cut.split(part)
                out += [first, *[" " + p for p in rest]] if first else [" " + p for p in rest]
        return out

    def coded(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct pre-tokens of all texts, and for each pre-token of a text its text and its code."""
        texts = whole_texts(texts)
        odd = np.fromiter((self.irregular(t) for t in texts.to_pylist()), bool, len(texts))
        rows = np.flatnonzero(~odd)
        # a space in front of every part but the first of its text
        parts = pc.split_pattern(texts.take(pa.array(rows)), " ")
        plain = parts.flatten().dictionary_encode()
        codes, names = plain.indices.to_numpy().astype(np.int64), plain.dictionary.to_pylist()
        bounds = np.asarray(parts.offsets, np.int64) - parts.offsets[0].as_py() if len(rows) else np.zeros(1, np.int64)
        heads, n = codes[bounds[:-1]], len(names)
        codes[bounds[:-1]] += n
        pieces = [" " + name for name in names]
        pieces += names if len(heads) else []
        owners = [np.repeat(rows, np.diff(bounds))]
        known = [codes]
        for i in np.flatnonzero(odd):
            found = self.cut(texts[i].as_py())
            owners.append(np.full(len(found), i))
            known.append(np.arange(len(pieces), len(pieces) + len(found)))
            pieces += found
        owner, code = np.concatenate(owners), np.concatenate(known)
        used, code = np.unique(code, return_inverse=True)
        merged = pa.array(pieces, pa.large_string()).take(pa.array(used)).dictionary_encode()
        return merged.dictionary, owner, merged.indices.to_numpy().astype(np.int64)[code]

    def frequencies(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pre-tokens of all texts; and, for each that a text has, the text, its code and how often it occurs there."""
        names, owner, code = self.coded(texts)
        width = max(1, len(names))
        pairs, times = np.unique(owner * width + code, return_counts=True)
        return names.to_pylist(), pairs // width, pairs % width, times


class PieceCounts:
    """Token counts of pre-tokens, each encoded once while remembered."""

    def __init__(self, path: str):
        self.tk = tokenizer(path)
        self.cutter = PreTokens(special_strings(self.tk))
        self.known: dict[str, int] = {}

    def lookup(self, pieces: list[str]) -> np.ndarray:
        """Counts of distinct pieces."""
        known = self.known
        missing = [p for p in pieces if p not in known]
        if missing:
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
                missing = pieces
            for i in range(0, len(missing), 4096):
                part = missing[i:i + 4096]
                known.update(zip(part, map(len, self.tk.encode_batch_fast(part, add_special_tokens=False))))
        return np.fromiter((known[p] for p in pieces), np.int64, len(pieces))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text: its pre-token frequencies joined by code to the counts of distinct pre-tokens."""
        names, owner, code, times = self.cutter.frequencies(texts)
        total = np.zeros(len(texts), np.int64)
        np.add.at(total, owner, self.lookup(names)[code] * times)
        return total


def counts_for(path: str) -> PieceCounts:
    """The worker's own counter, which lives as long as the worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounts(path)
    return _COUNTERS[path]


_COUNTERS: dict[str, PieceCounts] = {}


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` for each row, beside its columns but ``text``.

    ``path`` is a byte-level ``tokenizers`` file. Texts are taken in parts of about 4 MB. A part's
    documents become pre-token frequencies over a table of its distinct pre-tokens; each of these is
    encoded once, and their counts are joined to the frequencies by code and summed. Ids are never
    kept. Nothing is shuffled: a lost task repeats its own split only.

    Null texts count as empty, with 0 tokens; special strings inside texts count as the library counts
    them; a very long text is a part of its own and is counted whole; columns of ``docs`` with the
    names of the result give way to it and no other name clashes; repeated rows stay; there are no
    ties; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("text", "n_bytes", "n_tokens", "over_limit")]
    rows = docs.select(*kept, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counts_for(path)
        for batch in slices(batches, "text"):
            n = pa.array(counter.count(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], [*kept, "n_bytes", "n_tokens"])

    schema = rows.drop("text").withColumn("n_tokens", F.lit(0).cast("long")).schema
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def byte_characters() -> dict[int, int]:
    """The character that byte-level tokenizers show for each byte: itself if visible, else the next from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: b for b in visible}, **{b: 256 + i for i, b in enumerate(hidden)}}


def packed_ids(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class ChunkIds:
    """Token ids of white-space-separated chunks of a word-level BPE tokenizer that drops white space.

    Its normalizer and pattern never look across ASCII white space, so a text's ids are those of its
    chunks in a row. Chunks of Latin letters are normalised and cut here and only words not seen
    before go to the model; any other chunk goes to the library whole. Ids are held as bytes,
    unsigned 32-bit little-endian.
    """

    _latin = re.compile("[\x21-įĲ-ɏ]*")
    # characters a word may end with that the tokenizer's pattern keeps together, without the apostrophe of contractions
    _marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        import regex

        self.tk = tokenizer(path)
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        self.shown = byte_characters()
        self.words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) > REMEMBERED:
                self.words.clear()
            shown = word if word.isascii() and "\x7f" not in word else word.encode().decode("latin-1").translate(self.shown)
            ids = self.words[word] = packed_ids([t.id for t in self.tk.model.tokenize(shown)])
        return ids

    def chunk(self, chunk: str) -> bytes:
        if "<|" in chunk or self._latin.fullmatch(chunk) is None or not (
                chunk.isascii() or unicodedata.is_normalized("NFC", chunk)):
            return packed_ids(self.tk.encode(chunk, add_special_tokens=False).ids)
        chunk = chunk.lower()
        if chunk.isalpha():
            return self.word(chunk)
        letters = chunk.rstrip(self._marks)
        if letters.isalpha():
            return self.word(letters) + self.word(chunk[len(letters):])
        return b"".join([self.word(w) for w in self.pieces.findall(chunk)])

    def lookup(self, names: list[str]) -> list[bytes]:
        """Ids of distinct chunks. A chunk that is a remembered word needs no more; of a special string's text no word is remembered."""
        found = list(map(self.words.get, names))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self.chunk(names[i])
        return found

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, each text's followed by ``end_id``, and the offsets of texts."""
        texts = whole_texts(texts)
        plain = pc.invert(pc.match_substring(texts, "<|"))
        lowered = pc.if_else(plain, pc.ascii_lower(texts), texts)  # special strings are read before lower case
        chunks = pc.ascii_split_whitespace(lowered)
        coded = chunks.flatten().dictionary_encode()
        ids = self.lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        width = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), "<u4")
        place = np.cumsum(width) - width
        codes = coded.indices.to_numpy()
        each = width[codes]
        ends = np.cumsum(each)
        flat = pool[np.repeat(place[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.asarray(chunks.offsets, np.int64) - chunks.offsets[0].as_py()
        ends = np.concatenate(([0], ends))[bounds[1:]]
        return np.insert(flat, ends, end_id), np.concatenate(([0], ends + np.arange(1, len(ends) + 1)))


_CHUNKERS: dict[str, ChunkIds] = {}


def chunker_for(path: str) -> ChunkIds:
    if path not in _CHUNKERS:
        _CHUNKERS[path] = ChunkIds(path)
    return _CHUNKERS[path]
