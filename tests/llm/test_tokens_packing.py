import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm.packing import pack, pack_block, place
from plumbline.llm.tokens import ChunkIds, count_tokens
from samples import DOCUMENT, ODD, clashing, documents, prose

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
TEXTS = ["", None, " ", "  a  b ", "\n\n x\t\ty", "foo<|endoftext|> bar", "<|STARTOFTEXT|> Hello", "<|startoftext|>Hi", " lead",
         "İstanbul ΣΑΣ 中文 字 a b c\u0085d e\x1cf \x1cg", "don't we'll I'M 12 345 ²½ é é x" * 3, "trail ", "a \n b", "a  b   c",
         "__x__ _ a_b ﻿ zz", "a" * 5000, "🎉🎉 ok🎉", "a b   c", "x   y", "word\r\nword"]


def test_token_counts_equal_the_library(spark):
    tk = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    rows = list(enumerate(TEXTS + [prose(rng, 50) + rng.choice([" ", "\n", "  "]) for _ in range(40)])) + ODD
    got = count_tokens(documents(spark, rows).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), 20).collect()
    want = [(d, len((t or "").encode()), len(tk.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)


def test_token_counts_of_special_strings_and_many_parts(spark, monkeypatch):
    from plumbline.llm import tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    tk, rng = tokenizers.Tokenizer.from_file(path), random.Random(4)
    special = "<|endoftext|>"
    texts = [special, special * 3, f" {special} ", f"a {special}b  c", f"x\n{special}\ty {special[:-1]}", "nospace" * 20000, " ", "  "]
    texts += [special.join(prose(rng, 4) + rng.choice(["", " ", "\n"]) for _ in range(3)) for _ in range(20)] + ["the same words"] * 50
    cutter = tokens.PreTokens([special])
    for t in texts:
        assert "".join(cutter.cut(t)) == t
    monkeypatch.setattr(tokens.slices, "__defaults__", (200,))  # a part for every few texts
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "a b")]
    got = count_tokens(documents(spark, rows), path, 5).collect()
    assert sorted([(r.doc_id, r.n_tokens) for r in got], key=str) == sorted([(d, len(tk.encode(t).ids)) for d, t in rows], key=str)
    clash = documents(spark, rows).withColumnsRenamed({"lang": "row", "source": "part"}).withColumns({"codes": F.lit("c"), "names": F.lit(1)})
    assert {(r["row"], r.codes, r.names) for r in count_tokens(clash, path, 5).collect()} == {("en", "c", 1)}


def test_token_counts_of_empty_and_clashing_tables(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert count_tokens(spark.createDataFrame([], DOCUMENT), path, 5).count() == 0
    out = count_tokens(clashing(spark, ODD), path, 5)
    assert out.count() == len(ODD) and "extra" in out.columns


def test_packed_ids_equal_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tk = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(6)
    rows = list(enumerate(TEXTS + [prose(rng, rng.randint(1, 900)) for _ in range(60)]))
    ids = {d: tk.encode(t or "", add_special_tokens=False).ids + [1] for d, t in rows}
    got = pack(documents(spark, rows), path, max_tokens=512).collect()
    sequences, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert list(np.frombuffer(r.ids, "<u4")) == ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id])
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length))
    for pieces in [*sequences.values(), *docs.values()]:
        pieces.sort()
        assert pieces[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
    assert all(docs[d][-1][0] + docs[d][-1][1] == len(ids[d]) for d in ids)
    assert all(p[-1][0] + p[-1][1] <= 512 and len(p) <= 128 for p in sequences.values())
    assert sum(map(len, ids.values())) >= 0.95 * 512 * len(sequences)


def test_packing_of_empty_and_repeated_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert pack(spark.createDataFrame([], DOCUMENT), path).count() == 0
    got = pack(clashing(spark, ODD), path, max_tokens=64)
    assert got.filter("start = 0").count() == len(ODD)


@pytest.mark.parametrize("cut", [False, True])
def test_all_three_limits_hold(cut):
    rng = np.random.default_rng(0)
    tokens = rng.integers(1, 300, 400)
    loss = tokens if cut else np.minimum(rng.integers(0, 200, 400), tokens)
    bins, seen = collections.defaultdict(list), collections.Counter()
    for i, start, length, b, offset in pack_block(tokens, loss, (512, 5, 400), cut):
        bins[b].append((i, offset, length))
        seen[i] += length
    assert all(seen[i] == tokens[i] for i in range(400))
    for pieces in bins.values():
        assert sum(p[2] for p in pieces) <= 512 and len(pieces) <= 5
        assert sum(p[2] if cut else loss[p[0]] for p in pieces) <= 400


def test_examples_over_a_limit_get_their_own_bin(spark):
    assert [x[:4] for x in pack_block(np.array([900, 10]), np.array([5, 5]), (512, 4, 512), False)] == [(1, 0, 10, 0), (0, 0, 900, 1)]
    examples = spark.range(3000).select(F.col("id").alias("row_id"), (F.col("id") % 400 + 1).alias("tokens"),
                                        (F.col("id") % 200).alias("loss"))
    placed = place(examples, 512, 4, 300, cut=False).select(F.explode("pieces").alias("p"), "row_id").select("row_id", "p.*")
    by = placed.join(examples, "row_id").groupBy("sequence").agg(F.sum("length").alias("t"), F.count(F.lit(1)).alias("n"), F.sum("loss").alias("l"))
    top = by.agg(F.max("t"), F.max("n"), F.max("l")).first()
    assert top[0] <= 512 and top[1] <= 4 and top[2] <= 300 and placed.count() == 3000


def test_chunk_ids_equal_the_library_for_every_low_character():
    path = public_tokenizers.path("word_bpe_49k.json")
    tk, chunker = tokenizers.Tokenizer.from_file(path), ChunkIds(path)
    rng = random.Random(11)
    signs = [chr(c) for c in range(1, 0x250)]
    texts = [*signs, *[f"a{c}b" for c in signs], *["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(3000)]]
    ids, ends = chunker.encode(pa.array(texts), 1)
    for i, t in enumerate(texts):
        assert ids[ends[i]:ends[i + 1]].tolist() == tk.encode(t, add_special_tokens=False).ids + [1], repr(t)
