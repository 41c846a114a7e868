import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import samples
from plumbline.llm import bytepairs, clustering, infilling

HOW = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
VECTORS = "vec_id bigint, embedding array<double>, cluster string, s0 int"


# --- clusters ------------------------------------------------------------------------------------
def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "taken", 1) for i, v in rows], VECTORS).repartition(parts)


def by_hand(rows, d, k, rounds=5):
    """Rows (id, vector) to (id, cluster, distance) and the centroids, by full search with Python integers."""
    kept = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
            if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in set(own):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=str), centroids


def assert_clusters(spark, rows, d, k):
    got = clustering.cluster(vectors(spark, rows), components=d, k=k).collect()
    want, centroids = by_hand(rows, d, k)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    for r in got:
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster) and r.inertia == sum(w[2] for w in want)


@pytest.mark.parametrize("k", [1, 2, 5, 8])
def test_clusters_equal_full_search(spark, k):
    rng = random.Random(k)
    assert_clusters(spark, [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(150)], 4, k)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    grid = [(i, [float(i % 3), float(i // 3 % 3)]) for i in range(40)]  # many equal distances
    odd = [(90, None), (91, []), (92, [1.0]), (93, [1.0, None]), (94, [float("nan"), 1.0]), (95, [float("inf"), 1.0]),
           (None, [2.0, 2.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [0.0, 2.0])]
    assert_clusters(spark, grid + odd, 2, 6)


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    assert_clusters(spark, [(i, [rng.uniform(-5e5, 5e5) for _ in range(3)]) for i in range(60)], 3, 7)
    with pytest.raises(Exception, match="exceed 64 bits"):
        clustering.cluster(vectors(spark, [(1, [1e9, 0.0])]), components=2, k=1).collect()


def test_fewer_vectors_than_clusters_and_no_vectors(spark):
    assert_clusters(spark, [(1, [0.5]), (2, [0.25])], 1, 40)
    for rows in ([], [(1, None)], [(None, [1.0])]):
        out = clustering.cluster(vectors(spark, rows), components=1)
        assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_result_does_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(200)]
    one, many = (sorted(clustering.cluster(vectors(spark, rows, p), components=3, k=9).collect()) for p in (1, 7))
    assert one == many


# --- byte pairs ------------------------------------------------------------------------------------
def tricky_texts(rng):
    signs = ["a", "B", "é", "中", "🎉", "1", "٣", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u2028", "\x1c", "\x85", "'s", "'", ".", "<|endoftext|>", "\x00", "\x7f"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(600)]


def test_pieces_keep_the_ids():
    rng, code = random.Random(5), bytepairs.encoding(*HOW)
    cut = 0
    for text in tricky_texts(rng):
        for size in (1, 4, 17):
            parts = list(bytepairs.pieces(text, size))
            cut += len(parts) > 1
            assert "".join(parts) == text
            assert [i for p in parts for i in code.encode_ordinary(p)] == code.encode_ordinary(text)
    assert cut > 500


def test_ids_and_bytes_equal_the_library(spark):
    rng, code = random.Random(6), bytepairs.encoding(*HOW)
    texts = [*(t for _, t in samples.ODD), *tricky_texts(rng)[:200], samples.prose(rng, 30_000), "z" * 200_000, " " * 70_000]
    docs = samples.documents(spark, list(enumerate(texts))).withColumns({"ids": F.lit("x"), "decoded": F.lit(1)})
    rows = bytepairs.decode(bytepairs.encode(docs, *HOW), *HOW).collect()
    assert len(rows) == len(texts) and set(rows[0].asDict()) == {"doc_id", "lang", "source", "n_chars", "ids", "decoded"}
    for r in rows:
        text = texts[r.doc_id] or ""
        want = code.encode_ordinary(text)
        assert list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) == want and bytes(r.decoded) == text.encode()
    assert bytepairs.encode(docs.limit(0), *HOW).count() == 0


def test_both_libraries_agree_on_the_vocabulary():
    from tokenizers import Tokenizer

    tk, code = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), bytepairs.encoding(*HOW)
    for text in tricky_texts(random.Random(7))[:200]:
        if "<|" not in text:
            assert tk.encode(text, add_special_tokens=False).ids == code.encode_ordinary(text)


# --- fill in the middle --------------------------------------------------------------------------------
def middle_by_hand(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", text, None, None
    if h[3] % 100 < 50:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


LINES = ["one\ntwo\nthree", "\n", "\n\n\n", "no end", "end\n", "a\r\nb\rc\n", "with <P> inside", "x<S>", "<M>", "<\n<P\nS>\n>", "$1 \\2\n${x}",
         "🎉\n\u2028 \u0085\n𝒳𝒴\n", "<<S\n<P\nM>\n<", "tab\t\n \n"]


@pytest.mark.parametrize("rate", [100, 40])
def test_parts_and_forms_by_hand(spark, rate):
    rng = random.Random(9)
    long = ["word " * 40_000, "\n" * 60_000, "".join(f"line {i}\n" for i in range(40_000))]
    texts = [*LINES, *[t for _, t in samples.ODD], *long]
    texts += ["".join(rng.choice(["a", "\n", "<", "P", ">", "é", " "]) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    docs = samples.documents(spark, list(enumerate(texts)) + [(None, "x\ny\n"), (3, texts[3]), (3, texts[3])])
    docs = docs.withColumns({"form": F.lit("taken"), "row": F.lit(1), "h": F.lit(2)})
    rows = infilling.fill_in_middle(docs, rate=rate).withColumn("back", infilling.restored()).collect()
    assert len(rows) == len(texts) + 3 and {r.row for r in rows} == {1} and {r.h for r in rows} == {2}
    for r in rows:
        text = "x\ny\n" if r.doc_id is None else texts[r.doc_id] or ""
        assert (r.n, r.form, r.output, r.prefix_chars, r.middle_chars) == middle_by_hand(r.doc_id, text, rate)
        assert r.back == text
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert infilling.fill_in_middle(docs.limit(0)).count() == 0
