import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm.mixing import mix, mixed
from plumbline.llm.sharding import hilbert_index, hilbert_shards, string_cells
from samples import DOCUMENT, ODD, clashing, documents, prose


def water_fill(sizes, weights, share, repeats):
    """Targets by handing out the excess again and again."""
    budget, targets, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        level = budget / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] >= repeats * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = level * weights[i]
            break
        for i in over:
            targets[i] = float(repeats * sizes[i])
            budget -= targets[i]
        open_ -= over
    return targets


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 60)), rng.choice(["a", "a", "a", "b", "", "é", None])) for i in range(400)]
    rows += [(1000, prose(rng, 3000), "b"), (1001, None, "a"), (1002, "one", "lonely"), (5, "repeated row", "b"), (5, "repeated row", "b")]
    return rows, documents(spark, rows)


def test_sources_get_their_targets(corpus):
    rows, docs = corpus
    got = mix(docs).groupBy("row_id").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
                                          F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                                          F.sum("words").alias("taken")).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.size) for r in got) == sorted((r[0], len((r[1] or "").encode().split())) for r in rows)
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len((r[1] or "").encode().split()) for r in rows if r[2] == n) for n in names]
    want = dict(zip(sizes, water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)))
    taken: dict = {}
    for r in got:
        assert r.target == pytest.approx(want[r.source_size])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_finish_order_alone_decides_what_is_taken(corpus):
    """A fair queue over all sources served word by word, copy for copy."""
    rows, docs = corpus
    items = mix(docs).collect()
    queues: dict = {}
    for r in items:
        assert (r["copy"], r.row_id) not in queues.setdefault(r.source_size, {})
        queues[r.source_size][r["copy"], r.row_id] = r
    served, got = [], {}
    for size, copies in queues.items():
        order = sorted(copies, key=lambda k: (k[0], copies[k].finish))
        before = 0
        for k in order:
            n = copies[k]["size"]
            served += [((before + w + 1) / int(copies[k].target + 0.5), size, k) for w in range(n) if copies[k].target]
            before += n
            got[size, k] = copies[k].words
    budget = sum(int(t + 0.5) for t in {r.source_size: r.target for r in items}.values())
    want: dict = {}
    for _, size, k in sorted(served)[:budget]:
        want[size, k] = want.get((size, k), 0) + 1
    assert {k: v for k, v in got.items() if v} == want
    assert any(r.finish > 1 for r in items)


def test_mix_is_in_order_and_runs_agree(corpus):
    _, docs = corpus
    first, second = (mix(docs).filter("words > 0").orderBy("position").collect() for _ in range(2))
    key = [(r.doc_id, r["copy"], r.words, r.position) for r in first]
    assert key == [(r.doc_id, r["copy"], r.words, r.position) for r in second]
    assert all(a.position + a.words == b.position and a.finish <= b.finish for a, b in zip(first, first[1:]))


def test_whole_documents_and_empty_tables(spark, corpus):
    _, docs = corpus
    whole = mix(docs, cut=False).collect()
    assert all(r.words in (0, r["size"]) for r in whole)
    for r in mix(docs, cut=False).groupBy("source_size").agg(F.first("target").alias("t"), F.sum("words").alias("w"),
                                                             F.max("size").alias("m")).collect():
        assert abs(r.t - r.w) <= r.m / 2 + 1
    out = mixed(docs)
    assert out.columns == docs.columns and out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 6
    empty = spark.createDataFrame([], DOCUMENT)
    assert mix(empty).count() == 0 and mixed(empty).count() == 0
    assert mixed(clashing(spark, ODD)).columns == clashing(spark, ODD).columns


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dims)
        cells = np.stack([a.ravel() for a in axes], 1)
        index = hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shards_differ_by_one_row_at_most(spark):
    rows = spark.range(1003).selectExpr("id", "id % 7 AS a", "concat('s', id % 3) AS b", "'x' AS shard", "1 AS curve")
    rows = rows.union(rows.limit(300)).withColumn("a", F.when(F.col("a") != 3, F.col("a")))
    got = hilbert_shards(rows, ["a", "b", "id"], shards=40, ties=["id"]).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 1303 and set(by) == set(range(40))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    few = hilbert_shards(spark.range(5).withColumn("c", F.lit(None).cast("string")), ["c", "id"], shards=40).collect()
    assert len({(r.shard, r.slot) for r in few}) == 5
    assert hilbert_shards(spark.range(0), ["id"]).count() == 0


def test_strings_that_start_alike_get_cells_of_their_own(spark):
    rows = spark.range(2000).selectExpr("id", "concat('source-number-', id % 20) AS s")
    rows = rows.withColumn("s", F.when(F.col("id") >= 700, F.lit("source-number-7")).otherwise(F.col("s")))  # one holds two thirds
    cuts = string_cells(rows.select(F.col("s").alias("value")), 6)
    assert cuts == sorted(f"source-number-{i}" for i in range(20))[1:]
    many = spark.range(5000).selectExpr("lpad(CAST(id AS STRING), 9, '0') AS value")
    cuts = string_cells(many, 4)
    assert cuts == [f"{-(-5000 * c // 16):09d}" for c in range(1, 16)]
    by: dict = {}
    for r in hilbert_shards(rows, ["s"], shards=40, ties=["id"]).collect():
        by.setdefault(r.shard, set()).add(r.s)
    assert sum(map(len, by.values())) <= 40 + 19  # each string lies in one run


def test_query_of_shards_against_brute_force(spark, tmp_path):
    import zlib

    from plumbline.llm import queries

    rows = [(*r, f"src{i % 12}") for i, r in enumerate(ODD)] + [(i, f"Text ß {i % 50} " * (i % 9), f"src{i % 12}") for i in range(300)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op6_hilbert_shards"](spark, str(tmp_path)).collect()
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    utf8 = [(d, (t or "").encode()) for d, t, _ in rows]
    assert sorted([(r.doc_id, r["size"], r.text_crc32) for r in got], key=str) == sorted([(d, len(b) + 16, zlib.crc32(b)) for d, b in utf8], key=str)
    # read in order of shard and slot, rows follow the curve, then text and doc_id, and runs are even
    got.sort(key=lambda r: (r.shard, r.slot))
    order = [(r.curve, r.text_crc32, -1 if r.doc_id is None else r.doc_id) for r in got]
    assert order == sorted(order)
    assert [(r.shard, r.slot) for r in got] == [(s, i - -(-s * len(got) // 40)) for i, s in enumerate(i * 40 // len(got) for i in range(len(got)))]


def test_a_source_without_words_has_target_0(spark):
    rows = [(1, "a b c", "x"), (2, None, "empty"), (3, " \n", "empty"), (4, "d e", "y")]
    got = mix(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 2, 3, 3, 4, 4]
    assert {r.target for r in got if r.doc_id in (2, 3)} == {0.0}
    assert sum(r.words for r in got) == round(1.5 * 5) and not any(r.words for r in got if r.doc_id in (2, 3))
    nulls = documents(spark, [(1, None, "x"), (2, "", "y")])
    assert [(r.target, r.words) for r in mix(nulls).collect()] == [(0.0, 0)] * 4
    assert mixed(nulls).count() == 0


NAMES = ["_id", "_sha", "_again", "_copy", "_copies", "_doc", "_row", "_text", "_n"]


@pytest.mark.parametrize("stage", ["mixed", "exact", "near"])
def test_stages_keep_columns_with_their_own_names(spark, stage):
    from plumbline.llm.exactdup import without_duplicates
    from plumbline.llm.neardup import without_near_duplicates

    rows = [(i, t, "en", "s", len(t or ""), *[f"{n}{i}" for n in NAMES]) for i, t in ODD]
    docs = spark.createDataFrame(rows, DOCUMENT + "".join(f", {n} string" for n in NAMES))
    out = {"mixed": mixed, "exact": without_duplicates, "near": without_near_duplicates}[stage](docs)
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
    assert out.count() > 3
