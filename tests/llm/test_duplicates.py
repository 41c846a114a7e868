import collections
import hashlib
import random
import re

import pyarrow as pa
import pytest

import plumbline.llm.neardup as neardup
from plumbline.llm.common import slices
from plumbline.llm.components import components
from plumbline.llm.exactdup import exact_duplicates, without_duplicates
from plumbline.llm.neardup import near_duplicates, without_near_duplicates
from plumbline.llm.repeats import remove_repeats
from samples import DOCUMENT, ODD, clashing, documents, prose


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    long = prose(rng, 4000)
    rows = [(i, rng.choice([long, long.upper(), long + "x", long[:4096], long[:8192], "y" + long[1:], "Äb", "äb", "a", "A"]))
            for i in range(60)] + ODD + [(800 + i, "hot text") for i in range(100)]
    groups = collections.defaultdict(list)
    for doc, text in rows:
        groups[lower(text)].append(doc)
    got = exact_duplicates(documents(spark, rows)).collect()
    want = []
    for doc, text in rows:
        mates = groups[lower(text)]
        keep = max((m for m in mates if m is not None), default=None)
        want.append((doc, keep, len(mates), hashlib.sha256(lower(text).encode()).hexdigest()))
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == sorted(want, key=str)
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_keeps_rows_as_they_were(spark):
    docs = clashing(spark, ODD)
    left = without_duplicates(docs)
    assert left.columns == docs.columns
    texts = [lower(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({lower(t) for _, t in ODD})
    empty = spark.createDataFrame([], DOCUMENT)
    assert exact_duplicates(empty).count() == 0 and without_duplicates(empty).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min([x for x in (d, least.get(root(i))) if x is not None], default=None)
    return [(d, len(s), least[root(i)] if s else d) for i, (d, s) in enumerate(sets)]


def test_slices_of_a_batch_have_their_own_shingles():
    rng = random.Random(8)
    texts = [None if i % 11 == 3 else prose(rng, i % 40).title() + " é" for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts, pa.string())], ["i", "text"])
    parts = list(slices([batch], "text", most=500))
    assert len(parts) > 50 and [i for p in parts for i in p.column("i").to_pylist()] == list(range(300))
    cut = [s for p in parts for s in neardup.shingle_sets(p.column("text"))]
    assert [len(s) for s in cut] == [len(shingles(t)) for t in texts]
    assert all((a == b).all() for a, b in zip(cut, neardup.shingle_sets(batch.column("text"))))


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(11)
    common = prose(rng, 12)
    rows = list(ODD)
    for f in range(25):
        base = prose(rng, rng.choice([3, 6, 30, 90, 300])).split()
        for v in range(rng.choice([1, 2, 14])):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = prose(rng, 1)
            rows.append((f * 100 + v, " ".join(words) + (" " + common if f % 3 == 0 else "")))
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates_equal_brute_force(spark, copies, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_DOCS", block)
    got = near_duplicates(documents(spark, copies)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == sorted(brute_components(copies), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_keeps_one_of_each_group(spark, copies):
    docs = documents(spark, copies)
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {c for _, _, c in brute_components(copies)}
    empty = spark.createDataFrame([], DOCUMENT)
    assert near_duplicates(empty).count() == 0 and near_duplicates(clashing(spark, ODD)).count() == len(ODD)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (50, 60), (60, 50)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[60] == 50


def brute_repeats(rows, size):
    seen = collections.Counter()
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        seen.update(b[p:p + size] for p in range(len(b) - size + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if seen[b[p:p + size]] > 1:
                gone[p:p + size] = b"\1" * size
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [20_000, 2])
def test_removed_repeats_equal_brute_force(spark, group):
    rng = random.Random(5)
    parts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(20, 90))) for _ in range(10)]
    rows = list(ODD)
    for i in range(100):
        rows.append((i, "".join(rng.choice([prose(rng, rng.randint(1, 9)), rng.choice(parts)[rng.randint(0, 9):], rng.choice(parts)])
                                for _ in range(rng.randint(0, 9)))))
    rows += [(200, "a" * 500), (201, "ab" * 300), (202, rows[30][1]), (202, rows[30][1]), (None, rows[31][1]), (203, "ä" * 90)]
    got = remove_repeats(documents(spark, rows), length=40, window=20, group=group).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute_repeats(rows, 40)


def test_repeats_of_empty_and_clashing_tables(spark):
    assert remove_repeats(spark.createDataFrame([], DOCUMENT)).count() == 0
    got = remove_repeats(clashing(spark, ODD)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute_repeats(ODD, 400)


def test_rows_without_a_doc_id_meet_only_texts_like_their_own(spark):
    rng = random.Random(5)
    bodies = [prose(rng, 120) for _ in range(60)]
    rows = [(None, b) for b in bodies] + [(None, b + " tail") for b in bodies[:20]] + [(i, b + " end") for i, b in enumerate(bodies[:10])]
    got = near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    named = collections.Counter(r.component_id for r in got if r.component_id is not None)
    assert named == {i: 3 for i in range(10)} and {r.doc_id for r in got if r.kept and r.doc_id is not None} == set(range(10))
    assert sum(r.component_id is None for r in got) == len(rows) - 30
    from plumbline.llm.neardup import full_sets, sketches

    found = sketches(documents(spark, rows)).collect()
    needed = spark.createDataFrame([(r.row_id, r.doc_id, r.body, bytes(r.digest)) for r in found],
                                   "rep bigint, rep_doc bigint, rep_body bigint, _digest binary")
    assert full_sets(documents(spark, rows), needed).count() == len(rows)
