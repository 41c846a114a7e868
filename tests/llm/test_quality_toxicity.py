import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from plumbline.llm.quality import judge
from plumbline.llm.toxicity import fit_label_model, held_out, score_documents, votes, without_toxic
from samples import DOCUMENT, ODD, clashing, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def junk(rng, kind):
    words = prose(rng, 120).split()
    return {"symbols": " ".join(w + "%%%" for w in words), "pipes": " | ".join(words), "shout": "!! ".join(words).upper(),
            "repeats": " ".join(w for w in words[:9] for _ in range(12))}[kind]


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(7)
    rows = [(i, "\n".join(prose(rng, rng.randint(20, 60)) + "." for _ in range(4))) for i in range(300)]
    rows += [(400 + i, junk(rng, ("symbols", "pipes", "shout", "repeats")[i % 4])) for i in range(60)]
    rows += [(500, "a b c a b c\n\nx\nx\n x"), (501, "w " * 5000)] + ODD
    return rows, judge(documents(spark, rows)).collect()


def test_counts_equal_brute_force(judged):
    rows, got = judged
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=str) == \
        sorted([(r[0], *counts(r[1])) for r in rows], key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_clean_documents_stay_and_junk_goes(judged):
    _, got = judged
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(300)) <= kept
    assert not kept & set(range(400, 460))


def test_quality_of_empty_and_clashing_tables(spark):
    assert judge(spark.createDataFrame([], DOCUMENT)).count() == 0
    assert judge(clashing(spark, ODD)).count() == len(ODD)


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        words = prose(rng, rng.randint(10, 80)).split()
        bad = i % 8 == 0
        if bad:
            stems = [w for w in ("zorglu", "quibba", "idiot", "vrakno") if rng.random() < 0.7] or ["idiot"]
            for stem in stems * 2:
                words.insert(rng.randrange(len(words)), stem + ("" if stem == "idiot" else prose(rng, 1)))
        rows.append((i, " ".join(words)))
        if i % 10 != 3:
            labels.append((i, int(bad)))
    return rows, labels, documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxic_documents_are_found_on_held_out_rows(spark, toxic):
    rows, _, docs, labels = toxic
    got = score_documents(docs, labels).collect()
    assert len(got) == len(rows)
    unseen = [r for r in got if r.held_out]
    assert len(unseen) > 100
    assert sum(r.predicted == (r.doc_id % 8 == 0) for r in unseen) >= 0.98 * len(unseen)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    left = {r.doc_id for r in without_toxic(docs, labels).select("doc_id").collect()}
    assert left == {r.doc_id for r in got if not r.predicted}


def test_held_out_labels_are_never_learnt(toxic):
    _, _, docs, labels = toxic
    lied = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(score_documents(docs, labels).collect()) == sorted(score_documents(docs, lied).collect())


def test_votes_equal_brute_force(spark):
    rows = [(1, "Idiot idiots, an IDIOT! superidiot"), (2, "zorglux zorglu xzorglu"), (3, None), (4, ""), (5, "éidiot idiot")]
    got = {r.doc_id: (r.voters, r.hits) for r in votes(spark.createDataFrame(rows, "doc_id bigint, text string"), ["idiot", "zorglu*"]).collect()}
    assert got == {1: ([0], [2]), 2: ([1], [2]), 3: ([], []), 4: ([], []), 5: ([0], [1])}


def test_label_model_finds_accuracies_and_correlations(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(4000):
        y = rng.random() < 0.2
        fired = [i for i, (t, f) in enumerate([(0.8, 0.02), (0.6, 0.01), (0.5, 0.03), (0.7, 0.02)]) if rng.random() < (t if y else f)]
        rows.append((fired + [4] if 3 in fired else fired,))  # voter 4 repeats voter 3
    model = fit_label_model(spark.createDataFrame(rows, "voters array<int>"), 5, 0.1)
    assert model.prior == pytest.approx(0.2, abs=0.05)
    assert list(model.fires[:3]) == pytest.approx([0.8, 0.6, 0.5], abs=0.08)
    assert model.overlap[3, 4] > 0.8 and model.overlap[0, 1] < 0.2


def test_toxicity_of_odd_tables(spark, toxic):
    _, _, docs, labels = toxic
    none = labels.limit(0)
    empty = spark.createDataFrame([], DOCUMENT)
    assert score_documents(empty, labels).count() == 0 and score_documents(docs, none).count() == docs.count()
    nulls = spark.createDataFrame([(None, 1), (900, None), (901, 1), (901, 0)], "doc_id bigint, toxic int")
    assert score_documents(clashing(spark, ODD), nulls).count() == len(ODD)
    assert without_toxic(clashing(spark, ODD), nulls).columns == clashing(spark, ODD).columns


def test_every_toxic_word_votes_however_many_there_are(spark):
    rng = random.Random(12)
    # ends in a letter that prose lacks, so that no stem of it is shared
    bad = ["x" + "".join(rng.choice("qrstuvw") for _ in range(4)) + "z" for _ in range(150)]
    rows = [(i, prose(rng, 15)) for i in range(3000)]
    rows += [(3000 + i, f"{prose(rng, 7)} {bad[i % 150]} {prose(rng, 7)}") for i in range(150 * 14)]
    labels = spark.createDataFrame([(i, int(i >= 3000)) for i, _ in rows], "doc_id bigint, toxic int")
    got = score_documents(documents(spark, rows), labels).filter("held_out").collect()
    assert sum(r.predicted == (r.doc_id >= 3000) for r in got) >= 0.98 * len(got)


def test_a_whole_word_leaves_out_only_itself():
    from plumbline.llm.toxicity import chosen_terms

    found = [("zorg", 40, 90.0), ("zorgs", 30, 70.0), ("quib*", 30, 60.0), ("quibs", 20, 50.0), ("vrak", 20, 41.0), ("vrak*", 20, 41.0)]
    assert chosen_terms(found, 1000) == ["zorg", "zorgs", "quib*", "vrak*"]
    assert chosen_terms([("zorg", 5, 4.0)], 1000) == []


def test_every_voter_has_training_rows(spark, monkeypatch):
    from plumbline.llm import toxicity

    monkeypatch.setattr(toxicity, "TRAINING_ROWS", 10)
    rows = [(i, 5, [0] if i % 500 else [1 + i // 500], [1]) for i in range(20_000)]
    voted = spark.createDataFrame(rows, "doc_id bigint, n_words bigint, voters array<int>, hits array<int>")
    drawn = toxicity.training_rows(voted, 41).filter(~held_out(F.col("doc_id"))).collect()
    here = {v for r in rows for v in r[2]} - {v for r in voted.filter(held_out(F.col("doc_id"))).collect() for v in r.voters if v}
    assert {v for r in drawn for v in r.voters} == here and len(drawn) < 100
