"""Toxicity by weak supervision: lexicon and stem voters, a label model and a linear classifier."""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.shared import settled

# Labelled rows that the calibration's five numbers are learnt from, at most; rows the classifier learns from
# beside those that are drawn for each voter.
LABELLED_ROWS = 20_000
TRAINING_ROWS = 20_000
ROWS_A_VOTER = 20
# Share of mined terms that may be there by chance, and the terms a task counts before it hands them on.
FALSE_TERMS = 0.05
COUNTED_TERMS = 500_000
# Labels beyond this many are joined by a shuffle of the texts.
BROADCAST_LABELS = 20_000_000
STEM_LENGTHS = (4, 5, 6, 7, 8)
# Plain insults that speak for themselves, matched as whole words.
SEEDS = ("idiot", "idiots", "moron", "morons", "stupid", "scum", "loser", "losers", "trash", "clown", "worthless", "pathetic",
         "disgusting", "dumb", "imbecile", "bastard", "arschloch", "dummkopf", "abschaum", "vollidiot", "drecksau",
         "connard", "salaud", "ordure", "crétin", "imbécile", "idiota", "estúpido", "imbécil", "basura", "cabrón")


def held_out(doc_id: Column) -> Column:
    """Whether a row is never learnt from: crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def words_of(text: str) -> list[str]:
    """Runs of letters, lower case."""
    return "".join(c if c.isalpha() else " " for c in text.lower()).split() if not text.isascii() else \
        text.lower().translate(_ASCII_LETTERS).split()


_ASCII_LETTERS = {i: " " for i in range(128) if not chr(i).isalpha()}


def chosen_terms(found: Iterable[tuple[str, int, float]], tested: int) -> list[str]:
    """Of ``(term, rows, gain)`` those that are significant among ``tested`` terms and say more than a term before.

    exp(-gain) bounds the chance that a term's rows are toxic as often by luck, so by Benjamini and
    Hochberg's rule ``FALSE_TERMS`` of the terms kept are false at most. Terms are taken by gain, the
    longer one of equals. A stem stands for whatever begins with it and leaves out its shorter stems;
    a whole word leaves out itself only, and stems that have no other rows than it.
    """
    order = sorted(found, key=lambda f: (-f[2], -len(f[0]), f[0]))
    passed = [k for k, f in enumerate(order, 1) if f[2] >= np.log(max(tested, 1) / (FALSE_TERMS * k))]
    terms: list[str] = []
    stems, shorter, words = set(), set(), set()
    for term, rows, _ in order[:max(passed, default=0)]:
        stem = term.rstrip("*")
        begins = [stem[:n] for n in STEM_LENGTHS if len(stem) >= n]
        if stems.intersection(begins) or term.endswith("*") and (stem in shorter or (stem, rows) in words):
            continue
        terms.append(term)
        if term.endswith("*"):
            stems.add(stem)
            shorter.update(begins)
        else:
            words.update((b, rows) for b in begins)
    return terms


def mine_terms(labelled: DataFrame, least: int = 5, purity: float = 0.4) -> list[str]:
    """Stems and words that documents labelled toxic have and others don't: all that pass ``chosen_terms``.

    ``labelled``: ``text``, ``toxic``. A term ends in ``*`` if it is a stem. It is in ``least`` toxic
    rows at least, and ``purity`` of its rows are toxic.
    """

    def counted(rows: Counter, toxic: Counter) -> pa.RecordBatch:
        kept = list(rows)
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([rows[t] for t in kept], pa.int64()),
                                           pa.array([toxic[t] for t in kept], pa.int64())], ["term", "n", "toxic"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(words_of(text or ""))
                terms = words | {f"{w[:n]}*" for w in words for n in STEM_LENGTHS if len(w) >= n}
                rows.update(terms)
                if label:
                    toxic.update(terms)
                if len(rows) > COUNTED_TERMS:
                    yield counted(rows, toxic)
                    rows, toxic = Counter(), Counter()
        yield counted(rows, toxic)

    counts = settled(labelled.select("text", "toxic").mapInArrow(run, "term string, n bigint, toxic bigint").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).filter(F.col("n") >= least), "toxicity-terms")
    totals = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    expected = F.col("n") * (totals["toxic"] / max(totals["n"], 1))
    clean = F.col("n") - F.col("toxic")
    gain = F.col("toxic") * F.log(F.col("toxic") / expected) + F.when(clean > 0, clean * F.log(
        clean / (F.col("n") - expected))).otherwise(0.0)
    found = (counts.filter((F.col("toxic") >= least) & (F.col("toxic") >= purity * F.col("n"))
                           & (F.col("toxic") > expected)).withColumn("gain", gain)
             .filter(F.col("gain") >= float(-np.log(FALSE_TERMS))).select("term", "n", "gain").collect())
    return chosen_terms([tuple(r) for r in found], counts.count())


def votes(docs: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``voters`` (places in ``terms`` that fire, ascending) and ``hits`` of each."""
    kept = [c for c in docs.columns if c not in ("text", "n_words", "voters", "hits")]
    added = (("n_words", "bigint"), ("voters", "array<int>"), ("hits", "array<int>"))
    schema = docs.select(*kept, *[F.lit(None).cast(kind).alias(name) for name, kind in added]).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        finder = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            places = finder.get(term.rstrip("*"), ()) + ((i, term.endswith("*"), len(term.rstrip("*"))),)
            finder.add_word(term.rstrip("*"), places)
        if terms:
            finder.make_automaton()
        for batch in batches:
            words, voters, hits = [], [], []
            for text in batch.column("text").to_pylist():
                text = (text or "").lower()
                found: Counter = Counter()
                for end, places in finder.iter(text) if terms else ():
                    for i, stem, size in places:
                        before = end - size
                        if (before < 0 or not text[before].isalpha()) and (
                                stem or end + 1 == len(text) or not text[end + 1].isalpha()):
                            found[i] += 1
                words.append(len(text.split()))
                fired = sorted(found)
                voters.append(fired)
                hits.append([found[i] for i in fired])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(words, pa.int64()), pa.array(voters, pa.list_(pa.int32())),
                 pa.array(hits, pa.list_(pa.int32()))], [*kept, "n_words", "voters", "hits"])

    return docs.select(*kept, "text").mapInArrow(run, schema)


def doubles(values: Iterable[float]) -> Column:
    """A constant array, as one literal however long it is."""
    text = ",".join(repr(float(x)) for x in values)
    return F.split(F.lit(text), ",").cast("array<double>") if text else F.array().cast("array<double>")


class Overlap:
    """Symmetric, sparse: what pairs of voters share."""

    def __init__(self, n: int, i: np.ndarray, j: np.ndarray, share: np.ndarray):
        a, b, s = np.r_[i, j].astype(int), np.r_[j, i].astype(int), np.r_[share, share].astype(float)
        order = np.argsort(a, kind="stable")
        self.others, self.shares = b[order], s[order]
        self.start = np.searchsorted(a[order], np.arange(n + 1))
        self.mark = np.zeros(n, bool)

    def __getitem__(self, pair: tuple[int, int]) -> float:
        part = slice(*self.start[pair[0]:pair[0] + 2])
        return float(self.shares[part][self.others[part] == pair[1]].sum())

    def shared(self, fired: np.ndarray) -> np.ndarray:
        """Of each voter that fired, what it shares with the others that did."""
        self.mark[fired] = True
        parts = [slice(*self.start[v:v + 2]) for v in fired]
        out = np.array([self.shares[p][self.mark[self.others[p]]].sum() for p in parts])
        self.mark[fired] = False
        return out

    def total(self) -> np.ndarray:
        sums = np.r_[0.0, np.cumsum(self.shares)]
        return sums[self.start[1:]] - sums[self.start[:-1]]


@dataclass(frozen=True)
class LabelModel:
    """Share of toxic documents, each voter's chance to fire in toxic and in other ones, and what voters share."""

    prior: float
    fires: np.ndarray
    false: np.ndarray
    overlap: Overlap
    alone: np.ndarray

    def log_odds(self, voters: Sequence[int]) -> float:
        """A voter counts less the more it says what another voter that fired says; silence, what any says."""
        fired = np.asarray(voters, int)
        quiet = self.alone * np.log((1 - self.fires) / (1 - self.false))
        total = np.log(self.prior / (1 - self.prior)) + quiet.sum()
        if len(fired):
            loud = np.log(self.fires[fired] / self.false[fired]) - quiet[fired]
            total += (loud / (1 + self.overlap.shared(fired))).sum()
        return float(total)


def excess(sets: DataFrame, weight: Column, rates: np.ndarray, total: float) -> Overlap:
    """Pairs of voters that fire together more than chance: by the correlation of their votes, less 0.05."""
    at = doubles(rates)
    a, b = F.get(at, F.col("i")), F.get(at, F.col("j"))
    pairs = (sets.filter(F.size("voters") > 1).select(F.explode("voters").alias("i"), "voters", weight.alias("_p"))
             .select("i", F.explode("voters").alias("j"), "_p").filter("i < j").groupBy("i", "j").agg(F.sum("_p").alias("t"))
             .withColumn("s", (F.col("t") / total - a * b) / F.sqrt(a * (1 - a) * b * (1 - b)) - 0.05)
             .filter("s > 0").select("i", "j", F.least("s", F.lit(1.0)).alias("s"))).toPandas()
    return Overlap(len(rates), pairs["i"].to_numpy(), pairs["j"].to_numpy(), pairs["s"].to_numpy())


def votes_by(rows: DataFrame, toxic: Column, number: Column, n_voters: int) -> tuple[tuple[float, float], np.ndarray]:
    """Sums of ``toxic`` and of ``number``, of all rows and of those where each voter fires."""
    # voter -1 stands for all rows
    sums = {r["v"]: (r["t"], r["n"]) for r in rows.select(
        F.explode(F.concat(F.array(F.lit(-1)), "voters")).alias("v"), toxic.cast("double").alias("t"),
        number.cast("double").alias("n")).groupBy("v").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).collect()}
    return sums.get(-1, (0.0, 0.0)), np.array([sums.get(i, (0.0, 0.0)) for i in range(n_voters)]).reshape(n_voters, 2)


def with_factors(sets: DataFrame, overlap: Overlap) -> DataFrame:
    """Add ``factors``: what each voter of a set counts beside the others of it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            factors = [(1 / (1 + overlap.shared(np.asarray(v, int)))).tolist() for v in batch.column("voters").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("voters"), batch.column("n"), pa.array(factors, pa.list_(pa.float64()))],
                                             ["voters", "n", "factors"])

    return sets.select("voters", "n").mapInArrow(run, "voters array<int>, n double, factors array<double>")


def fit_label_model(voted: DataFrame, n_voters: int, prior: float, rounds: int = 10,
                    known: tuple[tuple[float, float], np.ndarray] | None = None) -> LabelModel:
    """Accuracies and correlations of the voters, from the votes of all documents.

    Expectation-maximisation on the distinct sets of voters that fire: a round is one aggregate, which
    returns a sum a voter. ``known``, ``votes_by`` of labelled rows, is where it starts and counts as rows
    beside the others, and ``prior`` holds; without it no label is used. In a round voters that fire together wherever any
    fires count as one. Then pairs are counted among documents, weighed by their chance to be toxic; a
    pair that fires together more than chance given the class is correlated by that excess.
    """
    sets = settled(voted.groupBy("voters").agg(F.count(F.lit(1)).cast("double").alias("n")), "vote-sets")
    (any_fired, _), each = votes_by(sets, F.when(F.size("voters") > 0, F.col("n")).otherwise(0.0), F.col("n"), n_voters)
    rates = np.clip(each[:, 0] / max(any_fired, 1.0), 1e-9, 1 - 1e-9)
    together = excess(sets, F.col("n"), rates, max(any_fired, 1.0))
    alone = 1 / (1 + together.total())
    sets = settled(with_factors(sets, together), "vote-factors")
    # a toxic document fires some voters, however many there are
    few = min(1.0, 64 / max(alone.sum(), 1.0))
    (toxic_known, all_known), seen = known or ((0.0, 0.0), np.zeros((n_voters, 2)))

    def rates_of(toxic: float, total: float, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        toxic, total, mine = toxic + toxic_known, total + all_known, mine + seen
        return (np.clip((mine[:, 0] + 0.2 * few) / (toxic + 2), 1e-4 * few, 0.999),
                np.clip((mine[:, 1] - mine[:, 0] + 0.005 * few) / (total - toxic + 1), 1e-6 * few, 0.5))

    fires, false = rates_of(0.0, 0.0, np.zeros((n_voters, 2))) if toxic_known else (
        np.full(n_voters, 0.2 * few), np.full(n_voters, 0.005 * few))
    toxic, total, post = 0.0, 0.0, F.lit(0.0)
    for _ in range(rounds):
        quiet = np.log((1 - fires) / (1 - false))
        weight = doubles(np.log(fires / false) - quiet * alone)
        odds = F.aggregate(F.zip_with("voters", "factors", lambda v, f: f * F.get(weight, v)),
                           F.lit(float(np.log(prior / (1 - prior)) + (alone * quiet).sum())), lambda a, x: a + x)
        post = 1 / (1 + F.exp(-odds))
        (toxic, total), mine = votes_by(sets, F.col("n") * post, F.col("n"), n_voters)
        prior = prior if toxic_known else (toxic + 1) / (total + 10)
        fires, false = rates_of(toxic, total, mine)
    overlap = excess(sets, F.col("n") * post, fires, max(toxic, 1.0))
    return LabelModel(prior, fires, false, overlap, alone)


@dataclass(frozen=True)
class Sparse:
    """The values of a matrix that are not 0, and where they are."""

    row: np.ndarray
    col: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def of(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.col], self.shape[0])

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * r[self.row], self.shape[1])

    def with_ones(self) -> Sparse:
        n, k = self.shape
        return Sparse(np.r_[self.row, np.arange(n)], np.r_[self.col, np.full(n, k)], np.r_[self.value, np.ones(n)], (n, k + 1))


def dense(x: np.ndarray) -> Sparse:
    row, col = np.nonzero(x)
    return Sparse(row, col, x[row, col], x.shape)


def conjugate(times, b: np.ndarray, diagonal: np.ndarray, steps: int = 500) -> np.ndarray:
    """The x with ``times(x)`` = ``b``, by conjugate gradients."""
    x, r = np.zeros(len(b)), b.copy()
    z = r / diagonal
    p, rz = z, r @ z
    for _ in range(steps):
        if np.abs(r).max() <= 1e-9 * max(np.abs(b).max(), 1e-9):
            break
        ap = times(p)
        a = rz / (p @ ap)
        x, r = x + a * p, r - a * ap
        z = r / diagonal
        rz, before = r @ z, rz
        p = z + rz / before * p
    return x


def logistic(x: Sparse, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels, by Newton steps; the last weight is the intercept."""
    x = x.with_ones()
    w = np.zeros(x.shape[1])
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-3]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.of(w), -30, 30)))
        gradient = x.back(p - y) + penalty * w
        curve = p * (1 - p) + 1e-6
        diagonal = np.bincount(x.col, x.value ** 2 * curve[x.row], x.shape[1]) + penalty
        step = conjugate(lambda v: x.back(curve * x.of(v)) + penalty * v, gradient, diagonal)  # noqa: B023
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    """``weights``: a term's, for each log(1 + hits); ``calibration``: of their sum, voters, hits, words and 1."""

    terms: tuple[str, ...]
    labels: LabelModel
    weights: tuple[float, ...]
    calibration: tuple[float, ...]

    def score(self) -> Column:
        """Of rows with the columns of ``votes``."""
        w = doubles(self.weights)
        terms = F.zip_with("voters", "hits", lambda v, h: F.get(w, v) * F.log1p(h.cast("double")))
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
        hits = F.aggregate("hits", F.lit(0), lambda a, h: a + h).cast("double")
        parts = (total(terms), F.size("voters"), F.log1p(hits), F.log1p(F.col("n_words").cast("double")), F.lit(1.0))
        odds = F.lit(0.0)
        for weight, part in zip(self.calibration, parts):
            odds = odds + weight * part
        return 1 / (1 + F.exp(-odds))


def hits_matrix(rows: pd.DataFrame, n_voters: int) -> Sparse:
    sizes = [len(v) for v in rows["voters"]]
    flat = lambda name: np.concatenate([np.zeros(0), *map(np.asarray, rows[name])])
    return Sparse(np.repeat(np.arange(len(rows)), sizes), flat("voters").astype(int), np.log1p(flat("hits").astype(float)),
                  (len(rows), n_voters))


def summary(rows: pd.DataFrame, linear: np.ndarray) -> np.ndarray:
    return np.stack([linear, [len(v) for v in rows["voters"]], [np.log1p(sum(h)) for h in rows["hits"]],
                     np.log1p(rows["n_words"].to_numpy(float))], 1).astype(float)


def sampled(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows, by a hash of ``doc_id``."""
    return rows.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(bound)


def training_rows(voted: DataFrame, n_voters: int) -> DataFrame:
    """Rows that may be learnt from: about ``TRAINING_ROWS`` by a hash, and of each voter about ``ROWS_A_VOTER`` or all it has.

    A row's chance is the largest that it has by itself or any of its voters gives it.
    """
    known = voted.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    fired = {r["v"]: r["n"] for r in known.select(F.explode(F.concat(F.array(F.lit(-1)), "voters")).alias("v")).groupBy("v").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    chance = doubles(ROWS_A_VOTER / max(fired.get(i, 0), 1) for i in range(n_voters))
    by_itself = F.lit(TRAINING_ROWS / max(fired.get(-1, 0), 1))
    best = F.aggregate("voters", by_itself, lambda a, v: F.greatest(a, F.get(chance, v)))
    place = (F.xxhash64(F.lit(5), "doc_id", "n_words", "voters", "hits").bitwiseAND((1 << 52) - 1) / float(1 << 52)) / best
    return known.withColumn("_place", place).filter(F.col("_place") < 1).orderBy("_place", "doc_id").limit(
        2 * (TRAINING_ROWS + ROWS_A_VOTER * n_voters)).drop("_place")


def vocabulary(docs: DataFrame, labels: DataFrame) -> list[str]:
    """Voters' terms: mined from all labelled rows that are not held out, then the seeds."""
    # texts stay where they are as long as the labels fit into each executor
    known = F.broadcast(labels) if labels.count() <= BROADCAST_LABELS else labels
    mined = mine_terms(docs.select("doc_id", "text").join(known, "doc_id"))
    return mined + [s for s in SEEDS if not any(s.startswith(t[:-1]) if t.endswith("*") else s == t for t in mined)]


def learnable(labels: DataFrame) -> DataFrame:
    """One row (``doc_id``, ``toxic``) for each labelled document that may be learnt from."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))


def fit(voted: DataFrame, terms: Sequence[str], labels: DataFrame) -> ToxicityModel:
    """Label model on all votes and labels, a linear classifier on its posterior labels, calibrated on labelled rows.

    ``voted``: settled ``votes`` with ``doc_id``. The classifier learns from ``training_rows`` and the
    calibration from at most ``LABELLED_ROWS``, none of them held out.
    """
    n = len(terms)
    marked = voted.join(F.broadcast(sampled(labels, LABELLED_ROWS)), "doc_id").select("voters", "hits", "n_words", "toxic").toPandas()
    share = float(np.clip(marked.toxic.mean(), 0.01, 0.5)) if len(marked) else 0.1
    known = votes_by(voted.join(labels, "doc_id"), F.col("toxic"), F.lit(1), n)
    model = fit_label_model(voted, n, share, known=known)
    train = training_rows(voted, n).select("voters", "hits").toPandas()
    odds = np.clip(np.array([model.log_odds(v) for v in train["voters"]], float), -30, 30)
    weights = logistic(hits_matrix(train, n), 1 / (1 + np.exp(-odds)))
    calibration = (1.0, 0.0, 0.0, 0.0, float(weights[-1]))
    if marked.toxic.nunique() == 2:
        linear = hits_matrix(marked, n).of(weights[:-1])
        calibration = logistic(dense(summary(marked, linear)), marked.toxic.to_numpy(float), ridge=1e-1)
    return ToxicityModel(tuple(terms), model, tuple(map(float, weights[:-1])), tuple(map(float, calibration)))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row of ``docs`` (``doc_id``, ``text``).

    ``labels``: ``doc_id``, ``toxic``. Inputs of a score are the text's voters, their hits and its
    length. Null and empty texts have no votes and get the score of such texts; rows with a null
    doc_id are scored but not learnt from; repeated labels count once, the toxic one first; without
    labels the seeds vote alone; an empty table gives no rows; further columns are not read.
    """
    usable = settled(learnable(labels), "toxicity-labels")
    terms = vocabulary(docs, usable)
    voted = settled(votes(docs.select("doc_id", "text"), terms), "toxicity-votes")
    model = fit(voted, terms, usable)
    return voted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose score is under ``threshold``, all columns as they were; texts are scored where they are read."""
    usable = settled(learnable(labels), "toxicity-labels")
    terms = vocabulary(docs, usable)
    model = fit(settled(votes(docs.select("doc_id", "text"), terms), "toxicity-votes"), terms, usable)
    kept = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return votes(kept, terms).filter(model.score() < threshold).select("_row.*")
