"""Quality of documents by weak supervision over rules. DataFrame functions only."""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import WORD
from plumbline.sources.shared import settled

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
# A word of letters or digits, perhaps joined by marks, with at most one closing mark.
PLAIN = r"(?<![^\x20\x09-\x0D])[\p{L}\p{N}'’-]+[.,;:!?]?(?![^\x20\x09-\x0D])"
BAD, ABSTAIN, GOOD = -1, 0, 1
VOTES = (BAD, ABSTAIN, GOOD)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once per row however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in some three-word window found twice or more.

    Windows are compared by 64-bit hashes, sorted with their places: equal ones are neighbours, so a
    text of n words costs n log n. The places of repeated windows then cover up to three words each.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def same(pairs: Column, k: Column, e: Column) -> Column:
        return F.coalesce(e["h"] == F.get(pairs, k)["h"], F.lit(False))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = let(pairs, lambda p: F.sort_array(F.transform(
            F.filter(p, lambda e, k: same(p, k - 1, e) | same(p, k + 1, e)), lambda e: e["i"])))
        widths = let(places, lambda r: F.transform(r, lambda at, k: F.least(F.coalesce(F.get(r, k + 1) - at, F.lit(3)), F.lit(3))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                      F.aggregate(widths, F.lit(0), lambda a, x: a + x)).otherwise(0)

    return F.when(F.size(words) > 3, let(windows, covered)).otherwise(0).cast("long")


def text_statistics(text: Column) -> Column:
    """A struct of counts of one text; null counts as empty, with 0 everywhere."""
    body = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    count = lambda pattern: F.regexp_count(body, F.lit(pattern)).cast("long")
    of_words = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(of_words.alias("w"), of_lines.alias("l"), count(r"[#*$%&|<>]").alias("n_symbols"),
                    count(r"\p{Lu}").alias("n_upper"), count("!").alias("n_bangs"), count(PLAIN).alias("n_plain"))


@dataclass(frozen=True)
class QualityRule:
    """Votes bad or good on a share of a text, and abstains where neither condition holds. Most rules only know bad."""

    name: str
    share: str
    bad: str
    good: str = "IS NULL"

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.share} IS NULL THEN 0 WHEN {self.share} {self.bad} THEN -1 "
                      f"WHEN {self.share} {self.good} THEN 1 ELSE 0 END").alias(f"vote_{self.name}")


RULES = (
    QualityRule("symbols", "n_symbols / nullif(n_words, 0)", "> 0.1"),
    QualityRule("repeats", "n_repeat_words / nullif(n_words, 0)", "> 0.4"),
    QualityRule("lines", "n_dup_lines / nullif(n_lines, 0)", "> 0.3"),
    QualityRule("capitals", "n_upper / nullif(word_chars, 0)", "> 0.3"),
    QualityRule("bangs", "n_bangs / nullif(n_words, 0)", "> 0.2"),
    QualityRule("word_length", "abs(word_chars / nullif(n_words, 0) - 6)", "> 5"),
    QualityRule("plain_words", "n_plain / nullif(n_words, 0)", "< 0.7", ">= 0.9"),
)


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts and, by class and rule, the chances of the votes bad, abstain and good."""

    prior: float
    chances: dict[str, tuple[tuple[float, float, float], tuple[float, float, float]]]

    def log_odds(self) -> Column:
        """Of good against bad, given the vote columns."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, (bad, good) in self.chances.items():
            steps = [math.log(g / b) for b, g in zip(bad, good)]
            vote = F.col(f"vote_{name}")
            total = total + F.when(vote == BAD, steps[0]).when(vote == GOOD, steps[2]).otherwise(steps[1])
        return total

    def accuracy(self, name: str) -> float:
        """Chance that the rule's vote is right when it votes."""
        bad, good = self.chances[name]
        right, wrong = self.prior * good[2] + (1 - self.prior) * bad[0], self.prior * good[0] + (1 - self.prior) * bad[2]
        return right / (right + wrong)


def fit_label_model(votes: DataFrame, names: Sequence[str], rounds: int = 20) -> LabelModel:
    """Expectation-maximisation over the distinct vote patterns of all rows, at most 3 ** rules of them.

    Starts from rules that are mostly right and keeps a pseudo-count on each chance, so a rule that
    never votes stays neutral. Each round is one aggregate over the pattern table; only the chances
    come back. Without rows the starting model is returned.
    """
    columns = [f"vote_{n}" for n in names]
    patterns = settled(votes.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    model = LabelModel(0.8, {n: ((0.4, 0.5, 0.1), (0.02, 0.68, 0.3)) for n in names})
    for _ in range(rounds):
        good = 1 / (1 + F.exp(-model.log_odds()))
        weighed = patterns.withColumn("_good", F.col("n") * good).withColumn("_bad", F.col("n") - F.col("_good"))
        sums = weighed.agg(F.sum("_good").alias("good"), F.sum("_bad").alias("bad"), *[
            F.sum(F.when(F.col(c) == v, F.col(f"_{k}")).otherwise(0.0)).alias(f"{k}_{i}_{v + 1}")
            for i, c in enumerate(columns) for v in VOTES for k in ("good", "bad")]).first()
        if sums["good"] is None:
            break

        def chances(kind: str, i: int) -> tuple[float, float, float]:
            return tuple((sums[f"{kind}_{i}_{v}"] + 1) / (sums[kind] + 3) for v in range(3))

        model = LabelModel((sums["good"] + 1) / (sums["good"] + sums["bad"] + 2),
                           {n: (chances("bad", i), chances("good", i)) for i, n in enumerate(names)})
    return model


def judge(docs: DataFrame, rules: Sequence[QualityRule] = RULES, least: float = 0.5) -> DataFrame:
    """Quality of each row of ``docs`` (``doc_id``, ``text``): its counts, votes, ``quality`` and verdict.

    ``base_failed``: under 50 words, or over half the words in repeated windows. All other rows are
    kept when the label model gives them a chance of at least ``least`` to be good. Rules abstain on
    what they can't measure. Null and empty texts have 0 everywhere and fail the base; repeated rows
    are judged alike; an empty table gives no rows; further columns are not read. The texts are read
    once: counts and votes are written to the shared folder.
    """
    counted = docs.select("doc_id", text_statistics(F.col("text")).alias("s")).select("doc_id", "s.w.*", "s.l.*", "s.*").drop("w", "l")
    voted = settled(counted.select("*", *[r.vote() for r in rules]), "quality-votes")
    model = fit_label_model(voted, [r.name for r in rules])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (voted.withColumn("quality", 1 / (1 + F.exp(-model.log_odds()))).withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("quality") >= least)))
