"""Exact and near duplicates of measurement vectors, always within one table.

Groups are counted with a map-side partial aggregate, so a group holding a third of the table costs
no more than any other; facts return to the rows through ``attach_groups``.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rowwise import round_half_even
from plumbline.operators.skew import attach_groups


def rounded(cols: Sequence[str], decimals: int | None) -> list[Column]:
    """The grouping columns: as they are, or rounded to ``decimals`` places."""
    return [F.col(c) if decimals is None else round_half_even(c, decimals).alias(c) for c in cols]


def groups(df: DataFrame, cols: Sequence[str], decimals: int | None = None,
           facts: Mapping[str, Column] | None = None, at_least: int = 2) -> DataFrame:
    """One row per vector occurring at least ``at_least`` times, with ``n`` and the given facts.

    NULL equals NULL. Facts are aggregates over the group's rows.
    """
    extra = [c for c in df.columns if c not in cols]
    keyed = df.select(*rounded(cols, decimals), *extra)
    out = keyed.groupBy(*cols).agg(F.count("*").alias("n"), *[a.alias(k) for k, a in (facts or {}).items()])
    return out.filter(F.col("n") >= at_least) if at_least > 1 else out


def duplicate_totals(df: DataFrame, cols: Sequence[str], decimals: int | None = None) -> DataFrame:
    """Rows that share their vector with another row, and the number of such groups."""
    return groups(df.select(*cols), cols, decimals).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_groups"))


def conflicts(df: DataFrame, cols: Sequence[str], targets: Sequence[str],
              decimals: int | None = None) -> DataFrame:
    """Duplicate groups whose rows disagree, per target: more than one distinct non-null value."""
    facts = {f"_x_{t}": F.min(t) != F.max(t) for t in targets}
    found = groups(df.select(*cols, *targets), cols, decimals, facts)
    cells = F.array(*[F.struct(F.lit(t).alias("target"), F.count("*").alias("n_groups"),
                               F.count_if(F.col(f"_x_{t}")).alias("n_conflicting")) for t in targets])
    return found.agg(cells.alias("c")).select(F.inline("c"))


def is_duplicate(df: DataFrame, cols: Sequence[str], out: str = "is_dup",
                 decimals: int | None = None) -> DataFrame:
    """Mark every copy of a repeated vector."""
    return group_facts(df, cols, {}, size=None, flag=out, decimals=decimals)


def group_facts(df: DataFrame, cols: Sequence[str], facts: Mapping[str, Column], size: str | None = "group_size",
                flag: str | None = None, decimals: int | None = None) -> DataFrame:
    """Attach the size of each row's duplicate group, a flag and further aggregates of repeated groups.

    Only groups of two or more travel; a row without one is alone, with size 1 and NULL facts.
    """
    keys = list(cols) if decimals is None else [f"_r_{c}" for c in cols]
    keyed = df if decimals is None else df.withColumns(
        {k: round_half_even(c, decimals) for k, c in zip(keys, cols)})
    found = (keyed.groupBy(*keys).agg(F.count("*").alias("_n"), *[a.alias(k) for k, a in facts.items()])
             .filter("_n > 1"))
    joined = attach_groups(keyed, found, keys, "_n")
    added = {}
    if size is not None:
        added[size] = F.coalesce(F.col("_n"), F.lit(1))
    if flag is not None:
        added[flag] = F.col("_n").isNotNull()
    return joined.withColumns(added).drop("_n", *([] if decimals is None else keys))


def group_id(df: DataFrame, cols: Sequence[str], id: str, out: str = "group_id",
             decimals: int | None = None) -> DataFrame:
    """A stable id per distinct vector: the smallest row id in the group."""
    with_min = group_facts(df, cols, {"_first": F.min(id)}, size=None, decimals=decimals)
    return with_min.withColumn(out, F.coalesce(F.col("_first"), F.col(id))).drop("_first")


def label_mix(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """How the rows of repeated vectors are labelled."""
    return (is_duplicate(df.select(*cols, label), cols).filter("is_dup")
            .groupBy(label).agg(F.count("*").alias("n")))


def gap_pattern(cols: Sequence[str]) -> Column:
    """Which columns are NULL, as a number: a hash passes over NULLs, so this is a part of a hashed key."""
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") * F.lit(1 << (i % 62)) for i, c in enumerate(cols)])


HASHED = ["_gaps", "_h", "_g"]


def hashed_key(cols: Sequence[str]) -> list[Column]:
    """A vector as two hashes of 64 bits and the pattern of its NULLs."""
    return [gap_pattern(cols).alias("_gaps"), F.xxhash64(F.lit(1), *cols).alias("_h"), F.xxhash64(F.lit(2), *reversed(list(cols))).alias("_g")]


def near_duplicates(df: DataFrame, cols: Sequence[str], decimals: Sequence[int] = (3, 2, 1, 0)) -> DataFrame:
    """Rows sharing their vector after rounding, for each number of places.

    A vector travels as two hashes of 64 bits and the pattern of its NULLs.
    """
    exploded = df.select(*cols, F.explode(F.array(*[F.lit(d) for d in decimals])).alias("decimals"))
    scale = F.pow(F.lit(10.0), F.col("decimals"))
    vector = exploded.select("decimals", *[(F.rint(F.col(c) * scale) / scale + F.lit(0.0)).alias(c) for c in cols])
    counted = vector.select("decimals", *hashed_key(cols)).groupBy("decimals", *HASHED).agg(F.count("*").alias("n"))
    return counted.groupBy("decimals").agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("n_groups"))


def split_groups(df: DataFrame, cols: Sequence[str], fold: str, decimals: int | None = 4, hashed: bool = False) -> DataFrame:
    """Duplicate groups that straddle folds; must be empty.

    With ``hashed`` a group is named by ``hashed_key`` of its vector, and only that travels.
    """
    rows, by, places = df.select(*cols, fold), cols, decimals
    if hashed:
        rows, by, places = df.select(*rounded(cols, decimals), fold).select(*hashed_key(cols), fold), HASHED, None
    return (groups(rows, by, places,
                   {"first_fold": F.min(fold), "last_fold": F.max(fold)})
            .filter("first_fold <> last_fold"))


def assert_no_group_leakage(df: DataFrame, cols: Sequence[str], fold: str, decimals: int | None = 4) -> None:
    bad = split_groups(df, cols, fold, decimals)
    if not bad.isEmpty():
        raise AssertionError("a duplicate group straddles a fold boundary")
