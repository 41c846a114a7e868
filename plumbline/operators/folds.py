"""Validation folds as a column. Assignment is a hash of the row or group, so it needs no shuffle."""
from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.dedup import gap_pattern, rounded
from plumbline.operators.ordered import class_rows, n_partitions
from plumbline.operators.skew import attach_packed, key_of
from plumbline.sources.shared import settled


def kfold(df: DataFrame, id: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled k-fold; every class is spread over the folds in proportion, in expectation."""
    return df.withColumn(out, F.pmod(F.xxhash64(F.col(id), F.lit(seed)), F.lit(k)).cast("int"))


def numbered(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), out: str = "_i", hashed: bool = True) -> DataFrame:
    """Number the rows of each class from 0 in the order of ``order``, whose first column is a hash of 64 bits.

    Even ranges of the hash number their rows separately and add the count of the lower ranges, so no
    class sits in one task. The numbers depend on the order alone, not on how many ranges there are.
    Without ``hashed`` the first column is any number, and its ranges come from a sketch of it.
    """
    n = n_partitions(df)
    marked = df.withColumns({f"_o{i}": c for i, c in enumerate(order)})
    if hashed:
        marked = marked.withColumn("_range", F.floor((F.col("_o0") / F.lit(2.0 ** 64) + 0.5) * n).cast("int"))
    else:
        place = F.col("_o0").cast("double")
        found = marked.agg(F.percentile_approx(place, [i / n for i in range(1, n)], max(1000, 10 * n))).first()[0]
        edges = F.array(*[F.lit(e) for e in sorted(set(found or [0.0]))])
        marked = marked.withColumn("_range", F.when(place.isNotNull(), F.size(F.filter(edges, lambda e: e < place))))
    part = [*by, "_range"]
    lower = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = marked.groupBy(*part).agg(F.count("*").alias("_m")).select(
        *[F.col(c).alias(f"_k_{c}") for c in part], F.coalesce(F.sum("_m").over(lower), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*part).orderBy(*[f"_o{i}" for i in range(len(order))])
    counted = marked.withColumn("_place", F.row_number().over(inside) - 1)
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in part]
    return counted.join(sizes, same).select(*df.columns, (F.col("_start") + F.col("_place")).alias(out))


def stratified_kfold(df: DataFrame, id: str, by: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled k-fold whose class counts differ by at most one between folds.

    Rows of a class are numbered in the order of a hash of their id; rows without a class are one more.
    """
    rows = numbered(df, [F.xxhash64(F.col(id), F.lit(seed)), F.col(id)], [by])
    return rows.withColumn(out, F.pmod("_i", F.lit(k)).cast("int")).drop("_i")


def group_kfold(df: DataFrame, cols: Sequence[str], k: int = 5, seed: int = 42, decimals: int | None = 4,
                key: Column | None = None, out: str = "fold") -> DataFrame:
    """Rows with the same measurement vector share a fold.

    The fold is a hash of the rounded vector, or ``key`` modulo ``k`` when the group is already known
    by a number.
    """
    group = F.xxhash64(*rounded(cols, decimals), F.lit(seed)) if key is None else key
    return df.withColumn(out, F.pmod(group, F.lit(k)).cast("int"))


# distinct class-count vectors of groups that are dealt out on the driver
MAX_VECTORS = 200_000


def deal_vectors(vectors: Sequence[tuple[tuple[int, ...], int]], k: int) -> dict[tuple[int, ...], tuple[int, list[int]]]:
    """Folds for groups of equal class counts: ``(counts, number of groups)`` to ``(dealt in turn, folds of the others)``.

    As many groups of a kind as fill whole turns go round all folds. The rest, largest kinds first, go
    one by one to the fold where the classes' shares stay most even; the smaller fold wins a tie.
    """
    total = [max(1, sum(v[c] * m for v, m in vectors)) for c in range(len(vectors[0][0]))] if vectors else []
    loads = [[0] * len(total) for _ in range(k)]
    out = {}
    for v, m in sorted(vectors, key=lambda e: (-sum(e[0]), e[0])):
        for load in loads:
            for c, n in enumerate(v):
                load[c] += n * (m // k)
        rest = []
        for _ in range(m % k):
            f = min(range(k), key=lambda f: (sum(loads[f][c] * n / total[c] ** 2 for c, n in enumerate(v)), f))
            rest.append(f)
            loads[f] = [a + n for a, n in zip(loads[f], v)]
        out[v] = m - m % k, rest
    return out


def stratified_group_kfold(df: DataFrame, cols: Sequence[str], by: str, k: int = 5, seed: int = 42, decimals: int | None = 4,
                           out: str = "fold") -> DataFrame:
    """Rows with the same measurement vector share a fold, and every class is spread evenly over the folds.

    Groups are told apart only by how many rows of each class they hold. Groups of equal counts are
    numbered in a hashed order and dealt by number, so the folds do not depend on partitions; only the
    table of distinct counts, of which there may be ``MAX_VECTORS``, reaches the driver. Rows without
    a class are one more class. A vector travels as two hashes of 64 bits and the pattern of its NULLs:
    one shuffle of them by ranges of the first counts the groups and numbers them in each range.
    """
    vector, keys = [f"_r_{c}" for c in cols], ["_h", "_g", "_gaps"]
    classes = sorted((r[0] for r in class_rows(df.select(by).distinct())), key=lambda c: (c is None, c))
    counts = [f"_n{i}" for i in range(len(classes))]
    hashed = df.withColumns(dict(zip(vector, rounded(cols, decimals)))).select(
        *df.columns, F.xxhash64(*vector, F.lit(seed)).alias("_h"), F.xxhash64(F.lit(2), *reversed(vector)).alias("_g"),
        gap_pattern(vector).alias("_gaps"))
    n = n_partitions(df)
    class_of = F.coalesce(*[F.when(F.col(by).eqNullSafe(F.lit(c)), F.lit(i)) for i, c in enumerate(classes)], F.lit(-1))
    cells = hashed.select(*keys, class_of.alias("_class")).mapInArrow(_counted, "_h long, _g long, _gaps long, _class int, _m long")
    place = F.least(F.floor((F.col("_h") / F.lit(2.0 ** 64) + 0.5) * n).cast("int"), F.lit(n - 1))
    marks = [F.sum(F.when(F.col("_class") == i, F.col("_m")).otherwise(0)).alias(c) for i, c in enumerate(counts)]
    found = (cells.withColumn("_range", place).repartitionById(n, F.col("_range"))
             .groupBy("_range", *keys).agg(*marks, F.sum("_m").alias("_n")))
    inside = Window.partitionBy("_range", *counts).orderBy(*keys)
    groups = settled(found.withColumn("_place", F.row_number().over(inside) - 1), "groups")
    sizes = settled(groups.groupBy(*counts, "_range").agg(F.count("*").alias("_m")), "sizes")
    kinds = sizes.groupBy(*counts).agg(F.sum("_m").alias("_m")).limit(MAX_VECTORS + 1).collect()
    if len(kinds) > MAX_VECTORS:
        raise ValueError(f"more than {MAX_VECTORS} different class counts of groups")
    dealt = deal_vectors([(tuple(r[c] for c in counts), r["_m"]) for r in kinds], k)
    table = df.sparkSession.createDataFrame([(*v, turns, rest) for v, (turns, rest) in dealt.items()],
                                            ", ".join([*[f"{c} long" for c in counts], "_turns long", "_rest array<int>"]))
    lower = Window.partitionBy(*counts).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = settled(sizes.withColumn("_start", F.coalesce(F.sum("_m").over(lower), F.lit(0))).join(F.broadcast(table), counts).drop("_m"), "starts")
    i = F.col("_start") + F.col("_place")
    fold = F.when(i < F.col("_turns"), F.pmod(i, F.lit(k))).otherwise(F.get("_rest", (i - F.col("_turns")).cast("int"))).cast("int")
    placed = groups.join(starts, [*counts, "_range"]).select(key_of(keys).alias("_key"), F.struct(fold.alias("_fold")).alias("_fact"), F.col("_n").alias("_size"))
    rows = hashed.select(*df.columns, key_of(keys).alias("_key"))
    return attach_packed(rows, placed, df.columns, ["_fold"]).withColumn(out, F.col("_fold")).drop("_fold")


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal cells counted in each batch, so that a group holding much of the table is few rows to shuffle."""
    for batch in batches:
        found = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([([], "count_all")])
        yield from found.rename_columns([*batch.schema.names, "_m"]).combine_chunks().to_batches()


def with_fold(df: DataFrame, folds: DataFrame, id: str) -> DataFrame:
    """Rows with the fold of a fold table, NULL where the table has none."""
    return df.join(folds, id, "left")


def unmatched(df: DataFrame, folds: DataFrame, id: str) -> DataFrame:
    """Rows without a fold; must be empty."""
    return df.join(folds, id, "left_anti")


def assert_all_matched(df: DataFrame, folds: DataFrame, id: str) -> None:
    if not unmatched(df, folds, id).isEmpty():
        raise AssertionError("some rows have no fold")


def split(df: DataFrame, k: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows of fold ``k``."""
    return df.filter(F.col(fold) != k), df.filter(F.col(fold) == k)


def fold_sizes(df: DataFrame, fold: str = "fold") -> DataFrame:
    return df.groupBy(fold).agg(F.count("*").alias("n")).orderBy(fold)
