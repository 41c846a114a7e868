"""Row-wise functions over a few columns of one row. All are plain Column expressions.

NULLs are skipped, as a row with some sensors missing still has a mean, a median and a spread.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_missing(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every column is there, as NULL tests that reach the scan."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])) if cols else df


def n_available(cols: Sequence[str]) -> Column:
    return reduce(add, [F.col(c).isNotNull().cast("int") for c in cols])


def n_missing(cols: Sequence[str]) -> Column:
    return reduce(add, [F.col(c).isNull().cast("int") for c in cols])


def missing_flag(c: str) -> Column:
    return F.col(c).isNull().cast("int")


def negative_flag(c: str) -> Column:
    return F.coalesce(F.col(c) < 0, F.lit(False)).cast("int")


def zero_flag(c: str) -> Column:
    return F.coalesce(F.col(c) == 0, F.lit(False)).cast("int")


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` with NULL for a zero denominator."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return a / F.nullif(b, F.lit(0.0))


def clip0(c: str) -> Column:
    return F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(0.0)))


def sqrt_clip(c: str) -> Column:
    return F.sqrt(clip0(c))


def log1p_clip(c: str) -> Column:
    return F.log1p(clip0(c))


def round_half_even(c: Column | str, decimals: int) -> Column:
    """Round to ``decimals`` places, ties to even, on the binary value scaled by a power of ten."""
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(10 ** decimals))
    return F.rint(c * scale) / scale


def clip_range(c: Column, low: Column, high: Column, pad: float = 0.2) -> Column:
    """Clip to ``[low, high]`` widened by ``pad`` times its length on each side."""
    margin = (high - low) * F.lit(pad)
    return F.greatest(F.least(c, high + margin), low - margin)


def row_sum(values: Sequence[Column]) -> Column:
    return reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values])


def largest(values: Sequence[Column]) -> Column:
    return F.greatest(*values) if len(values) > 1 else values[0]


def row_min(cols: Sequence[str]) -> Column:
    return F.least(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])


def row_max(cols: Sequence[str]) -> Column:
    return largest([F.col(c) for c in cols])


def row_range(cols: Sequence[str]) -> Column:
    return row_max(cols) - row_min(cols)


def row_mean(cols: Sequence[str]) -> Column:
    return row_sum([F.col(c) for c in cols]) / F.nullif(n_available(cols).cast("double"), F.lit(0.0))


def _median_of(values: Sequence[Column], n: Column) -> Column:
    ordered = F.sort_array(F.filter(F.array(*values), lambda v: v.isNotNull()))
    low = F.floor((n - 1) / 2).cast("int")
    high = F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(ordered, low) + F.get(ordered, high)) / 2)


def row_median(cols: Sequence[str]) -> Column:
    return _median_of([F.col(c) for c in cols], n_available(cols))


def row_mad(cols: Sequence[str], median: Column | None = None) -> Column:
    """Median absolute deviation from the row median, unscaled."""
    med = row_median(cols) if median is None else median
    return _median_of([F.abs(F.col(c) - med) for c in cols], n_available(cols))


def row_var(cols: Sequence[str], mean: Column | None = None) -> Column:
    """Sample variance; NULL with fewer than two values."""
    m = row_mean(cols) if mean is None else mean
    n = n_available(cols)
    squares = row_sum([(F.col(c) - m) * (F.col(c) - m) for c in cols])
    return F.when(n > 1, squares / (n - 1))


def row_std(cols: Sequence[str], mean: Column | None = None) -> Column:
    return F.sqrt(row_var(cols, mean))


def row_cv(cols: Sequence[str]) -> Column:
    return safe_ratio(row_std(cols), row_mean(cols))


def row_trimmed_mean(cols: Sequence[str]) -> Column:
    """Mean without one smallest and one largest value; plain mean of one or two values."""
    n = n_available(cols)
    ordered = F.sort_array(F.array(*[F.col(c) for c in cols]), asc=False)
    inner = [F.when(n - 2 >= i, F.get(ordered, F.lit(i))) for i in range(1, max(2, len(cols) - 1))]
    return F.when(n > 2, row_sum(inner) / (n - 2)).otherwise(row_mean(cols))


def deviation(c: str, median: Column) -> Column:
    return F.col(c) - median


def max_abs_deviation(cols: Sequence[str], median: Column) -> Column:
    return F.array_max(F.transform(F.array(*[F.col(c) for c in cols]), lambda v: F.abs(v - median)))


def n_outside_consensus(cols: Sequence[str], k: float = 2.0, median: Column | None = None,
                        mad: Column | None = None, std: Column | None = None) -> Column:
    """How many values lie more than ``k`` MADs from the row median.

    A zero MAD is replaced by 0.6745 times the row's standard deviation; if that is zero too, or the
    row has fewer than two values, the answer is 0.
    """
    med = row_median(cols) if median is None else median
    spread = row_mad(cols, med) if mad is None else mad
    std = row_std(cols) if std is None else std
    scale = F.when(spread != 0, spread).otherwise(std * F.lit(0.6745))
    outside = reduce(add, [
        F.coalesce(F.abs(F.col(c) - med) / F.nullif(scale, F.lit(0.0)) > F.lit(float(k)), F.lit(False))
        .cast("int") for c in cols])
    return F.when(n_available(cols) < 2, F.lit(0)).otherwise(outside)


def miss_pattern(cols: Sequence[str]) -> Column:
    """One bit per column, 1 where missing, in column order."""
    return F.concat(*[missing_flag(c).cast("string") for c in cols])


def fingerprint(cols: Sequence[str], decimals: int = 4, sentinel: float = -9e9) -> Column:
    """Text identity of a measurement: columns rounded, NULL as a sentinel, joined by ``|``.

    For export only; grouping uses the rounded columns themselves.
    """
    shape = f"decimal(38,{decimals})"
    return F.concat_ws("|", *[
        F.coalesce(round_half_even(c, decimals), F.lit(sentinel)).cast(shape).cast("string")
        for c in cols])


def arg_max_abs(cols: Sequence[str], names: Sequence[str] | None = None) -> Column:
    """Name of the column with the largest absolute value; NULLs skipped, first wins a tie."""
    names = list(names or cols)
    top = max_abs(cols)
    chain = F.when(F.abs(F.col(cols[0])) == top, F.lit(names[0]))
    for c, name in zip(cols[1:], names[1:]):
        chain = chain.when(F.abs(F.col(c)) == top, F.lit(name))
    return chain


def max_abs(cols: Sequence[str]) -> Column:
    return largest([F.abs(F.col(c)) for c in cols])
