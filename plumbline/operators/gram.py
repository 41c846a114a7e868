"""Sums of products of many columns in one pass, and the linear models solved from them.

Each task multiplies its Arrow batches with numpy and emits one small matrix per group; Spark adds
the matrices entry by entry. Every ridge or least-squares fit over any subset of the columns, any
penalty and any set of folds then comes from the same pass.
"""
from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rowwise import present


def exponents(n: int, degree: int) -> list[tuple[int, ...]]:
    """Powers of all monomials of ``n`` variables up to ``degree``, constant excluded, by degree."""
    every = [e for e in product(range(degree + 1), repeat=n) if 1 <= sum(e) <= degree]
    return sorted(every, key=lambda e: (sum(e), tuple(-x for x in e)))


@dataclass
class Moments:
    """Products of ``[1, terms…]`` with each other and with each target, per group and target.

    ``xx[g][t]`` covers the rows of group ``g`` where target ``t`` is present.
    """

    terms: list
    targets: list[str]
    xx: dict = field(default_factory=dict)
    xy: dict = field(default_factory=dict)
    yy: dict = field(default_factory=dict)

    def groups(self) -> list:
        return sorted({g for g, _ in self.xx}, key=str)

    def total(self, target: str, leave_out=None) -> tuple[np.ndarray, np.ndarray, float]:
        """Sums over all groups but one."""
        keys = [k for k in self.xx if k[1] == target and (leave_out is None or k[0] != leave_out)]
        size = len(self.terms) + 1
        return (sum((self.xx[k] for k in keys), np.zeros((size, size))),
                sum((self.xy[k] for k in keys), np.zeros(size)), sum((self.yy[k] for k in keys), 0.0))


def design(x: np.ndarray, powers: Sequence[tuple[int, ...]] | None) -> np.ndarray:
    """``[1, terms…]`` for a block of rows; the terms are the inputs or their monomials."""
    one = np.ones((len(x), 1))
    if powers is None:
        return np.concatenate([one, x], axis=1)
    pw = [np.ones_like(x)]
    for _ in range(max(max(p) for p in powers)):
        pw.append(pw[-1] * x)
    out = np.empty((len(x), len(powers) + 1))
    out[:, 0] = 1.0
    for j, p in enumerate(powers):
        used = [pw[e][:, v] for v, e in enumerate(p) if e]
        out[:, j + 1] = np.multiply.reduce(used) if used else 1.0
    return out


def moments(df: DataFrame, inputs: Sequence[str], targets: Sequence[str], powers: Sequence[tuple[int, ...]] | None = None,
            group: str | None = None) -> Moments:
    """One pass over ``df``: products of monomials of ``inputs`` (or of the inputs) with the targets.

    Rows with a NULL input are left out; a NULL target leaves the row out for that target only.
    ``group`` holds a small integer such as a fold.
    """
    inputs, targets = list(inputs), list(targets)
    d, m = len(inputs), len(targets)
    chosen = None if powers is None else [tuple(p) for p in powers]
    size = (d if chosen is None else len(chosen)) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(d + m)]
            g = batch.column(d + m).to_numpy(zero_copy_only=False)
            x = np.stack(cols[:d], axis=1) if d else np.empty((len(g), 0))
            y = np.stack(cols[d:], axis=1)
            seen = ~np.isnan(y)
            # rows with the same targets present share one product
            pattern = seen @ (1 << np.arange(m))
            full = np.concatenate([design(x, chosen), np.where(seen, y, 0.0)], axis=1)
            for gv in np.unique(g):
                for pt in np.unique(pattern[g == gv]):
                    rows = full[(g == gv) & (pattern == pt)]
                    key = (int(gv), int(pt))
                    acc[key] = acc.get(key, 0.0) + rows.T @ rows
        upper = np.triu_indices(size + m)
        for (gv, pt), mat in acc.items():
            n = len(upper[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, gv), pa.int64()), pa.array(np.full(n, pt), pa.int64()),
                 pa.array(upper[0], pa.int64()), pa.array(upper[1], pa.int64()), pa.array(mat[upper], pa.float64())],
                names=["g", "pt", "i", "j", "v"])

    base = present(df, inputs).select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)],
        *[F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(targets)],
        (F.lit(0) if group is None else F.col(group)).cast("long").alias("g")).filter("g is not null")
    entries = (base.mapInArrow(partial, "g long, pt long, i long, j long, v double")
               .groupBy("g", "pt", "i", "j").agg(F.sum("v").alias("v")).collect())
    mats: dict[tuple[int, int], np.ndarray] = {}
    for r in entries:
        mat = mats.setdefault((r["g"], r["pt"]), np.zeros((size + m, size + m)))
        mat[r["i"], r["j"]] = mat[r["j"], r["i"]] = r["v"]
    out = Moments(inputs if chosen is None else chosen, targets)
    for (g, pt), mat in mats.items():
        for t, name in enumerate(targets):
            if pt >> t & 1:
                key = (g, name)
                out.xx[key] = out.xx.get(key, 0.0) + mat[:size, :size]
                out.xy[key] = out.xy.get(key, 0.0) + mat[:size, size + t]
                out.yy[key] = out.yy.get(key, 0.0) + mat[size + t, size + t]
    return out


def solve_ridge(xx: np.ndarray, xy: np.ndarray, alpha: float, terms: Sequence[int] | None = None) -> np.ndarray:
    """Coefficients ``[intercept, terms…]`` of least squares with an L2 penalty.

    The penalty applies to terms scaled to unit population deviation and not to the intercept.
    ``terms`` picks columns (0-based, without the constant); the others get 0.
    """
    pick = np.arange(len(xy) - 1) if terms is None else np.asarray(list(terms), dtype=int)
    n = xx[0, 0]
    idx = pick + 1
    mean = xx[0, idx] / n
    cov = xx[np.ix_(idx, idx)] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov), 0.0))
    live = scale > 1e-12 * np.maximum(1.0, np.abs(mean))
    safe = np.where(live, scale, 1.0)
    corr = np.where(np.outer(live, live), cov / np.outer(safe, safe), 0.0)
    target = np.where(live, (xy[idx] / n - mean * xy[0] / n) / safe, 0.0)
    lhs = corr + (alpha / n) * np.eye(len(idx)) + np.diag(np.where(live, 0.0, 1.0))
    w = (np.linalg.solve(lhs, target) if alpha > 0 else np.linalg.lstsq(lhs, target, rcond=None)[0]) / safe
    out = np.zeros(len(xy))
    out[idx] = w
    out[0] = xy[0] / n - w @ mean
    return out


def sse_of(coef: np.ndarray, xx: np.ndarray, xy: np.ndarray, yy: float) -> float:
    """Squared error of coefficients over the rows the sums cover."""
    return float(yy - 2 * coef @ xy + coef @ xx @ coef)


def number(v: float) -> str:
    """A double literal in SQL text, exact."""
    return f"{float(v)!r}D"


def polynomial(columns: Sequence[str], powers: Sequence[tuple[int, ...]], coef: Sequence[float] | Sequence[str]) -> Column:
    """Nested evaluation of ``coef[0] + Σ coef[i]·monomial`` as one expression, without powers.

    Coefficients are numbers, or SQL expressions when they differ from row to row.
    """
    def nest(terms: Mapping[tuple[int, ...], str], cols: Sequence[str]) -> str:
        if not cols:
            return next(iter(terms.values()))
        by_power: dict[int, dict] = {}
        for e, v in terms.items():
            by_power.setdefault(e[0], {})[e[1:]] = v
        out = None
        for p in range(max(by_power), -1, -1):
            inner = nest(by_power[p], cols[1:]) if p in by_power else None
            if out is None:
                out = inner
            else:
                out = f"{out} * {cols[0]}" if inner is None else f"({out} * {cols[0]} + {inner})"
        return out

    values = [c if isinstance(c, str) else number(c) for c in coef]
    terms = {tuple([0] * len(columns)): values[0]}
    terms.update({tuple(p): c for p, c in zip(powers, values[1:])})
    return F.expr(nest(terms, [f"`{c}`" for c in columns]))


def polynomial_values(columns: Sequence[np.ndarray], powers: Sequence[tuple[int, ...]], coef: Sequence[float]) -> np.ndarray:
    """``polynomial`` of whole columns of numbers: the same operations in the same order, so the same digits."""
    def nest(terms: Mapping[tuple[int, ...], float], cols: Sequence[np.ndarray]):
        if not cols:
            return next(iter(terms.values()))
        by_power: dict[int, dict] = {}
        for e, v in terms.items():
            by_power.setdefault(e[0], {})[e[1:]] = v
        out = None
        for p in range(max(by_power), -1, -1):
            inner = nest(by_power[p], cols[1:]) if p in by_power else None
            if out is None:
                out = inner
            else:
                out = out * cols[0] if inner is None else out * cols[0] + inner
        return out

    terms = {tuple([0] * len(columns)): float(coef[0])}
    terms.update({tuple(p): float(c) for p, c in zip(powers, coef[1:])})
    with np.errstate(over="ignore", invalid="ignore"):
        return np.broadcast_to(nest(terms, columns), columns[0].shape)


def linear_errors(df: DataFrame, inputs: Sequence[str], target: str, weights: Mapping[str, Mapping[int, np.ndarray]],
                  powers: Sequence[tuple[int, ...]] | None = None, group: str | None = None) -> DataFrame:
    """Errors of many linear candidates in one pass: rows ``(candidate, fold, n, mae, sse, r2)``.

    ``weights[candidate][fold]`` holds the coefficients used for the rows of that fold. Each task sums
    errors per candidate and fold, so a few rows per task are shuffled.
    """
    inputs, names = list(inputs), list(weights)
    chosen = None if powers is None else [tuple(p) for p in powers]
    by_fold = {f: np.stack([weights[c][f] for c in names], axis=1) for f in weights[names[0]]}
    d = len(inputs)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(d + 2)]
            x, y, g = np.stack(cols[:d], axis=1), cols[d], cols[d + 1]
            for f in np.unique(g):
                on = g == f
                err = y[on][:, None] - design(x[on], chosen) @ by_fold[int(f)]
                sums = np.stack([np.abs(err).sum(0), (err * err).sum(0)])
                rest = np.array([[on.sum(), y[on].sum(), (y[on] ** 2).sum()]]).T * np.ones((1, len(names)))
                acc[int(f)] = acc.get(int(f), 0.0) + np.concatenate([sums, rest])
        for f, s in acc.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(np.full(len(names), f), pa.int64()), *[pa.array(v, pa.float64()) for v in s]],
                names=["candidate", "fold", "sae", "sse", "n", "sy", "syy"])

    base = present(df, [*inputs, target]).select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)],
        F.col(target).cast("double").alias("y"),
        (F.lit(0) if group is None else F.col(group)).cast("long").alias("g"))
    total = base.mapInArrow(partial, "candidate string, fold long, sae double, sse double, n double, sy double, "
                                     "syy double").groupBy("candidate", "fold").agg(
        *[F.sum(c).alias(c) for c in ("sae", "sse", "n", "sy", "syy")])
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return total.select("candidate", "fold", F.col("n").cast("long").alias("n"), (F.col("sae") / F.col("n")).alias("mae"),
                        "sse", (1 - F.col("sse") / F.nullif(sst, F.lit(0.0))).alias("r2"))
