"""SQL text for small dense linear algebra, used only to check results in the SQL engine.

A symmetric matrix is one row with a column per entry; each elimination step is one CTE.
"""
from __future__ import annotations

from collections.abc import Sequence


def entry(a: int, b: int) -> str:
    return f"m{a}_{b}"


def moment_cte(name: str, source: str, exprs: Sequence[str], agg: str, diagonal: str = "") -> str:
    """First CTE: all pairwise aggregates of the expressions. ``agg`` has places for two expressions."""
    cells = [agg.format(a=exprs[min(i, j)], b=exprs[max(i, j)]) + (diagonal if i == j else "")
             + f" AS {entry(i, j)}" for i in range(len(exprs)) for j in range(len(exprs))]
    return f"{name} AS (SELECT {', '.join(cells)} FROM {source})"


def sweep_ctes(name: str, size: int, pivots: Sequence[int]) -> tuple[list[str], str]:
    """Sweep the pivots out one after another; returns the CTEs and the last one's name.

    After sweeping every index the matrix holds the negative inverse; after sweeping all but the last,
    the last column holds regression coefficients and the corner the residual sum of squares.
    """
    out, prev = [], name
    for step, k in enumerate(pivots):
        cells = []
        for i in range(size):
            for j in range(size):
                d = f"{entry(k, k)}"
                if i == k and j == k:
                    e = f"-1e0 / {d}"
                elif i == k or j == k:
                    e = f"{entry(i, j)} / {d}"
                else:
                    e = f"{entry(i, j)} - {entry(i, k)} * {entry(k, j)} / {d}"
                cells.append(f"{e} AS {entry(i, j)}")
        cur = f"{name}_{step + 1}"
        out.append(f"{cur} AS (SELECT {', '.join(cells)} FROM {prev})")
        prev = cur
    return out, prev


def t_tail_sql(t: str, dof: str, steps: int = 4000) -> str:
    """Two-sided Student tail by Simpson's rule on the density, for comparison to a few places."""
    top = f"least(abs({t}), 40e0)"
    log_c = f"lgamma(({dof} + 1) / 2e0) - lgamma({dof} / 2e0) - 0.5e0 * ln({dof} * pi())"
    dens = f"exp({log_c} - ({dof} + 1) / 2e0 * ln(1 + pow({top} * i / {steps}, 2) / {dof}))"
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (f"greatest(0e0, 1 - 2 * list_sum(list_transform(range({steps + 1}), lambda i: {weight} * {dens})) "
            f"* {top} / {steps} / 3)")


def normal_tail_sql(z: str, steps: int = 4000) -> str:
    top = f"least(abs({z}), 40e0)"
    dens = f"exp(-0.5e0 * pow({top} * i / {steps}, 2)) / sqrt(2 * pi())"
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (f"greatest(0e0, 1 - 2 * list_sum(list_transform(range({steps + 1}), lambda i: {weight} * {dens})) "
            f"* {top} / {steps} / 3)")
