"""Queries of column relationships and two-sample tests."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from plumbline.operators import stats
from plumbline.plans.registry import ROLES, bench, query, table, train, union_all
from plumbline.plans.sql_matrix import entry, moment_cte, normal_tail_sql, sweep_ctes, t_tail_sql

OPS, SENSORS, M, NUM = list(ROLES.settings), ROLES.all_sensors, ROLES.measurements, ROLES.numeric


def invalid():
    return F.col("label") == "Invalid"


def rounded(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


@query(union_all(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r FROM bench"
                 for a, b in combinations(NUM, 2)))
def pearson_matrix(spark, sf_dir):
    return rounded(stats.corr_matrix(bench(spark, sf_dir), NUM), ["r"], 9)


@query(union_all(f"SELECT label, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r FROM bench GROUP BY label"
                 for a, b in combinations(NUM, 2)))
def pearson_by_label(spark, sf_dir):
    return rounded(stats.corr_matrix(bench(spark, sf_dir), NUM, by=["label"]), ["r"], 9)


RANKED = ("(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0)")


@query(union_all(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(ra, rb), 9) AS r FROM (
       SELECT {RANKED.format(c=a)} AS ra, {RANKED.format(c=b)} AS rb FROM bench
       WHERE {a} IS NOT NULL AND {b} IS NOT NULL)""" for a, b in combinations(NUM, 2)))
def spearman_matrix(spark, sf_dir):
    out = stats.spearman_matrix(bench(spark, sf_dir), NUM, "test_id")
    return rounded(out, ["r"], 9)


@query(union_all(f"""SELECT "column", n, round(r, 9) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 5) AS t,
       round({t_tail_sql("(r * sqrt((n - 2) / (1 - r * r)))", "(n - 2)")}, 6) AS p
       FROM (SELECT '{c}' AS "column", corr({c}, ref) AS r, count(*) AS n FROM bench
             WHERE {c} IS NOT NULL AND ref IS NOT NULL)""" for c in M))
def target_correlation(spark, sf_dir):
    out = stats.feature_corr(bench(spark, sf_dir), M, "ref")
    return rounded(rounded(rounded(out, ["r"], 9), ["t"], 5), ["p"], 6)


@query(union_all(f"""SELECT "column", n, round(r, 9) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 5) AS t,
       round({t_tail_sql("(r * sqrt((n - 2) / (1 - r * r)))", "(n - 2)")}, 6) AS p
       FROM (SELECT '{c}' AS "column", corr({c}, CAST(label = 'Invalid' AS INTEGER)) AS r, count(*) AS n FROM bench
             WHERE {c} IS NOT NULL)""" for c in NUM))
def point_biserial(spark, sf_dir):
    out = stats.point_biserial(bench(spark, sf_dir), NUM, invalid())
    return rounded(rounded(rounded(out, ["r"], 9), ["t"], 5), ["p"], 6)


@query(union_all(f"""SELECT '{c}' AS "column", round(abs(corr({c}, ref)), 9) AS abs_r FROM bench""" for c in M))
def correlation_ranking(spark, sf_dir):
    return rounded(stats.rank_by_corr(bench(spark, sf_dir), M, "ref"), ["abs_r"], 9)


@query(f"""SELECT 's4' AS "column", round(greatest({", ".join(f"abs(corr(s4, {c}))" for c in NUM if c != "s4")}), 9)
       AS max_abs_r FROM bench""")
def unrelated_sensor(spark, sf_dir):
    return rounded(stats.irrelevance(bench(spark, sf_dir), "s4", [c for c in NUM if c != "s4"]), ["max_abs_r"], 9)


@query(union_all(f"""SELECT '{c}' AS "column", round(regr_r2(ref, {c}), 9) AS r2 FROM bench""" for c in M))
def straight_line_r2(spark, sf_dir):
    return rounded(stats.linear_r2(bench(spark, sf_dir), M, "ref"), ["r2"], 9)


def _poly_sql():
    parts = []
    for c in M:
        z = f"(({c} - m) / s)"
        ctes, _ = sweep_ctes("g", 4, [0, 1, 2])
        moments = moment_cte("g", f"""(SELECT {z} AS z1, {z} * {z} AS z2, {z} * {z} * {z} AS z3, ref FROM bench,
            (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM bench) WHERE {c} IS NOT NULL)""",
                             ["z1", "z2", "z3", "ref"], "covar_pop({a}, {b})")
        steps = [f"SELECT '{c}' AS \"column\", {d} AS degree, round(1 - x.m3_3 / g.m3_3, 8) AS r2 FROM g, g_{d} AS x"
                 for d in (1, 2, 3)]
        parts.append(f"SELECT * FROM (WITH {', '.join([moments, *ctes])} {' UNION ALL '.join(steps)})")
    return union_all(parts)


@query(_poly_sql())
def polynomial_r2(spark, sf_dir):
    return stats.poly_fit(bench(spark, sf_dir), M, "ref").select("column", "degree", F.round("r2", 8).alias("r2"))


@query(union_all(f"""SELECT '{c}' AS "column", CAST(point AS INTEGER) AS point, round(x, 8) AS x,
       round(b0 + b1 * x, 6) AS y FROM (SELECT point, lo + point * (hi - lo) / 49 AS x, b0, b1 FROM
       (SELECT min({c}) AS lo, max({c}) AS hi, regr_slope(ref, {c}) AS b1,
        regr_intercept(ref, {c}) AS b0 FROM bench), (SELECT unnest(range(50)) AS point))""" for c in M))
def straight_trend(spark, sf_dir):
    out = stats.trend_curve(bench(spark, sf_dir), M, "ref", degrees=(1,))
    return out.select("column", "point", F.round("x", 8).alias("x"), F.round("y", 6).alias("y"))


@query()
def trend_curves(spark, sf_dir):
    return stats.trend_curve(bench(spark, sf_dir), M, "ref")


def _bin_sql(c, n):
    terms = " + ".join(f"CAST({c}_q{i} > {c}_q{i - 1} AND {c}_q{i} < {c}_q{n} AND {c} > {c}_q{i} AS INTEGER)"
                       for i in range(1, n))
    return f"CASE WHEN {c} IS NOT NULL THEN {terms} END"


def _edges_sql(cols, n):
    return ", ".join(f"quantile_cont({c}, {i / n}) AS {c}_q{i}" for c in cols for i in range(n + 1))


def _mi_sql(c, other, extra):
    return f"""SELECT '{c}' AS "column", round(sum(n / t * ln(n * t / (nx * ny))), 8) AS mutual_info FROM (
       SELECT CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER () AS DOUBLE) AS t,
         CAST(sum(n) OVER (PARTITION BY bx) AS DOUBLE) AS nx, CAST(sum(n) OVER (PARTITION BY by_) AS DOUBLE) AS ny
       FROM (SELECT {_bin_sql(c, 10)} AS bx, {other} AS by_, count(*) AS n FROM bench,
             (SELECT {_edges_sql(extra, 10)} FROM bench) GROUP BY bx, by_)
       WHERE bx IS NOT NULL AND by_ IS NOT NULL)"""


@query(union_all(_mi_sql(c, _bin_sql("ref", 10), [c, "ref"]) for c in M))
def mutual_information_target(spark, sf_dir):
    return rounded(stats.mutual_info(bench(spark, sf_dir), M, "ref", 10), ["mutual_info"], 8)


@query(union_all(_mi_sql(c, "label", [c]) for c in M))
def mutual_information_label(spark, sf_dir):
    return rounded(stats.mutual_info(bench(spark, sf_dir), M, "label", 10, classes=True), ["mutual_info"], 8)


def _partial_sql():
    parts = []
    for s in SENSORS:
        names = [*OPS, s, "ref"]
        ctes, last = sweep_ctes("g", 6, [0, 1, 2, 3])
        moments = moment_cte("g", f"(SELECT * FROM bench WHERE {s} IS NOT NULL)", names, "corr({a}, {b})")
        parts.append(f"""SELECT * FROM (WITH {', '.join([moments, *ctes])}
            SELECT '{s}' AS "column", (SELECT count({s}) FROM bench) AS n,
            round({entry(4, 5)} / sqrt({entry(4, 4)} * {entry(5, 5)}), 8) AS partial_r FROM {last})""")
    return union_all(parts)


@query(_partial_sql())
def partial_correlation(spark, sf_dir):
    return rounded(stats.partial_corr(bench(spark, sf_dir), SENSORS, "ref", OPS), ["partial_r"], 8)


def _vif_sql(pair="sum({a} * {b})"):
    ctes, last = sweep_ctes("g", 8, range(8))
    there = " AND ".join(f"{c} IS NOT NULL" for c in M)
    moments = moment_cte("g", f"(SELECT * FROM bench WHERE {there})", M, pair)
    picks = union_all(f"""SELECT '{c}' AS "column", round(-g.{entry(i, i)} * x.{entry(i, i)}, 5) AS vif FROM g, {last} AS x"""
                      for i, c in enumerate(M))
    return f"WITH {', '.join([moments, *ctes])} SELECT * FROM ({picks})"


@query(_vif_sql())
def inflation_factors(spark, sf_dir):
    return rounded(stats.vif(bench(spark, sf_dir), M), ["vif"], 5)


@query(_vif_sql("covar_pop({a}, {b})"))
def inflation_factors_centred(spark, sf_dir):
    return rounded(stats.vif(bench(spark, sf_dir), M, intercept=True), ["vif"], 5)


@query()
def bootstrap_intervals(spark, sf_dir):
    return stats.bootstrap_corr(train(spark, sf_dir), M, "ref", "test_id")


@query(union_all(f"""SELECT '{c}' AS "column", count(r) AS folds, round(avg(r), 8) AS mean_r, round(stddev_pop(r), 8) AS std_r
       FROM (SELECT corr({c}, ref) AS r FROM bench GROUP BY abs(test_id) % 5)""" for c in M))
def correlation_stability(spark, sf_dir):
    df = bench(spark, sf_dir).withColumn("fold", (F.abs("test_id") % 5).cast("int"))
    return rounded(stats.corr_by_fold(df, M, "ref", "fold"), ["mean_r", "std_r"], 8)


SPLIT_SQL = """(SELECT count({c}) FILTER (label = 'Valid') AS n0, count({c}) FILTER (label = 'Invalid') AS n1,
       avg({c}) FILTER (label = 'Valid') AS m0, avg({c}) FILTER (label = 'Invalid') AS m1,
       var_{v}({c}) FILTER (label = 'Valid') AS v0, var_{v}({c}) FILTER (label = 'Invalid') AS v1 FROM bench)"""


@query(union_all(f"""SELECT '{c}' AS "column", n0, n1,
       round((m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2)), 8) AS cohens_d
       FROM {SPLIT_SQL.format(c=c, v="pop")}""" for c in NUM))
def effect_sizes(spark, sf_dir):
    return rounded(stats.cohens_d(bench(spark, sf_dir), NUM, invalid()), ["cohens_d"], 8)


@query(union_all(f"""SELECT "column", n0, n1, round(t, 6) AS t, round(dof, 4) AS dof, round({t_tail_sql("t", "dof")}, 6) AS p FROM (
       SELECT '{c}' AS "column", n0, n1, (m0 - m1) / sqrt(v0 / n0 + v1 / n1) AS t,
         pow(v0 / n0 + v1 / n1, 2) / (pow(v0 / n0, 2) / (n0 - 1) + pow(v1 / n1, 2) / (n1 - 1)) AS dof
       FROM {SPLIT_SQL.format(c=c, v="samp")})""" for c in NUM))
def welch_tests(spark, sf_dir):
    out = stats.welch_t(bench(spark, sf_dir), NUM, invalid())
    return rounded(rounded(out, ["t", "p"], 6), ["dof"], 4)


RANK_SUM_SQL = """(SELECT count(*) FILTER (label = 'Valid') AS n0, count(*) FILTER (label = 'Invalid') AS n1,
       sum(r) FILTER (label = 'Invalid') AS rs, sum(k * k - 1) AS ties FROM (SELECT label, """ \
    + RANKED + """ AS r, CAST(count(*) OVER (PARTITION BY {c}) AS DOUBLE) AS k FROM bench WHERE {c} IS NOT NULL))"""


@query(union_all(f"""SELECT '{c}' AS "column", n0, n1,
       round(greatest((rs - n1 * (n1 + 1) / 2e0) / (CAST(n0 AS DOUBLE) * n1),
             1 - (rs - n1 * (n1 + 1) / 2e0) / (CAST(n0 AS DOUBLE) * n1)), 9) AS auc
       FROM {RANK_SUM_SQL.format(c=c)}""" for c in NUM))
def single_column_auc(spark, sf_dir):
    return rounded(stats.univariate_auc(bench(spark, sf_dir), NUM, invalid()), ["auc"], 9)


@query(union_all(f"""SELECT "column", n0, n1, round(u, 3) AS u, round(z, 6) AS z,
       round(CASE WHEN z > 0 THEN {normal_tail_sql("z")} ELSE 1 END, 6) AS p FROM (
       SELECT "column", n0, n1, u, (greatest(u, a * b - u) - a * b / 2 - 0.5e0)
         / sqrt(a * b / 12 * ((a + b + 1) - ties / ((a + b) * (a + b - 1)))) AS z FROM (
       SELECT '{c}' AS "column", n0, n1, CAST(n0 AS DOUBLE) AS a, CAST(n1 AS DOUBLE) AS b, ties,
         CAST(n0 AS DOUBLE) * n1 - (rs - n1 * (n1 + 1) / 2e0) AS u FROM {RANK_SUM_SQL.format(c=c)}))""" for c in NUM))
def mann_whitney_tests(spark, sf_dir):
    out = stats.mann_whitney(bench(spark, sf_dir), NUM, invalid())
    return rounded(rounded(out, ["u"], 3), ["z", "p"], 6)


def _chi2_sql(name, flag, y, t):
    return f"""SELECT "column", n11, n10, n01, n00, round(chi2, 6) AS chi2, round({normal_tail_sql("sqrt(chi2)")}, 6) AS p FROM (
       SELECT '{name}' AS "column", *, CASE WHEN m = 0 THEN NULL ELSE n * pow(g - least(g, n / 2), 2) / m END AS chi2
       FROM (SELECT *, CAST(n00 + n01 + n10 + n11 AS DOUBLE) AS n, abs(CAST(n00 AS DOUBLE) * n11 - CAST(n01 AS DOUBLE) * n10) AS g,
         CAST(n00 + n01 AS DOUBLE) * (n10 + n11) * (n00 + n10) * (n01 + n11) AS m FROM (
       SELECT count(*) FILTER ({flag} AND {y}) AS n11, count(*) FILTER ({flag} AND NOT {y}) AS n10,
         count(*) FILTER (NOT {flag} AND {y}) AS n01, count(*) FILTER (NOT {flag} AND NOT {y}) AS n00 FROM {t})))"""


@query(union_all([_chi2_sql(f"miss_{c}", f"({c} IS NULL)", "(label = 'Invalid')", "bench") for c in SENSORS]
                 + [_chi2_sql("is_dup", "(k > 1)", "(label = 'Invalid')", f"""(SELECT label, count(*) OVER (
                    PARTITION BY {", ".join(M)}) AS k FROM bench)""")]))
def flag_association(spark, sf_dir):
    from plumbline.functions.rowwise import missing_flag
    from plumbline.operators.dedup import is_duplicate

    df = is_duplicate(bench(spark, sf_dir).select("label", *M), M)
    df = df.select("label", F.col("is_dup").cast("int").alias("is_dup"),
                   *[missing_flag(c).alias(f"miss_{c}") for c in SENSORS])
    return rounded(stats.chi2_2x2(df, [*[f"miss_{c}" for c in SENSORS], "is_dup"], invalid()), ["chi2", "p"])


@query(_chi2_sql("toxic", "(toxic = 1)", "(quality = 1)", "labels"))
def label_association(spark, sf_dir):
    return rounded(stats.chi2_2x2(table(spark, sf_dir, "labels"), ["toxic"], F.col("quality") == 1), ["chi2", "p"])


def _ks_sql(c, a, t):
    lam = "(ks * sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b)))"
    p = (f"CASE WHEN {lam} < 0.2 THEN 1e0 ELSE greatest(0e0, least(1e0, 2 * list_sum(list_transform(range(1, 101), "
         f"lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2e0 * k * k * {lam} * {lam}))))) END")
    return f"""SELECT "column", n_a, n_b, round(ks, 9) AS ks, round({p}, 6) AS p, {p} < 0.05 AS drift FROM (
       SELECT '{c}' AS "column", any_value(ta) AS n_a, any_value(tb) AS n_b, max(abs(ca / ta - cb / tb)) AS ks FROM (
       SELECT CAST(sum(a) OVER w AS DOUBLE) AS ca, CAST(sum(b) OVER w AS DOUBLE) AS cb,
         CAST(sum(a) OVER () AS BIGINT) AS ta, CAST(sum(b) OVER () AS BIGINT) AS tb FROM (
       SELECT {c} AS v, count(*) FILTER ({a}) AS a, count(*) FILTER (NOT ({a})) AS b FROM {t}
       WHERE {c} IS NOT NULL GROUP BY {c}) WINDOW w AS (ORDER BY v)))"""


@query(union_all(_ks_sql(c, "split = 'train'", "bench") for c in M))
def train_test_drift(spark, sf_dir):
    df = bench(spark, sf_dir)
    out = stats.ks_tables(df.filter("split = 'train'"), df.filter("split = 'test'"), M)
    return rounded(rounded(out, ["ks"], 9), ["p"], 6)


@query(_ks_sql("o_totalprice", "o_orderstatus = 'O'", "orders"))
def price_by_status_drift(spark, sf_dir):
    out = stats.ks_2samp(table(spark, sf_dir, "orders"), ["o_totalprice"], F.col("o_orderstatus") == "O")
    return rounded(rounded(out, ["ks"], 9), ["p"], 6)


@query(union_all(_ks_sql(c, "label = 'Valid'", "bench") for c in NUM))
def valid_invalid_drift(spark, sf_dir):
    out = stats.ks_2samp(bench(spark, sf_dir), NUM, F.col("label") == "Valid")
    return rounded(rounded(out, ["ks"], 9), ["p"], 6)
