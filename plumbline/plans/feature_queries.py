"""Queries of derived features, folds, joins, simple transforms and linear fits."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from plumbline.operators import audit, features, folds, gram, metrics, models, stats
from plumbline.plans.registry import ROLES, bench, query, table, test, train, union_all
from plumbline.plans.sql_matrix import entry, moment_cte, sweep_ctes
from plumbline.sources import sinks, tables
from plumbline.sources.shared import settled, shared_folder

OPS, SENSORS, M, NUM = list(ROLES.settings), ROLES.all_sensors, ROLES.measurements, ROLES.numeric
PAIRS = list(combinations(SENSORS, 2))


def rounded(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


# --- the same features in SQL ---------------------------------------------------------------------
ELECTRICAL_SQL = {
    "Power_VI": "voltage * current_a", "Energy_VIt": "voltage * current_a * duration",
    "I_squared": "current_a * current_a", "I2t": "current_a * current_a * duration",
    "V_squared": "voltage * voltage", "sqrt_t": "sqrt(greatest(duration, 0))",
    "log1p_t": "ln(1 + greatest(duration, 0))", "V_over_I": "voltage / nullif(current_a, 0)",
    "I_over_V": "current_a / nullif(voltage, 0)", "V_I_interact": "voltage * current_a",
    "V_t_interact": "voltage * duration", "I_t_interact": "current_a * duration",
    "T_I_interact": "ambient * current_a", "T_t_interact": "ambient * duration"}
STATS_SQL = {
    "sensor_mean": "mean", "sensor_median": "med", "sensor_min": "mn", "sensor_max": "mx",
    "sensor_range": "mx - mn", "sensor_std": "sd", "sensor_var": "vr", "sensor_mad": "mad",
    "sensor_cv": "sd / nullif(mean, 0)",
    "sensor_trimmed_mean": "CASE WHEN k > 2 THEN list_avg(sl[2:k - 1]) ELSE mean END",
    "n_sensors_available": "CAST(k AS INTEGER)", "n_sensors_missing": "CAST(4 - k AS INTEGER)"}
FLAGS_SQL = {**{f"miss_{s}": f"CAST({s} IS NULL AS INTEGER)" for s in SENSORS},
             **{f"neg_{s}": f"CAST(coalesce({s} < 0, false) AS INTEGER)" for s in SENSORS},
             **{f"zero_{s}": f"CAST(coalesce({s} = 0, false) AS INTEGER)" for s in SENSORS}}
PAIR_SQL = {k: v for a, b in PAIRS for k, v in (
    (f"diff_{a}_{b}", f"{a} - {b}"), (f"absdiff_{a}_{b}", f"abs({a} - {b})"), (f"ratio_{a}_{b}", f"{a} / nullif({b}, 0)"))}
CONSENSUS_SQL = {
    **{f"{s}_minus_ambient": f"{s} - ambient" for s in SENSORS},
    **{f"{s}_dev_from_median": f"{s} - med" for s in SENSORS},
    "max_dev_from_median": "greatest(" + ", ".join(f"abs({s} - med)" for s in SENSORS) + ")",
    "n_sensors_outside_consensus": """CASE WHEN k < 2 OR sc = 0 THEN 0 ELSE CAST(len(list_filter(sl,
       lambda x: abs(x - med) / sc > 2)) AS INTEGER) END"""}
# products and differences are the same bits in both engines; sums and logarithms agree to many places
EXACT = {*ELECTRICAL_SQL, *PAIR_SQL, *CONSENSUS_SQL, "sensor_median", "sensor_min", "sensor_max", "sensor_range",
         "sensor_mad"} - {"log1p_t"}
PLACES = 6
GROUP_SQL = {"is_exact_dup": "CAST(gs > 1 AS INTEGER)", "dup_group_size": "gs", "miss_pattern_code": "code"}
ALL_SQL = {**ELECTRICAL_SQL, **STATS_SQL, **FLAGS_SQL, **PAIR_SQL, **CONSENSUS_SQL, **GROUP_SQL}
INTEGERS = {"n_sensors_available", "n_sensors_missing", "n_sensors_outside_consensus", *FLAGS_SQL, *GROUP_SQL}

STAGES = f"""b0 AS (SELECT *, list_sort(list_filter([{", ".join(SENSORS)}], lambda x: x IS NOT NULL)) AS sl,
         concat({", ".join(f"CAST({s} IS NULL AS INTEGER)" for s in SENSORS)}) AS pattern,
         count(*) OVER (PARTITION BY split, {", ".join(M)}) AS gs FROM bench),
       codes AS (SELECT pattern, CAST(dense_rank() OVER (ORDER BY pattern) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT pattern FROM b0 WHERE split = 'train')),
       b1 AS (SELECT b0.*, code, len(sl) AS k, list_avg(sl) AS mean, (sl[(len(sl) + 1) // 2] + sl[(len(sl) + 2) // 2]) / 2 AS med, list_min(sl) AS mn,
         list_max(sl) AS mx, list_aggregate(sl, 'stddev_samp') AS sd, list_aggregate(sl, 'var_samp') AS vr
         FROM b0 LEFT JOIN codes USING (pattern)),
       b2 AS (SELECT *, (dl[(k + 1) // 2] + dl[(k + 2) // 2]) / 2 AS mad
         FROM (SELECT *, list_sort(list_transform(sl, lambda x: abs(x - med))) AS dl FROM b1)),
       b3 AS (SELECT *, CASE WHEN mad <> 0 THEN mad ELSE sd * 0.6745e0 END AS sc FROM b2)"""


def _features_sql(exprs, where="true"):
    cells = [f"{e} AS {k}" if k in INTEGERS | EXACT else f"round({e}, {PLACES}) AS {k}" for k, e in exprs.items()]
    return f"WITH {STAGES} SELECT test_id, {', '.join(cells)} FROM b3 WHERE {where} -- of bench"


def _rounded_features(df, names):
    return df.select("test_id", *[F.col(c) if c in INTEGERS | EXACT else F.round(c, PLACES).alias(c) for c in names])


@query(_features_sql(ELECTRICAL_SQL))
def electrical_features(spark, sf_dir):
    df = features.hstack(bench(spark, sf_dir), features.electrical(ROLES))
    return _rounded_features(df, features.electrical_names(ROLES))


@query(_features_sql(STATS_SQL))
def sensor_statistics(spark, sf_dir):
    return _rounded_features(features.row_features(bench(spark, sf_dir), ROLES), features.summary_names(SENSORS))


@query(_features_sql(PAIR_SQL))
def pairwise_features(spark, sf_dir):
    return _rounded_features(features.row_features(bench(spark, sf_dir), ROLES), PAIR_SQL)


@query(_features_sql(CONSENSUS_SQL))
def consensus_features(spark, sf_dir):
    return _rounded_features(features.row_features(bench(spark, sf_dir), ROLES), CONSENSUS_SQL)


@query(_features_sql(ALL_SQL, "split = 'train'"))
def engineered_table(spark, sf_dir):
    return _rounded_features(features.engineer(train(spark, sf_dir), ROLES), ALL_SQL)


def _catalog_sql():
    rows = []
    for k, e in ALL_SQL.items():
        rows.append(f"""SELECT '{k}' AS feature, count(*) FILTER (split = 'train' AND v IS NULL) AS n_missing_train,
            count(*) FILTER (split = 'test' AND v IS NULL) AS n_missing_test, round(avg(v) FILTER (split = 'train'), 4) AS mean,
            round(stddev_samp(v) FILTER (split = 'train'), 4) AS std, round(min(v) FILTER (split = 'train'), 4) AS min,
            round(max(v) FILTER (split = 'train'), 4) AS max FROM (SELECT split, CAST({e} AS DOUBLE) AS v FROM b3)""")
    return f"WITH {STAGES.replace('b3 AS (', 'b3 AS MATERIALIZED (')} SELECT * FROM ({union_all(rows)}) -- of bench"


@query(_catalog_sql())
def feature_catalog(spark, sf_dir):
    from plumbline.operators.bins import pattern_codes

    left, right = train(spark, sf_dir), test(spark, sf_dir)
    codes = pattern_codes(left, SENSORS)
    return audit.catalog(features.engineer(left, ROLES, codes), features.engineer(right, ROLES, codes), list(ALL_SQL))


def _set_sql():
    sets = {"all_raw": M, "ops_plus_electrical": [*OPS, *ELECTRICAL_SQL],
            "sensors_plus_consistency": [*SENSORS, *STATS_SQL, *PAIR_SQL, *CONSENSUS_SQL],
            "no_S4": [c for c in [*M, *ALL_SQL] if "s4" not in c]}
    rows = [f"""SELECT '{name}' AS feature_set, '{c}' AS "column", round(avg(CAST({ALL_SQL.get(c, c)} AS DOUBLE)), 5) AS mean
            FROM b3 WHERE split = 'test'""" for name in sets for c in sets[name]]
    return f"WITH {STAGES} SELECT * FROM ({union_all(rows)}) -- of bench"


@query(_set_sql())
def feature_set_means(spark, sf_dir):
    from plumbline.operators.bins import pattern_codes

    codes = pattern_codes(train(spark, sf_dir), SENSORS)
    df = features.engineer(test(spark, sf_dir), ROLES, codes)
    out = []
    for name in ("all_raw", "ops_plus_electrical", "sensors_plus_consistency", "no_S4"):
        x = features.prepare_x(df, features.feature_set(name, list(ALL_SQL), ROLES), ROLES)
        out.append(F.array(*[F.struct(F.lit(name).alias("feature_set"), F.lit(c).alias("column"),
                                      F.round(F.avg(c), 5).alias("mean")) for c in x.columns]))
    return df.agg(F.flatten(F.array(*out)).alias("rows")).select(F.inline("rows"))


# --- folds and joins ------------------------------------------------------------------------------
def folded(spark, sf_dir):
    """Rows with a fold that keeps duplicate copies together; copies share the absolute id."""
    return folds.group_kfold(bench(spark, sf_dir), M, 5, key=F.abs("test_id"))


@query("SELECT test_id, CAST(abs(test_id) % 5 AS INTEGER) AS fold FROM bench")
def fold_assignment(spark, sf_dir):
    return folded(spark, sf_dir).select("test_id", "fold")


@query("SELECT CAST(abs(test_id) % 5 AS INTEGER) AS fold, count(*) AS n FROM bench GROUP BY ALL")
def fold_sizes(spark, sf_dir):
    return folds.fold_sizes(folded(spark, sf_dir))


@query(f"""SELECT {", ".join(f"round_even({c}, 4) AS {c}" for c in M)}, count(*) AS n, min(fold) AS first_fold, max(fold) AS last_fold
       FROM (SELECT *, CAST(abs(test_id) % 7 % 2 + CAST(test_id < 0 AS INTEGER) AS INTEGER) AS fold FROM bench)
       GROUP BY {", ".join(f"round_even({c}, 4)" for c in M)} HAVING count(*) > 1 AND min(fold) <> max(fold)""")
def straddling_groups(spark, sf_dir):
    from plumbline.operators.dedup import split_groups

    # a fold that deliberately separates copies
    bad = bench(spark, sf_dir).withColumn(
        "fold", (F.abs("test_id") % 7 % 2 + (F.col("test_id") < 0).cast("int")).cast("int"))
    return split_groups(bad, M, "fold")


@query()
def hashed_group_folds(spark, sf_dir):
    from plumbline.operators.dedup import split_groups

    df = folds.group_kfold(bench(spark, sf_dir), M, 5)
    leaks = split_groups(df, M, "fold").agg(F.count("*")).scalar()
    return folds.fold_sizes(df).withColumn("straddling_groups", leaks)


@query("SELECT label, count(*) AS n, 5::BIGINT AS folds, 0::BIGINT AS straddling_groups, true AS within_one_group FROM bench GROUP BY label")
def stratified_group_folds(spark, sf_dir):
    """Every class is spread over the folds to within one group, and no group is split."""
    from plumbline.operators.dedup import HASHED, hashed_key, split_groups

    df = settled(folds.stratified_group_kfold(bench(spark, sf_dir).select("test_id", *M, "label"), M, "label", 5).drop("test_id"), "folds")
    vector = df.select(*[F.round(c, 4).alias(c) for c in M]).select(*hashed_key(M))
    largest = vector.groupBy(*HASHED).agg(F.count("*").alias("n")).agg(F.max("n")).scalar()
    per = df.groupBy("label", "fold").agg(F.count("*").alias("n"))
    leaks = split_groups(df, M, "fold", 4, hashed=True).agg(F.count("*")).scalar()
    return per.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("folds"), leaks.alias("straddling_groups"),
                                    (F.max("n") - F.sum("n") / 5 <= largest).alias("_high"),
                                    (F.sum("n") / 5 - F.min("n") <= largest).alias("_low")).select(
        "label", "n", "folds", "straddling_groups", (F.col("_high") & F.col("_low")).alias("within_one_group"))


@query("""SELECT CAST(fold AS INTEGER) AS fold, label, n // 5 + CAST(fold < n % 5 AS INTEGER) AS n
       FROM (SELECT label, count(*) AS n FROM bench GROUP BY label), (SELECT unnest(range(5)) AS fold)""")
def stratified_fold_counts(spark, sf_dir):
    df = folds.stratified_kfold(bench(spark, sf_dir), "test_id", "label", 5)
    return df.groupBy("fold", "label").agg(F.count("*").alias("n"))


@query()
def shuffled_fold_counts(spark, sf_dir):
    return folds.kfold(bench(spark, sf_dir), "test_id", 5).groupBy("fold", "label").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, o_custkey, CAST(c_custkey % 5 AS INTEGER) AS fold FROM orders LEFT JOIN customer
       ON o_custkey = c_custkey""")
def fold_join(spark, sf_dir):
    table_folds = folds.group_kfold(table(spark, sf_dir, "customer"), [], 5, key=F.col("c_custkey")).select(
        F.col("c_custkey").alias("o_custkey"), "fold")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return folds.with_fold(rows, table_folds, "o_custkey").select("o_orderkey", "o_custkey", "fold")


@query("""SELECT c_custkey FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_custkey % 7 <> 3)""")
def rows_without_match(spark, sf_dir):
    """Customers without an order, the orders of every seventh customer being taken away."""
    orders = table(spark, sf_dir, "orders").filter("o_custkey % 7 <> 3").select(F.col("o_custkey").alias("c_custkey"))
    return folds.unmatched(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey")


@query("""SELECT CAST(abs(test_id) % 5 = 2 AS BOOLEAN) AS held_out, label, count(*) AS n, round(avg(ref), 6) AS mean_ref
       FROM bench GROUP BY ALL""")
def fold_split(spark, sf_dir):
    left, right = folds.split(folded(spark, sf_dir), 2)
    parts = sinks.stack(left.withColumn("held_out", F.lit(False)), right.withColumn("held_out", F.lit(True)))
    return parts.groupBy("held_out", "label").agg(F.count("*").alias("n"), F.round(F.avg("ref"), 6).alias("mean_ref"))


@query("""SELECT test_id, label, CASE WHEN s1 IS NOT NULL AND s2 IS NOT NULL THEN s1 - s2 END AS score FROM bench""")
def partial_scores(spark, sf_dir):
    df = bench(spark, sf_dir).select("test_id", "label", "s1", "s2")
    scored = features.complete_cases(df, ["s1", "s2"]).select("test_id", (F.col("s1") - F.col("s2")).alias("score"))
    return df.select("test_id", "label").join(scored, "test_id", "left")


def _sides():
    return [c for c in M if c != "s4"], [c for c in M if c != "voltage"]


@query(f"""WITH a AS ({union_all(f"SELECT '{c}' AS feature, abs(corr({c}, ref)) AS abs_r FROM bench" for c in _sides()[0])}),
       b AS ({union_all(f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS DOUBLE) AS spread FROM bench" for c in _sides()[1])}),
       j AS (SELECT feature, abs_r, spread FROM a FULL JOIN b USING (feature)),
       r AS (SELECT *, CASE WHEN abs_r IS NOT NULL THEN rank() OVER (ORDER BY abs_r DESC NULLS LAST)
         + (count(*) OVER (PARTITION BY abs_r) - 1) / 2e0 END AS abs_r_rank,
         CASE WHEN spread IS NOT NULL THEN rank() OVER (ORDER BY spread DESC NULLS LAST)
         + (count(*) OVER (PARTITION BY spread) - 1) / 2e0 END AS spread_rank FROM j)
       SELECT feature, round(abs_r, 9) AS abs_r, spread, abs_r_rank, spread_rank,
         CASE WHEN abs_r_rank IS NULL THEN spread_rank WHEN spread_rank IS NULL THEN abs_r_rank
         ELSE (abs_r_rank + spread_rank) / 2 END AS mean_rank FROM r -- of bench""")
def aligned_rankings(spark, sf_dir):
    from plumbline.operators import ranking

    df, (left, right) = bench(spark, sf_dir), _sides()
    a = stats.rank_by_corr(df, left, "ref").select(F.col("column").alias("feature"), "abs_r")
    b = audit.distinct_counts(df, right).select(F.col("column").alias("feature"), F.col("n_distinct").cast("double").alias("spread"))
    out = ranking.mean_rank(ranking.with_ranks(ranking.align_scores(a, b), ["abs_r", "spread"]), ["abs_r", "spread"])
    return rounded(out, ["abs_r"], 9)


# --- transforms -----------------------------------------------------------------------------------
@query(f"""SELECT test_id, {", ".join(f"coalesce({s}, m_{s}) AS {s}" for s in SENSORS)} FROM bench,
       (SELECT {", ".join(f"round(median({s}), 9) AS m_{s}" for s in SENSORS)} FROM bench WHERE split = 'train') WHERE split = 'test'""")
def median_imputed(spark, sf_dir):
    medians = {c: round(m, 9) for c, m in models.fit_median(train(spark, sf_dir), SENSORS).items()}
    return models.impute(test(spark, sf_dir), medians).select("test_id", *SENSORS)


def _standardised_sql():
    # rows and their moments are worked out once each
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in M)
    cells = ", ".join(f"round(({c} - m_{c}) / d_{c}, 5) AS {c}_z" for c in M)
    return f"""WITH rows AS MATERIALIZED (SELECT test_id, {", ".join(M)} FROM bench), moments AS MATERIALIZED (SELECT {moments} FROM rows)
       SELECT test_id, {cells} FROM rows, moments"""


@query(_standardised_sql())
def standardised(spark, sf_dir):
    out = models.standardise(bench(spark, sf_dir), M)
    return rounded(out, [f"{c}_z" for c in M], 5).select("test_id", *[f"{c}_z" for c in M])


# the first term is the first scaled setting, whose sum is 0; 4 settings to degree 4 have 69 terms
@query("SELECT CAST(69 AS INTEGER) AS n_terms, 0e0 AS sum_first, round(sum(z * z), 3) AS sum_square FROM (SELECT (voltage - m) / s AS z "
       "FROM bench, (SELECT avg(voltage) AS m, stddev_pop(voltage) AS s FROM bench))")
def polynomial_terms(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    df = models.standardise(bench(spark, sf_dir), OPS)
    out = models.poly(df, [f"{c}_z" for c in OPS], 4)
    terms = vector_to_array("poly")
    return out.agg(F.max(F.size(terms)).alias("n_terms"), (F.round(F.sum(F.get(terms, F.lit(0))), 3) + 0.0).alias("sum_first"),
                   F.round(F.sum(F.get(terms, F.lit(1))), 3).alias("sum_square"))


def _spline_sql():
    # the four pieces of the cardinal cubic, s being the distance from a basis function's left end
    s = "(({c} - lo) / ((hi - lo) / 4) - {i} + 3)"
    piece = """CASE WHEN {s} >= 0 AND {s} < 1 THEN pow({s}, 3) / 6
       WHEN {s} >= 1 AND {s} < 2 THEN (-3 * pow({s}, 3) + 12 * pow({s}, 2) - 12 * {s} + 4) / 6
       WHEN {s} >= 2 AND {s} < 3 THEN (3 * pow({s}, 3) - 24 * pow({s}, 2) + 60 * {s} - 44) / 6
       WHEN {s} >= 3 AND {s} < 4 THEN pow(4 - {s}, 3) / 6 ELSE 0 END"""
    cells, ends = [], []
    for c in OPS:
        at = s.replace("lo", f"{c}_lo").replace("hi", f"{c}_hi")
        cells += [f"CASE WHEN {c} IS NOT NULL THEN round({piece.format(s=at.format(c=c, i=i))}, 8) + 0e0 END AS {c}_sp{i}" for i in range(7)]
        ends.append(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi")
    return f"SELECT test_id, {', '.join(cells)} FROM bench, (SELECT {', '.join(ends)} FROM bench)"


@query(_spline_sql())
def spline_basis(spark, sf_dir):
    out, names = models.spline_columns(bench(spark, sf_dir), OPS)
    return rounded(out, names, 8).select("test_id", *names)


# --- linear fits checked in SQL -------------------------------------------------------------------
def _linear_sql(alpha):
    """Coefficients by elimination on the moments of standardised columns."""
    names = [*M, "ref"]
    there = " AND ".join(f"{c} IS NOT NULL" for c in M)
    source = f"(SELECT * FROM bench WHERE {there})"
    ctes, last = sweep_ctes("g", 9, range(8))
    ridge = f" + {alpha}e0 / count(*)" if alpha else ""
    moments = moment_cte("g", source, names, "corr({a}, {b})", ridge)
    scale = f"sc AS (SELECT {', '.join(f'avg({c}) AS a_{c}, stddev_pop({c}) AS d_{c}' for c in names)} FROM {source})"
    w = {c: f"(x.{entry(i, 8)} * d_ref / d_{c})" for i, c in enumerate(M)}
    rows = [f"SELECT '{c}' AS term, round({w[c]}, 6) AS coefficient FROM {last} AS x, sc" for c in M]
    total = " + ".join(f"{w[c]} * a_{c}" for c in M)
    rows.append(f"SELECT 'intercept', round(a_ref - ({total}), 6) FROM {last} AS x, sc")
    return f"WITH {', '.join([moments, *ctes, scale])} SELECT * FROM ({union_all(rows)}) -- of bench"


def _coefficients(spark, names, coef):
    rows = [("intercept", float(coef[0])), *[(c, float(v)) for c, v in zip(names, coef[1:])]]
    return spark.createDataFrame(rows, "term string, coefficient double").withColumn("coefficient", F.round("coefficient", 6))


@query(_linear_sql(0))
def least_squares(spark, sf_dir):
    model = models.ols(bench(spark, sf_dir), M, "ref").stages[-1]
    return _coefficients(spark, M, [model.intercept, *model.coefficients.toArray()])


@query(_linear_sql(1))
def ridge_coefficients(spark, sf_dir):
    model = models.ridge(bench(spark, sf_dir), M, "ref", 1.0).stages[-1]
    return _coefficients(spark, M, [model.intercept, *model.coefficients.toArray()])


@query(_linear_sql(1))
def ridge_from_products(spark, sf_dir):
    m = gram.moments(bench(spark, sf_dir), M, ["ref"])
    xx, xy, _ = m.total("ref")
    return _coefficients(spark, M, gram.solve_ridge(xx, xy, 1.0))


@query("""SELECT 'label' AS target, label AS prediction FROM bench GROUP BY label
       QUALIFY row_number() OVER (ORDER BY count(*) DESC, label) = 1
       UNION ALL SELECT 'ref', CAST(round(median(ref), 6) AS DECIMAL(18, 6))::VARCHAR FROM bench""")
def constant_baselines(spark, sf_dir):
    df = bench(spark, sf_dir)
    value = models.dummy_reg(df, "ref").value
    rows = [("label", models.dummy_cls(df, "label").value), ("ref", f"{value:.6f}")]
    return spark.createDataFrame(rows, "target string, prediction string")


# --- metrics on a straight-line prediction --------------------------------------------------------
LINE = """line AS (SELECT bench.*, CAST(abs(test_id) % 5 AS INTEGER) AS fold, b * (current_a * current_a) + a AS p, current_a / 3e0 AS q
       FROM bench, (SELECT regr_slope(ref, current_a * current_a) AS b, regr_intercept(ref, current_a * current_a) AS a FROM bench
       WHERE label = 'Valid'))"""


def line_predicted(spark, sf_dir):
    from plumbline.operators.twin import fit_line_twin

    df = folded(spark, sf_dir)
    twin = fit_line_twin(df.filter("label = 'Valid'"), ["ref"], "current_a * current_a")
    return df.withColumns({"p": twin.expected("ref"), "q": F.col("current_a") / 3.0})


REG_SQL = """count(*) AS n, round(avg(abs(ref - p)), 8) AS mae, round(sqrt(avg(pow(ref - p, 2))), 8) AS rmse,
       round(1 - sum(pow(ref - p, 2)) / (var_pop(ref) * count(*)), 8) AS r2, round(max(abs(ref - p)), 8) AS max_error,
       round(median(abs(ref - p)), 8) AS median_ae"""
REG = ["mae", "rmse", "r2", "max_error", "median_ae"]


@query(f"WITH {LINE} SELECT {REG_SQL} FROM line -- of bench")
def regression_scores(spark, sf_dir):
    return rounded(metrics.regression_metrics(line_predicted(spark, sf_dir), "ref", "p"), REG, 8)


@query(f"WITH {LINE} SELECT fold, {REG_SQL} FROM line GROUP BY fold -- of bench")
def regression_scores_by_fold(spark, sf_dir):
    return rounded(metrics.regression_metrics(line_predicted(spark, sf_dir), "ref", "p", ["fold"]), REG, 8)


@query(f"""WITH {LINE}, f AS (SELECT avg(abs(ref - p)) AS mae, 1 - sum(pow(ref - p, 2)) / (var_pop(ref) * count(*)) AS r2
       FROM line GROUP BY fold) SELECT count(*) AS folds, round(avg(mae), 8) AS mae_mean, round(avg(r2), 8) AS r2_mean,
       round(stddev_pop(mae), 8) AS mae_std, round(stddev_pop(r2), 8) AS r2_std, round(max(mae), 8) AS mae_worst FROM f -- of bench""")
def fold_stability(spark, sf_dir):
    per_fold = metrics.regression_metrics(line_predicted(spark, sf_dir), "ref", "p", ["fold"], median=False)
    return rounded(metrics.fold_summary(per_fold), ["mae_mean", "r2_mean", "mae_std", "r2_std", "mae_worst"], 8)


CONFUSION = """count(*) FILTER (y AND h) AS tp, count(*) FILTER (NOT y AND h) AS fp, count(*) FILTER (y AND NOT h) AS fn,
       count(*) FILTER (NOT y AND NOT h) AS tn"""
D = "(CASE WHEN {b} = 0 THEN 0e0 ELSE ({a}) / CAST({b} AS DOUBLE) END)"
F1_SQL = D.format(a="2e0 * tp", b="(2 * tp + fp + fn)")
F0_SQL = D.format(a="2e0 * tn", b="(2 * tn + fp + fn)")
REC, SPEC = D.format(a="tp", b="(tp + fn)"), D.format(a="tn", b="(tn + fp)")
CLS = ["precision", "recall", "f1", "macro_f1", "balanced_accuracy", "mcc"]
CLS_SQL = f"""tp, fp, fn, tn, round({D.format(a="tp", b="(tp + fp)")}, 9) AS precision, round({REC}, 9) AS recall,
       round({F1_SQL}, 9) AS f1, round(({F1_SQL} + {F0_SQL}) / 2, 9) AS macro_f1, round(({REC} + {SPEC}) / 2, 9) AS balanced_accuracy,
       round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0e0 ELSE (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
         / (sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn)) END, 9) AS mcc"""


@query(f"""WITH {LINE}, c AS (SELECT fold, {CONFUSION} FROM (SELECT fold, label = 'Invalid' AS y, abs(ref - p) > 9 AS h FROM line)
       GROUP BY fold) SELECT fold, {CLS_SQL} FROM c -- of bench""")
def classification_scores(spark, sf_dir):
    df = line_predicted(spark, sf_dir)
    out = metrics.classification_metrics(df, F.col("label") == "Invalid", F.abs(F.col("ref") - F.col("p")) > 9, ["fold"])
    return rounded(out, CLS, 9)


@query(f"""WITH {LINE}, e AS (SELECT label = 'Invalid' AS y, abs(ref - p) AS s FROM line),
       r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2e0 AS r FROM e),
       t AS (SELECT s, count(*) AS n, count(*) FILTER (y) AS k FROM e GROUP BY s),
       c AS (SELECT k, sum(k) OVER w AS tp, sum(n) OVER w AS seen, sum(k) OVER () AS pos FROM t WINDOW w AS (ORDER BY s DESC))
       SELECT (SELECT round((sum(r) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2e0)
         / (CAST(count(*) FILTER (y) AS DOUBLE) * count(*) FILTER (NOT y)), 9) FROM r) AS roc_auc,
         (SELECT round(sum(CAST(k AS DOUBLE) / pos * tp / seen), 9) FROM c) AS average_precision -- of bench""")
def ranking_scores(spark, sf_dir):
    df = line_predicted(spark, sf_dir).select((F.col("label") == "Invalid").alias("y"),
                                              F.abs(F.col("ref") - F.col("p")).alias("s"))
    auc = metrics.roc_auc(df, F.col("y"), "s")
    ap = metrics.average_precision(df, F.col("y"), "s").scalar()
    return auc.select(F.round("roc_auc", 9).alias("roc_auc"), F.round(ap, 9).alias("average_precision"))


@query(f"""WITH {LINE}, c AS (SELECT threshold, {CONFUSION} FROM (SELECT threshold, label = 'Invalid' AS y,
         coalesce(abs(ref - p) > threshold, false) OR s1 IS NULL OR s2 IS NULL OR s3 IS NULL AS h
         FROM line, (SELECT unnest([3e0, 5e0, 8e0, 12e0]) AS threshold)) GROUP BY threshold)
       SELECT threshold, tp, fp, fn, tn, round({D.format(a="tp", b="(tp + fp)")}, 9) AS precision, round({REC}, 9) AS recall,
         round({F1_SQL}, 9) AS f1 FROM c -- of bench""")
def threshold_sweep(spark, sf_dir):
    from plumbline.functions.rowwise import any_missing

    df = line_predicted(spark, sf_dir).withColumn("score", F.abs(F.col("ref") - F.col("p")))
    out = metrics.threshold_sweep(df, F.col("label") == "Invalid", "score", (3.0, 5.0, 8.0, 12.0), any_missing(ROLES.sensors))
    return rounded(out, ["precision", "recall", "f1"], 9)


BLEND_SQL = """w AS (SELECT i / 20e0 AS weight FROM (SELECT unnest(range(21)) AS i)),
       s AS (SELECT weight, avg(abs(ref - (weight * p + (1 - weight) * q))) AS mae FROM line, w GROUP BY weight)"""


@query(f"WITH {LINE}, {BLEND_SQL} SELECT weight, round(mae, 8) AS mae FROM s -- of bench")
def blend_sweep(spark, sf_dir):
    return rounded(metrics.blend_sweep(line_predicted(spark, sf_dir), "ref", "p", "q"), ["mae"], 8)


@query(f"WITH {LINE}, {BLEND_SQL} SELECT weight, round(mae, 8) AS mae FROM s ORDER BY mae, weight LIMIT 1 -- of bench")
def best_blend(spark, sf_dir):
    out = metrics.best_weight(metrics.blend_sweep(line_predicted(spark, sf_dir), "ref", "p", "q"))
    return rounded(out, ["mae"], 8)


def _regime_sql(c):
    return f"""SELECT '{c}' AS "column", concat('tercile ', CAST(CAST({c} > q1 AS INTEGER) + CAST({c} > q2 AS INTEGER) AS VARCHAR)) AS regime,
       count(*) AS n, round(avg(abs(ref - p)), 8) AS mae FROM line,
       (SELECT quantile_cont({c}, {1 / 3}) AS q1, quantile_cont({c}, {2 / 3}) AS q2 FROM bench) GROUP BY regime"""


@query(f"""WITH {LINE} SELECT * FROM ({union_all([_regime_sql("current_a"), _regime_sql("voltage")])}
       UNION ALL SELECT 'ambient', CASE WHEN ambient <= 40 THEN '<= 40' ELSE '> 40' END AS regime, count(*), round(avg(abs(ref - p)), 8)
       FROM line GROUP BY regime) -- of bench""")
def error_by_regime(spark, sf_dir):
    from plumbline.operators.bins import error_by_regime as by_regime

    out = by_regime(line_predicted(spark, sf_dir), "ref", "p", ["current_a", "voltage"], {"ambient": 40.0})
    return rounded(out, ["mae"], 8)


@query("""SELECT o_orderpriority, n, mean_price, rank() OVER (PARTITION BY 1 ORDER BY mean_price DESC) AS rank FROM (
       SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY o_orderpriority)
       ORDER BY mean_price DESC, o_orderpriority LIMIT 3""")
def leaderboard(spark, sf_dir):
    board = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")).withColumn("task", F.lit(1))
    ranked = metrics.rank_within(board, "task", "mean_price", ascending=False).withColumn("rank", F.col("rank").cast("long"))
    return metrics.leaderboard(ranked, "mean_price", False, 3, "o_orderpriority").drop("task")


@query("""SELECT o_orderstatus, o_orderpriority, round(mean_price, 4) AS mean_price,
       rank() OVER (PARTITION BY o_orderstatus ORDER BY mean_price) AS rank FROM (
       SELECT o_orderstatus, o_orderpriority, avg(o_totalprice) AS mean_price FROM orders GROUP BY ALL)""")
def rank_within_task(spark, sf_dir):
    board = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.avg("o_totalprice").alias("mean_price"))
    ranked = metrics.rank_within(board, "o_orderstatus", "mean_price")
    return ranked.withColumns({"rank": F.col("rank").cast("long"), "mean_price": F.round("mean_price", 4)})


# --- reading back what was written ----------------------------------------------------------------
@query("SELECT CAST(abs(test_id) % 5 AS INTEGER) AS fold, count(*) AS n, CAST(sum(test_id % 1000) AS BIGINT) AS id_sum FROM bench GROUP BY fold")
def fold_table_round_trip(spark, sf_dir):
    """Folds built on first use, saved, and read back the second time."""
    path = f"{shared_folder(spark, 'folds')}/folds.csv"

    def build(df):
        return df.select("test_id", (F.abs("test_id") % 5).cast("int").alias("fold"))

    for _ in range(2):
        saved = tables.get_folds(bench(spark, sf_dir), path, build)
    return saved.groupBy("fold").agg(F.count("*").alias("n"), F.sum(F.col("test_id") % 1000).alias("id_sum"))


@query("SELECT o_orderkey, o_custkey, o_orderpriority, round(o_totalprice, 2) AS o_totalprice FROM orders")
def csv_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    path = f"{shared_folder(spark, 'csv')}/orders"
    sinks.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path).withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("SELECT test_id, label, s4 IS NULL AS missing, round(s4, 6) AS s4 FROM bench")
def json_round_trip(spark, sf_dir):
    """NULL fields are written too and come back as NULL."""
    rows = bench(spark, sf_dir).select("test_id", "label", "s4")
    path = f"{shared_folder(spark, 'json')}/rows"
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path).select(
        "test_id", "label", F.col("s4").isNull().alias("missing"), F.round("s4", 6).alias("s4"))


def _raises(check) -> bool:
    try:
        check()
    except AssertionError:
        return True
    return False


@query("""SELECT count(*) FILTER (label <> 'Valid') > 0 AS all_rows_refused, count(*) FILTER (label <> 'Valid' AND label = 'Valid') > 0
       AS valid_rows_refused, TRUE AS sensors_refused, FALSE AS settings_refused, count(*) FILTER (label = 'Valid') AS n_valid FROM bench""")
def input_guards(spark, sf_dir):
    rows = bench(spark, sf_dir)
    valid = features.valid_rows(rows, ROLES)
    return valid.agg(F.count("*").alias("n_valid")).select(
        F.lit(_raises(lambda: features.assert_valid_only(rows, ROLES))).alias("all_rows_refused"),
        F.lit(_raises(lambda: features.assert_valid_only(valid, ROLES))).alias("valid_rows_refused"),
        F.lit(_raises(lambda: features.assert_no_sensor(M, ROLES))).alias("sensors_refused"),
        F.lit(_raises(lambda: features.assert_no_sensor(OPS, ROLES))).alias("settings_refused"), "n_valid")


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) FILTER (split = 'train') AS n_train,
       count({c}) FILTER (split = 'test') AS n_test FROM bench""" for c in ["test_id", *M]))
def columns_in_common(spark, sf_dir):
    """Filled values of the columns that training rows share with test rows, which lack target and label."""
    left = train(spark, sf_dir).select("test_id", *M, "ref", "label")
    right = test(spark, sf_dir).select("test_id", *M)
    both = features.common_columns(left, right)
    counted = [df.agg(*[F.count(c).alias(c) for c in both]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in both]))) for df, name in ((left, "n_train"), (right, "n_test"))]
    return counted[0].join(counted[1], "column")
