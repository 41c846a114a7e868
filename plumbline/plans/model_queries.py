"""Queries that fit models: rankings, baselines, formulas, ablations, target model, anomaly scores.

They call the operators with their default sizes, on five folds and all feature sets.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import benchmark, crossfit, features, fits, folds, metrics, models, ranking, reference, stats, trees
from plumbline.plans.feature_queries import _catalog_sql as catalog_sql
from plumbline.plans.feature_queries import feature_catalog
from plumbline.plans.registry import ROLES, bench, query, test, train
from plumbline.sources import sinks
from plumbline.sources.shared import settled

OPS, SENSORS, M, NUM = list(ROLES.settings), ROLES.all_sensors, ROLES.measurements, ROLES.numeric
# features of a ranking that make up its compact set
COMPACT = 15


def folded_train(spark, sf_dir, k=5):
    df = folds.group_kfold(train(spark, sf_dir), M, k)
    return df.withColumn("invalid", features.is_invalid(ROLES))


def folded_valid(spark, sf_dir, k=5):
    return features.valid_rows(folded_train(spark, sf_dir, k), ROLES)


def engineered(spark, sf_dir, k=5):
    base = folded_train(spark, sf_dir, k)
    df = features.engineer(base, ROLES)
    return df, features.engineered_names(base, df)


_RANKED: dict[tuple[str, str], dict] = {}


def rankings(spark, sf_dir):
    """Both feature rankings, settled once per session and source folder: several queries read them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RANKED:
        df, names = engineered(spark, sf_dir)
        _RANKED[key] = ranking.rank_targets(df, [*M, *names], {"ref": False, "invalid": True}, "test_id")
    return _RANKED[key]


def all_sets(spark, sf_dir, names):
    """All feature sets; the compact ones are the best of the rankings for either target."""
    tables = rankings(spark, sf_dir)
    return features.feature_sets(names, ROLES, *[[r["feature"] for r in tables[y].limit(COMPACT).collect()] for y in ("ref", "invalid")])


@query()
def polynomial_grid(spark, sf_dir):
    return benchmark.poly_grid(folded_valid(spark, sf_dir), OPS, "ref", "fold")


@query()
def ridge_feature_sets(spark, sf_dir):
    df, names = engineered(spark, sf_dir)
    return benchmark.model_comparison(benchmark.ridge_matrix(df, all_sets(spark, sf_dir, names), "ref", "fold"))


@query()
def regression_baselines(spark, sf_dir):
    df, names = engineered(spark, sf_dir)
    sets, rows = all_sets(spark, sf_dir, names), settled(features.valid_rows(df, ROLES), "valid")
    return benchmark.model_comparison(benchmark.tree_matrix(rows, sets, "ref", "test_id", "fold"),
                                      benchmark.elastic_matrix(rows, sets, "ref", "fold", 0.1, 0.5),
                                      benchmark.constant_matrix(rows, sets, "ref", "fold"))


@query()
def classification_baselines(spark, sf_dir):
    df, names = engineered(spark, sf_dir)
    sets, rows = all_sets(spark, sf_dir, names), settled(df, "engineered")
    return benchmark.model_comparison(benchmark.tree_matrix(rows, sets, "invalid", "test_id", "fold", classify=True),
                                      benchmark.logistic_matrix(rows, sets, "invalid", "fold"),
                                      benchmark.constant_matrix(rows, sets, "invalid", "fold", classify=True))


@query()
def formula_comparison(spark, sf_dir):
    return benchmark.compare_formulas(folded_train(spark, sf_dir), M, "ref", "test_id", "fold")


@query()
def ablations(spark, sf_dir):
    df = folded_train(spark, sf_dir).withColumn("_score", (F.col("label") == "Valid") & F.col("s4").isNotNull())
    ok = F.col("label") == "Valid"
    cfg = {"all_rows": {"inputs": OPS, "degree": 4}, "valid_rows": {"inputs": OPS, "degree": 4, "train": ok},
           "with_s4": {"inputs": [*OPS, "s4"], "degree": 2, "train": ok}, "without_s4": {"inputs": OPS, "degree": 2, "train": ok},
           "without_duration": {"inputs": OPS[:3], "degree": 4, "train": ok},
           **{f"degree_{d}": {"inputs": OPS, "degree": d, "train": ok} for d in (2, 3, 5)}}
    return benchmark.ablate(df, cfg, "ref", "fold")


@query()
def regression_feature_ranking(spark, sf_dir):
    return rankings(spark, sf_dir)["ref"]


@query()
def classification_feature_ranking(spark, sf_dir):
    return rankings(spark, sf_dir)["invalid"]


@query()
def permutation_importance(spark, sf_dir):
    data = trees.bin_table(folded_valid(spark, sf_dir).dropna(subset=M), OPS, ["ref"], "test_id")
    try:
        forest = trees.grow_forests(data, [trees.Job(data.at(OPS))])[0]
        return ranking.permutation_importance_of_trees(data, forest, OPS)
    finally:
        data.unpersist()


# a fixed line stands in for a fitted model, so that SQL can repeat the shuffle
LINE = {"voltage": 0.4, "current_a": 0.3, "ambient": 0.25, "duration": 0.05}


def _permutation_sql():
    line = " + ".join(f"{w}e0 * {c}" for c, w in LINE.items())
    drops = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, r, 1 - sum(pow(ref - (p + {w}e0 * (z_{c} - {c})), 2)) / any_value(sst) AS r2,
        1 - sum(pow(ref - p, 2)) / any_value(sst) AS base FROM m GROUP BY r""" for c, w in LINE.items())
    return f"""WITH v AS (SELECT *, {line} AS p, row_number() OVER (ORDER BY test_id, ref) - 1 AS i, count(*) OVER () AS n,
            var_pop(ref) OVER () * count(*) OVER () AS sst FROM bench WHERE split = 'train' AND label = 'Valid'),
        m AS (SELECT a.*, r, {', '.join(f'b.{c} AS z_{c}' for c in LINE)} FROM v AS a, (SELECT unnest(range(10)) AS r) AS k
            JOIN v AS b ON b.i = (a.i + 1 + ((a.n - 1) * (r + 1) // 11) % (a.n - 1)) % a.n),
        d AS ({drops})
        SELECT feature, round(avg(base - r2), 8) AS importance, round(stddev_pop(base - r2), 8) AS std FROM d GROUP BY feature"""


@query(_permutation_sql())
def permutation_importance_of_a_line(spark, sf_dir):
    rows = features.valid_rows(train(spark, sf_dir), ROLES)

    def predict(x):
        return sum((F.get(x, F.lit(i)) * w for i, w in enumerate(LINE.values())), F.lit(0.0))

    out = ranking.permutation_importance(rows, predict, list(LINE), "ref", "test_id", order=[F.col("test_id"), F.col("ref")])
    return out.select("feature", F.round("importance", 8).alias("importance"), F.round("std", 8).alias("std"))


@query()
def huber_coefficients(spark, sf_dir):
    fitted, scale = fits.huber_fits(bench(spark, sf_dir), OPS, "ref", [fits.Model(tuple(range(len(OPS))))])[0]
    return spark.createDataFrame([(c, float(v)) for c, v in zip(["intercept", *OPS, "scale"], [*fitted, scale])],
                                 "term string, coefficient double")


# --- fitted models that SQL can repeat -----------------------------------------------------------------
STUMPS = ["ambient", "duration"]  # few distinct values, so that every one of them is a bin


def _stumps_sql(rounds: int = 2, step: float = 0.1):
    cells = " UNION ALL ".join(f"SELECT {i} AS i, {c} AS x, g FROM {{0}}" for i, c in enumerate(STUMPS))
    parts = ["v AS (SELECT ambient, duration, ref FROM bench WHERE split = 'train' AND label = 'Valid')",
             "r0 AS (SELECT *, ref - avg(ref) OVER () AS g FROM v)"]
    for k in range(rounds):
        parts += [f"c{k} AS ({cells.format(f'r{k}')})",
                  f"""s{k} AS (SELECT i, x AS cut, sum(sum(g)) OVER below AS gl, sum(count(*)) OVER below AS nl, sum(sum(g)) OVER (PARTITION BY i) AS g,
            sum(count(*)) OVER (PARTITION BY i) AS n FROM c{k} GROUP BY i, x WINDOW below AS (PARTITION BY i ORDER BY x))""",
                  f"""b{k} AS (SELECT i, cut, {step} * gl / nl AS low, {step} * (g - gl) / (n - nl) AS high FROM s{k} WHERE nl < n
            ORDER BY gl * gl / nl + (g - gl) * (g - gl) / (n - nl) DESC, i, cut LIMIT 1)""",
                  f"""r{k + 1} AS (SELECT r.* EXCLUDE (g), g - CASE WHEN CASE WHEN i = 0 THEN ambient ELSE duration END <= cut
            THEN low ELSE high END AS g FROM r{k} AS r, b{k})"""]
    names = f"[{', '.join(repr(c) for c in STUMPS)}]"
    rows = " UNION ALL ".join(f"SELECT {k} AS round, {names}[i + 1] AS feature, cut, low, high FROM b{k}" for k in range(rounds))
    return f"""WITH {', '.join(parts)} SELECT CAST(round AS INTEGER) AS round, feature, round(cut, 9) AS cut, round(low, 8) AS low,
        round(high, 8) AS high FROM ({rows})"""


@query(_stumps_sql())
def boosted_stumps(spark, sf_dir):
    """The first two rounds of boosting with a single split each."""
    data = trees.bin_table(features.valid_rows(train(spark, sf_dir), ROLES), STUMPS, ["ref"], "test_id")
    try:
        model = trees.boost(data, [trees.Job(data.at(STUMPS))], rounds=2, depth=1)[0]
    finally:
        data.unpersist()
    rows = []
    for k, t in enumerate(model.trees):
        f = int(t.feature[0])
        rows.append((k, STUMPS[f], round(float(data.edges.upper[f][t.cut[0]]), 9), round(float(t.value[1]), 8), round(float(t.value[2]), 8)))
    return spark.createDataFrame(rows, "round int, feature string, cut double, low double, high double")


NET = (1.0, 0.1, 0.01)


def _net_sql(l1_ratio: float = 0.5, steps: int = 300):
    n = range(len(OPS))
    g = lambda i, j: f"g{min(i, j)}{max(i, j)}"
    facts = [f"corr({OPS[i]}, {OPS[j]}) AS g{i}{j}" for i in n for j in n if i < j]
    facts += [f"covar_pop({c}, ref) / stddev_pop({c}) AS t{i}, stddev_pop({c}) AS d{i}, avg({c}) AS m{i}" for i, c in enumerate(OPS)]
    free = [f"t{i} - " + " - ".join(f"{g(i, j)} * {'n' if j < i else 'w'}{j}" for j in n if j != i) for i in n]
    soft = [f"sign({z}) * greatest(abs({z}) - alpha * {l1_ratio}, 0) / (1 + alpha * {1 - l1_ratio}) AS n{i}" for i, z in enumerate(free)]
    rows = " UNION ALL ".join([f"SELECT alpha, '{c}' AS term, w{i} / d{i} AS coefficient FROM last" for i, c in enumerate(OPS)] +
                              [f"SELECT alpha, 'intercept', my - {' - '.join(f'w{i} / d{i} * m{i}' for i in n)} FROM last"])
    return f"""WITH k AS (SELECT {', '.join(facts)}, avg(ref) AS my FROM bench WHERE split = 'train' AND label = 'Valid'),
        last AS (SELECT * FROM (WITH RECURSIVE w AS (SELECT unnest([{', '.join(f'{a}e0' for a in NET)}]) AS alpha, 0 AS it,
            {', '.join(f'0e0 AS w{i}' for i in n)} UNION ALL SELECT alpha, it + 1, {', '.join(soft)} FROM w, k WHERE it < {steps})
            SELECT * FROM w WHERE it = {steps}), k)
        SELECT alpha, term, round(coefficient, 7) AS coefficient FROM ({rows})"""


@query(_net_sql())
def elastic_net_path(spark, sf_dir):
    """Elastic nets of three penalties from one pass of products, each started from the stronger one."""
    from plumbline.operators.gram import moments

    m = moments(features.valid_rows(train(spark, sf_dir), ROLES), OPS, ["ref"])
    path = fits.elastic_net_weights(*m.total("ref")[:2], NET, 0.5)
    return spark.createDataFrame([(a, t, round(float(v), 7)) for a, w in zip(NET, path) for t, v in zip(["intercept", *OPS], w)],
                                 "alpha double, term string, coefficient double")


def _by_fold(x: str, y: str) -> str:
    """Rows of each model, which leaves one of five folds out, with the input scaled over them."""
    return f"""v AS (SELECT m, {x} AS x, CAST({y} AS DOUBLE) AS y, abs(test_id) % 5 AS f FROM bench, (SELECT unnest(range(5)) AS m) WHERE split = 'train'
            AND abs(test_id) % 5 <> m),
        u AS (SELECT m, avg(x) AS mx, stddev_pop(x) AS dx, count(*) AS n, sum(y) AS ones FROM v GROUP BY m),
        z AS MATERIALIZED (SELECT m, (x - mx) / dx AS z, y, n, ones FROM v JOIN u USING (m))"""


def _huber_sql(steps: int = 60, epsilon: float = 1.35, alpha: float = 1e-4):
    solve = """(a.xx * a.vy - a.vx * a.xy) / (a.v * a.xx - a.vx * a.vx) AS w0, (a.v * a.xy - a.vx * a.vy) / (a.v * a.xx - a.vx * a.vx) AS w1"""
    parts = [f"""h0 AS (SELECT m, {solve}, (SELECT 0) AS s FROM (SELECT m, count(*) AS v, sum(z) AS vx, sum(z * z) + {alpha} AS xx, sum(y) AS vy,
        sum(z * y) AS xy FROM z GROUP BY m) AS a)""",
             "i0 AS (SELECT h.m, w0, w1, sqrt(avg((y - w0 - w1 * z) * (y - w0 - w1 * z))) AS s FROM h0 AS h JOIN z USING (m) GROUP BY h.m, w0, w1)"]
    for k in range(steps):
        parts.append(f"""a{k} AS (SELECT m, any_value(s) AS s, any_value(n) AS n, sum(v) AS v, sum(v * z) AS vx, sum(v * z * z) + {alpha} * any_value(s) AS xx,
            sum(v * y) AS vy, sum(v * z * y) AS xy, sum(r * r) FILTER (near) AS sq, count(*) FILTER (NOT near) AS far FROM (
            SELECT m, z, y, n, s, r, abs(r) <= {epsilon} * s AS near, CASE WHEN abs(r) <= {epsilon} * s THEN 1 ELSE {epsilon} * s / abs(r) END AS v
            FROM (SELECT m, z, y, n, s, y - w0 - w1 * z AS r FROM z JOIN i{k} USING (m))) GROUP BY m)""")
        parts.append(f"i{k + 1} AS MATERIALIZED (SELECT m, {solve}, sqrt(sq / (n - far * {epsilon ** 2})) AS s FROM a{k} AS a)")
    return f"""WITH {_by_fold('voltage', 'ref')}, {', '.join(parts)}
        SELECT CAST(m AS INTEGER) AS fold, round(w0 - w1 / dx * mx, 5) AS intercept, round(w1 / dx, 5) AS slope, round(s, 5) AS scale
        FROM i{steps} JOIN u USING (m)"""


def _arithmetic_folds(spark, sf_dir):
    return folds.group_kfold(train(spark, sf_dir), M, 5, key=F.abs("test_id")).withColumn("invalid", features.is_invalid(ROLES))


@query(_huber_sql())
def huber_lines(spark, sf_dir):
    """Huber lines of the target over the voltage, each without one fold, all from the same passes."""
    jobs = [fits.Model((0,), g) for g in range(5)]
    fitted = fits.huber_fits(_arithmetic_folds(spark, sf_dir), ["voltage"], "ref", jobs, "fold")
    return spark.createDataFrame([(g, round(float(w[0]), 5), round(float(w[1]), 5), round(s, 5)) for g, (w, s) in enumerate(fitted)],
                                 "fold int, intercept double, slope double, scale double")


def _logistic_sql(steps: int = 12):
    parts = ["i0 AS (SELECT m, 0e0 AS w0, 0e0 AS w1 FROM u)"]
    for k in range(steps):
        parts.append(f"""i{k + 1} AS MATERIALIZED (SELECT m, w0 + (hxx * g0 - hx * g1) / (h * hxx - hx * hx) AS w0, w1 + (h * g1 - hx * g0) / (h * hxx - hx * hx) AS w1 FROM (
            SELECT m, w0, w1, sum(e * p * (1 - p)) AS h, sum(e * p * (1 - p) * z) AS hx, sum(e * p * (1 - p) * z * z) + 1 AS hxx,
            sum(e * (y - p)) AS g0, sum(e * (y - p) * z) - w1 AS g1 FROM (SELECT m, w0, w1, z, y, 1 / (1 + exp(-w0 - w1 * z)) AS p,
            CASE WHEN y = 1 THEN n / (2 * ones) ELSE n / (2 * (n - ones)) END AS e FROM z JOIN i{k} USING (m)) GROUP BY m, w0, w1))""")
    return f"""WITH {_by_fold('ref', "label = 'Invalid'")}, {', '.join(parts)}
        SELECT CAST(m AS INTEGER) AS fold, round(w0 - w1 / dx * mx, 7) AS intercept, round(w1 / dx, 7) AS slope FROM i{steps} JOIN u USING (m)"""


@query(_logistic_sql())
def logistic_lines(spark, sf_dir):
    """Class-weighted logistic models of the label over the target, each without one fold, from the same passes."""
    jobs = [fits.Model((0,), g) for g in range(5)]
    fitted = fits.logistic_fits(_arithmetic_folds(spark, sf_dir), ["ref"], "invalid", jobs, "fold")
    return spark.createDataFrame([(g, round(float(w[0]), 7), round(float(w[1]), 7)) for g, w in enumerate(fitted)],
                                 "fold int, intercept double, slope double")


@query()
def target_model(spark, sf_dir):
    """Blend of polynomial and boosted trees on held-out rows: scores, weight, worst fold."""
    oof, *_ = reference.oof_candidates(folded_valid(spark, sf_dir), "fold", ROLES)
    oof = oof.select("fold", "ref", "p_poly", "p_trees")
    best = metrics.best_weight(metrics.blend_sweep(oof, "ref", "p_poly", "p_trees")).first()
    blend = F.lit(best["weight"]) * F.col("p_poly") + F.lit(1 - best["weight"]) * F.col("p_trees")
    parts = [metrics.regression_metrics(oof.withColumn("p", p), "ref", "p").withColumn("model", F.lit(name))
             for name, p in {"poly": F.col("p_poly"), "trees": F.col("p_trees"), "blend": blend}.items()]
    return sinks.stack(*parts).withColumn("weight", F.lit(best["weight"]))


_REFERENCES: dict[tuple[str, str], reference.ReferenceModel] = {}


def fitted_reference(spark, sf_dir):
    """The target model of the training table, fitted once per session and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REFERENCES:
        _REFERENCES[key] = reference.fit_reference(folded_valid(spark, sf_dir), "fold", ROLES)
    return _REFERENCES[key]


@query()
def target_predictions(spark, sf_dir):
    out = reference.predict_reference(test(spark, sf_dir), fitted_reference(spark, sf_dir))
    return out.agg(F.count("*").alias("n"), F.count_if(F.col("predicted").isNull() | F.isnan("predicted")).alias("n_bad"),
                   F.min("predicted").alias("min"), F.max("predicted").alias("max"), F.avg("predicted").alias("mean"),
                   F.count_if("clipped").alias("n_clipped"))


@query()
def extrapolation_stress(spark, sf_dir):
    model = fitted_reference(spark, sf_dir)
    rows = test(spark, sf_dir).select("test_id", *OPS)
    parts = [reference.extrapolation(rows, lambda d: reference.predict_reference(d, model), "test_id", c)
             .withColumn("column", F.lit(c)) for c in ("current_a", "voltage")]
    return sinks.stack(*parts)


_RESIDUALS: dict[tuple[str, str], crossfit.ResidualForests] = {}


def residual_forests(spark, sf_dir):
    """The forests of all sensors, folds and the whole training table, fitted once per session and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RESIDUALS:
        _RESIDUALS[key] = crossfit.fit_residual_forests(folded_train(spark, sf_dir), SENSORS, OPS, "test_id", "fold")
    return _RESIDUALS[key]


def _residual_rows(df, keys):
    cells = F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(f"residual_{s}").alias("r")) for s in SENSORS])
    return df.select(*keys, F.inline(cells)).groupBy("sensor", *keys).agg(
        F.count("r").alias("n"), F.avg(F.abs("r")).alias("mean_abs"), F.stddev_samp("r").alias("sigma"))


@query()
def cross_fitted_residuals(spark, sf_dir):
    """Residual of each sensor from the settings and the other sensors, by label."""
    return _residual_rows(residual_forests(spark, sf_dir).held_out(), ["label"])


@query()
def scoring_residuals(spark, sf_dir):
    """The same for the scoring table, from the forests of the whole training table."""
    return _residual_rows(residual_forests(spark, sf_dir).score(test(spark, sf_dir)), ["label"])


FITTED = [*[f"{kind}_{s}" for kind in ("residual", "abs_residual") for s in SENSORS], "isolation_score"]
_CATALOGS: dict = {}


def fitted_catalog(spark, sf_dir):
    """The catalog rows of the nine features that need a fitted model."""
    from plumbline.operators import anomaly, audit

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CATALOGS:
        forests = residual_forests(spark, sf_dir)
        lone = anomaly.fit_isolation(features.valid_rows(train(spark, sf_dir), ROLES), M, "test_id")
        tables = [df.withColumn("isolation_score", lone.decision()) for df in (forests.held_out(), forests.score(test(spark, sf_dir)))]
        _CATALOGS[key] = audit.catalog(*tables, FITTED).collect()  # nine rows
    return spark.createDataFrame(_CATALOGS[key], "feature string, n_missing_train long, n_missing_test long, mean double, std double, "
                                                 "min double, max double")


@query()
def fitted_feature_catalog(spark, sf_dir):
    return fitted_catalog(spark, sf_dir)


def _full_catalog_sql():
    whole = " AND ".join(f"{c} IS NOT NULL" for c in M)
    rows = "\nUNION ALL\n".join(
        f"""SELECT '{f}' AS feature, count(*) FILTER (split = 'train' AND NOT ({whole})) AS n_missing_train,
        count(*) FILTER (split = 'test' AND NOT ({whole})) AS n_missing_test, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
        CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, true AS fitted FROM bench""" for f in FITTED)
    return catalog_sql().replace("SELECT * FROM (", "SELECT *, false AS fitted FROM (") .replace("-- of bench", f"UNION ALL\n{rows}")


@query(_full_catalog_sql())
def full_feature_catalog(spark, sf_dir):
    """All 78 derived features. Of the nine fitted ones the moments stand in ``fitted_feature_catalog``; here
    they are NULL where they are there, so that SQL can check the rest."""
    rest = fitted_catalog(spark, sf_dir)
    there = F.col("mean").isNotNull() & F.col("std").isNotNull() & (F.col("min") <= F.col("mean")) & (F.col("mean") <= F.col("max"))
    rest = rest.withColumns({"fitted": there, **{c: F.lit(None).cast("double") for c in ("mean", "std", "min", "max")}})
    return feature_catalog(spark, sf_dir).withColumn("fitted", F.lit(False)).unionByName(rest)


def _agreeing_sql():
    filled = {c: f"coalesce({c}, (SELECT median({c}) FROM bench))" if c in SENSORS else c for c in M}
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(abs(corr({filled[c]}, ref)), 9) AS abs_r,
        round(abs(corr({c}, ref)), 9) AS complete FROM bench""" for c in M)


@query(_agreeing_sql())
def agreeing_correlations(spark, sf_dir):
    """Median-imputed and complete-case correlation with the target, side by side."""
    df = bench(spark, sf_dir)
    left = stats.rank_by_corr(models.impute(df, models.fit_median(df, SENSORS)), M, "ref")
    right = stats.rank_by_corr(df, M, "ref").withColumnRenamed("abs_r", "complete")
    return left.join(right, "column").select("column", F.round("abs_r", 9).alias("abs_r"), F.round("complete", 9).alias("complete"))


# --- anomaly scores, for comparison ------------------------------------------------------------------
@query()
def isolation_scores(spark, sf_dir):
    from plumbline.operators import anomaly

    df = anomaly.isolation_score(train(spark, sf_dir), M, "test_id", F.col("label") == "Valid")
    return df.groupBy("planted").agg(F.count("isolation_score").alias("n"), F.avg("isolation_score").alias("mean_score"),
                                     F.count_if(F.col("isolation_score") < 0).alias("n_flagged"))


@query()
def robust_covariance(spark, sf_dir):
    from plumbline.operators import anomaly

    ellipse = anomaly.fit_robust_cov(features.valid_rows(train(spark, sf_dir), ROLES), M)
    return train(spark, sf_dir).groupBy("planted").agg(
        F.count(ellipse.distance()).alias("n"), F.count_if(ellipse.outlier()).alias("n_flagged"))


@query()
def local_outliers(spark, sf_dir):
    from plumbline.operators import neighbours

    rows = features.valid_rows(train(spark, sf_dir), ROLES)
    return neighbours.local_outlier_factor(rows, M).groupBy("planted").agg(
        F.count("lof").alias("n"), F.avg("lof").alias("mean_lof"), F.max("lof").alias("max_lof"), F.count_if("outlier").alias("n_flagged"))
