"""Queries of the data-quality audit: loading, missing values, duplicates, outliers, profiles."""
from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import rowwise as rw
from plumbline.operators import audit, bins, dedup, features, ordered
from plumbline.plans.registry import ROLES, bench, query, table, test, train, union_all
from plumbline.sources import sinks, tables

OPS, SENSORS, M, NUM = list(ROLES.settings), ROLES.all_sensors, ROLES.measurements, ROLES.numeric
M_SQL = ", ".join(M)


# --- sources -------------------------------------------------------------------------------------
@query("""SELECT c_custkey, c_mktsegment,
       CASE WHEN c_acctbal >= 0 THEN round(sqrt(c_acctbal), 6) END AS root_balance FROM customer""")
def load_nan_as_null(spark, sf_dir):
    customer = tables.load_tables(spark, sf_dir, ["customer"])["customer"]
    rooted = customer.select("c_custkey", "c_mktsegment", F.sqrt("c_acctbal").alias("root_balance"))
    return tables.nan_to_null(rooted).withColumn("root_balance", F.round("root_balance", 6))


@query(union_all(f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype,
       count(*) FILTER ({c} IS NULL) AS n_missing FROM bench""" for i, (c, t) in enumerate(
    [("test_id", "bigint"), ("split", "string")] + [(c, "double") for c in NUM]
    + [("label", "string"), ("planted", "string")])))
def schema_and_missing(spark, sf_dir):
    df = bench(spark, sf_dir)
    return (tables.schema_profile(df).join(audit.missing(df).drop("pct_missing"), "column")
            .select("position", "column", "dtype", "n_missing"))


@query(union_all(
    [f"SELECT 'missing.{c}.n_missing' AS finding, CAST(count(*) FILTER ({c} IS NULL) AS VARCHAR) AS value FROM bench"
     for c in SENSORS]
    + [f"SELECT 'signs.{c}.n_{k}', CAST(count(*) FILTER ({c} {op} 0) AS VARCHAR) FROM bench"
       for c in SENSORS for k, op in (("negative", "<"), ("zero", "="))]
    + [f"""SELECT 'duplicates.{k}', CAST({e} AS VARCHAR) FROM (
       SELECT count(*) AS n FROM bench GROUP BY {M_SQL} HAVING count(*) > 1)"""
       for k, e in (("n_rows", "CAST(coalesce(sum(n), 0) AS BIGINT)"), ("n_groups", "count(*)"))]))
def findings(spark, sf_dir):
    df = bench(spark, sf_dir)
    return sinks.findings_long(missing=audit.missing(df, SENSORS).drop("pct_missing"),
                               signs=audit.sign_counts(df, SENSORS),
                               duplicates=dedup.duplicate_totals(df, M))


# --- projections, filters, predicates ------------------------------------------------------------
@query(f"SELECT test_id, {M_SQL}, CAST(label = 'Invalid' AS INTEGER) AS target FROM bench WHERE split = 'train'")
def role_columns(spark, sf_dir):
    df = train(spark, sf_dir)
    return df.select("test_id", *M, features.is_invalid(ROLES).alias("target"))


@query("SELECT test_id, ref FROM bench WHERE label = 'Valid'")
def valid_rows(spark, sf_dir):
    return features.valid_rows(bench(spark, sf_dir), ROLES).select("test_id", "ref")


@query("""SELECT test_id, s1, s2, s3, s4 FROM bench
       WHERE s1 IS NOT NULL AND s2 IS NOT NULL AND s3 IS NOT NULL AND s4 IS NOT NULL""")
def complete_cases(spark, sf_dir):
    return features.complete_cases(bench(spark, sf_dir), SENSORS).select("test_id", *SENSORS)


@query("SELECT label, count(*) AS n FROM bench WHERE s1 IS NULL OR s2 IS NULL OR s3 IS NULL GROUP BY label")
def any_sensor_missing(spark, sf_dir):
    return bench(spark, sf_dir).filter(rw.any_missing(ROLES.sensors)).groupBy("label").agg(
        F.count("*").alias("n"))


@query("SELECT test_id, " + ", ".join(
    [f"CAST({c} IS NULL AS INTEGER) AS miss_{c}" for c in SENSORS]
    + [f"CAST(coalesce({c} < 12, false) AS INTEGER) AS neg_{c}" for c in SENSORS]
    + [f"CAST(coalesce({c} = 12, false) AS INTEGER) AS zero_{c}" for c in SENSORS])
    + " FROM bench")
def indicator_flags(spark, sf_dir):
    # readings are shifted so that some fall below zero
    df = bench(spark, sf_dir).select("test_id", *[(F.col(c) - 12).alias(c) for c in SENSORS])
    return df.select("test_id", *[rw.missing_flag(c).alias(f"miss_{c}") for c in SENSORS],
                     *[rw.negative_flag(c).alias(f"neg_{c}") for c in SENSORS],
                     *[rw.zero_flag(c).alias(f"zero_{c}") for c in SENSORS])


@query("SELECT test_id, s1, s4 FROM bench WHERE split = 'test'")
def drop_constant_columns(spark, sf_dir):
    df = test(spark, sf_dir).select("test_id", "s1", F.lit(1.0).alias("always_one"), "s4",
                                    F.lit(None).cast("double").alias("never_there"))
    return audit.drop_constant(df, ["s1", "always_one", "s4", "never_there"])


@query("SELECT test_id, s1, s2, s3, s4 FROM bench")
def columns_by_pattern(spark, sf_dir):
    df = bench(spark, sf_dir)
    return df.select("test_id", *features.columns_like(df, prefixes=["s"], numeric=True))


@query(f"SELECT test_id, {M_SQL} FROM (SELECT * FROM bench WHERE split = 'test')")
def tolerant_input(spark, sf_dir):
    shuffled = test(spark, sf_dir).select(*sorted(["test_id", *M], reverse=True))
    return tables.align_schema(shuffled, ROLES)


# --- audit ---------------------------------------------------------------------------------------
@query(union_all(f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_missing,
       round(100e0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS pct_missing FROM bench""" for c in NUM))
def missing_counts(spark, sf_dir):
    return audit.missing(bench(spark, sf_dir), NUM)


@query(union_all(f"""SELECT label, '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_missing,
       round(100e0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS pct_missing
       FROM bench GROUP BY label""" for c in NUM))
def missing_by_label(spark, sf_dir):
    return audit.missing(bench(spark, sf_dir), NUM, by=["label"])


@query(union_all(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM bench"""
                 for c in [*NUM, "label"]))
def distinct_counts(spark, sf_dir):
    return audit.distinct_counts(bench(spark, sf_dir), [*NUM, "label"])


@query()
def distinct_counts_sketch(spark, sf_dir):
    return audit.distinct_counts(bench(spark, sf_dir), NUM, approx=True)


@query("SELECT label, count(*) AS n FROM bench GROUP BY label")
def class_balance(spark, sf_dir):
    return audit.value_counts(bench(spark, sf_dir), "label")


DUP_TOTALS = """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_groups FROM (
       SELECT count(*) AS n FROM {t} GROUP BY {c} HAVING count(*) > 1)"""


@query(DUP_TOTALS.format(t="events", c="user_id, event_type, value, props"))
def duplicate_rows(spark, sf_dir):
    cols = ["user_id", "event_type", "value", "props"]
    return dedup.duplicate_totals(table(spark, sf_dir, "events"), cols)


@query(DUP_TOTALS.format(t="lineitem", c="l_orderkey, l_linenumber"))
def duplicate_ids(spark, sf_dir):
    return dedup.duplicate_totals(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(DUP_TOTALS.format(t="bench", c=M_SQL))
def duplicate_vectors(spark, sf_dir):
    return dedup.duplicate_totals(bench(spark, sf_dir), M)


@query(f"""WITH g AS (SELECT count(DISTINCT ref) AS r, count(DISTINCT label) AS l FROM bench
       GROUP BY {M_SQL} HAVING count(*) > 1)
       SELECT 'ref' AS target, count(*) AS n_groups, count(*) FILTER (r > 1) AS n_conflicting FROM g
       UNION ALL SELECT 'label', count(*), count(*) FILTER (l > 1) FROM g""")
def duplicate_conflicts(spark, sf_dir):
    return dedup.conflicts(bench(spark, sf_dir), M, ["ref", "label"])


@query(f"""SELECT label, count(*) AS n FROM (SELECT label, count(*) OVER (PARTITION BY {M_SQL}) AS k
       FROM bench) WHERE k > 1 GROUP BY label""")
def duplicate_label_mix(spark, sf_dir):
    return dedup.label_mix(bench(spark, sf_dir), M, "label")


@query(union_all(f"""SELECT {d} AS decimals, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_groups
       FROM (SELECT count(*) AS n FROM bench GROUP BY {", ".join(f"round_even({c}, {d})" for c in M)}
             HAVING count(*) > 1)""" for d in (3, 2, 1, 0)))
def near_duplicates(spark, sf_dir):
    return dedup.near_duplicates(bench(spark, sf_dir), M)


@query("""SELECT 'c_acctbal' AS "column", count(*) FILTER (c_acctbal < 0) AS n_negative,
       count(*) FILTER (c_acctbal = 0) AS n_zero FROM customer
       UNION ALL SELECT 'c_nationkey', count(*) FILTER (c_nationkey < 0), count(*) FILTER (c_nationkey = 0)
       FROM customer""")
def sign_counts(spark, sf_dir):
    return audit.sign_counts(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])


@query(union_all(f"""SELECT '{c}' AS "column", min({c}) AS min, max({c}) AS max,
       count(*) FILTER ({c} = lo) AS n_at_min, count(*) FILTER ({c} = hi) AS n_at_max,
       (count(*) FILTER ({c} = lo) > 5 OR count(*) FILTER ({c} = hi) > 5) AS clipped
       FROM bench, (SELECT min({c}) AS lo, max({c}) AS hi FROM bench)""" for c in M))
def clipping(spark, sf_dir):
    return audit.clipping(bench(spark, sf_dir), M)


EXTREMES = """SELECT '{c}' AS "column",
       count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS iqr_outliers,
       count(*) FILTER (abs(({c} - med) / CASE WHEN d > 0 THEN d * 1.4826e0 ELSE sd END) > 3) AS robust_z_outliers,
       min({c}) AS min, max({c}) AS max, round(avg({c}), 6) AS mean, round(median({c}), 6) AS median,
       round(stddev_samp({c}), 6) AS std, round(any_value(d), 6) AS mad
       FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, median({c}) AS med,
                  mad({c}) AS d, stddev_samp({c}) AS sd FROM {t})"""


def _rounded(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


@query(union_all(EXTREMES.format(c=c, t="bench") for c in NUM))
def extreme_values(spark, sf_dir):
    return _rounded(audit.extremes(bench(spark, sf_dir), NUM), ["mean", "median", "std", "mad"])


@query(EXTREMES.format(c="value", t="events"))
def extreme_event_values(spark, sf_dir):
    return _rounded(audit.extremes(table(spark, sf_dir, "events"), ["value"]),
                    ["mean", "median", "std", "mad"])


@query()
def extreme_values_sketch(spark, sf_dir):
    return audit.extremes(bench(spark, sf_dir), NUM, accuracy=10_000)


@query(union_all(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
       round(median({c}), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max FROM bench"""
                 for c in NUM))
def describe_columns(spark, sf_dir):
    return _rounded(audit.describe(bench(spark, sf_dir), NUM), ["mean", "std", "p25", "p50", "p75"])


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic")
def crosstab(spark, sf_dir):
    return audit.crosstab(table(spark, sf_dir, "labels"), "quality", "toxic")


@query(union_all(f"""SELECT '{c}' AS "column", CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(y), 9) AS rate FROM (
       SELECT CAST(label = 'Invalid' AS INTEGER) AS y,
         CASE WHEN {c} IS NULL THEN NULL ELSE CAST(q1 > q0 AND q1 < q4 AND {c} > q1 AS INTEGER)
           + CAST(q2 > q1 AND q2 < q4 AND {c} > q2 AS INTEGER)
           + CAST(q3 > q2 AND q3 < q4 AND {c} > q3 AS INTEGER) END AS bin
       FROM bench, (SELECT min({c}) AS q0, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
                    quantile_cont({c}, 0.75) AS q3, max({c}) AS q4 FROM bench)) WHERE bin IS NOT NULL GROUP BY bin"""
                 for c in M))
def invalid_rate_by_quartile(spark, sf_dir):
    out = bins.rate_by_bin(bench(spark, sf_dir), M, F.col("label") == "Invalid", 4)
    return _rounded(out, ["rate"], 9)


@query("""SELECT count(*) AS n_rows, count(*) FILTER (s1 IS NULL OR s2 IS NULL OR s3 IS NULL) AS n_missing,
       count(*) FILTER (s1 > 24) AS n_high,
       count(*) FILTER (s1 IS NULL OR s2 IS NULL OR s3 IS NULL OR s1 > 24) AS n_flagged,
       round(CAST(count(*) FILTER (s1 IS NULL OR s2 IS NULL OR s3 IS NULL OR s1 > 24) AS DOUBLE) / count(*), 9)
         AS flag_rate FROM bench WHERE split = 'test'""")
def test_flag_rate(spark, sf_dir):
    out = audit.flag_rate(test(spark, sf_dir), {"missing": rw.any_missing(ROLES.sensors),
                                                "high": F.col("s1") > 24})
    return _rounded(out, ["flag_rate"], 9)


# --- duplicate marks, groups, ranks, bins ---------------------------------------------------------
@query(f"""SELECT test_id, count(*) OVER (PARTITION BY split, {M_SQL}) > 1 AS is_dup,
       count(*) OVER (PARTITION BY split, {M_SQL}) AS group_size,
       min(test_id) OVER (PARTITION BY split, {M_SQL}) AS group_id FROM bench""")
def duplicate_marks(spark, sf_dir):
    df = bench(spark, sf_dir).select("test_id", "split", *M)
    found = dedup.group_facts(df, ["split", *M], {"first_id": F.min("test_id")}, "group_size", "is_dup")
    return found.select("test_id", "is_dup", "group_size",
                        F.coalesce("first_id", "test_id").alias("group_id"))


@query(f"""SELECT test_id, count(*) OVER (PARTITION BY event_type, v, k) > 1 AS is_dup FROM (
       SELECT event_id AS test_id, event_type, round_even(value, 0) AS v, user_id % 3 AS k FROM events)""")
def near_duplicate_marks(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("test_id"), "event_type",
                                               rw.round_half_even("value", 0).alias("v"),
                                               (F.col("user_id") % 3).alias("k"))
    return dedup.is_duplicate(ev, ["event_type", "v", "k"]).select("test_id", "is_dup")


@query(f"""SELECT test_id, min(test_id) OVER (PARTITION BY {", ".join(f"round_even({c}, 4)" for c in M)}) AS group_id
       FROM bench""")
def fingerprint_groups(spark, sf_dir):
    return dedup.group_id(bench(spark, sf_dir).select("test_id", *M), M, "test_id", decimals=4).select(
        "test_id", "group_id")


@query(f"""SELECT test_id, concat_ws('|', {", ".join(
    f"CAST(CAST(coalesce(round_even({c}, 4), -9e9) AS DECIMAL(38, 4)) AS VARCHAR)" for c in M)}) AS fingerprint
       FROM bench""")
def fingerprints(spark, sf_dir):
    return bench(spark, sf_dir).select("test_id", rw.fingerprint(M).alias("fingerprint"))


@query("""SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC)
       + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2e0 AS avg_rank,
       round(percent_rank() OVER (ORDER BY o_totalprice), 12) AS pct_rank FROM orders""")
def row_ranks(spark, sf_dir):
    from plumbline.operators.skew import attach_groups

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    ranks = ordered.running_counts(orders, ["o_totalprice"]).select(
        F.col("value").alias("o_totalprice"), "n", ordered.average_rank(descending=True).alias("avg_rank"),
        ordered.percent_rank().alias("pct_rank"))
    return attach_groups(orders, ranks, ["o_totalprice"], "n").select(
        "o_orderkey", "avg_rank", F.round("pct_rank", 12).alias("pct_rank"))


@query("""WITH p AS (SELECT test_id, split, concat(CAST(s1 IS NULL AS INTEGER), CAST(s2 IS NULL AS INTEGER),
         CAST(s3 IS NULL AS INTEGER), CAST(s4 IS NULL AS INTEGER)) AS pattern FROM bench),
       c AS (SELECT pattern, CAST(dense_rank() OVER (ORDER BY pattern) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT pattern FROM p WHERE split = 'train'))
       SELECT p.test_id, c.code AS miss_pattern_code FROM p LEFT JOIN c USING (pattern) WHERE p.split = 'test'""")
def missing_pattern_codes(spark, sf_dir):
    codes = bins.pattern_codes(train(spark, sf_dir), SENSORS)
    return bins.with_pattern_code(test(spark, sf_dir), codes, SENSORS).select("test_id", "miss_pattern_code")


@query("""SELECT concat(CAST(s1 IS NULL AS INTEGER), CAST(s2 IS NULL AS INTEGER), CAST(s3 IS NULL AS INTEGER),
       CAST(s4 IS NULL AS INTEGER)) AS pattern, count(*) AS n FROM bench GROUP BY ALL""")
def missing_patterns(spark, sf_dir):
    return bins.pattern_counts(bench(spark, sf_dir), SENSORS)


@query("""SELECT p_partkey, CASE WHEN p_size IS NULL OR q0 = q5 THEN NULL ELSE """ + " + ".join(
    f"CAST(q{i} > q{i - 1} AND q{i} < q5 AND p_size > q{i} AS INTEGER)" for i in range(1, 5)) + """ END AS p_size_bin
       FROM part, (SELECT """ + ", ".join(f"quantile_cont(CAST(p_size AS DOUBLE), {i / 5}) AS q{i}"
                                         for i in range(6)) + " FROM part)")
def size_quintiles(spark, sf_dir):
    return bins.qcut(table(spark, sf_dir, "part"), "p_size", 5).select("p_partkey", "p_size_bin")


# --- distribution tables --------------------------------------------------------------------------
def _grid_sql(c, bins_, lo, hi):
    return f"CAST(least(floor(({c} - {lo}) / ({hi} - {lo}) * {bins_}), {bins_ - 1}) AS INTEGER)"


@query(union_all(f"""SELECT label, '{c}' AS "column", {_grid_sql(c, 40, "lo", "hi")} AS bin,
       round(any_value(lo) + {_grid_sql(c, 40, "lo", "hi")} * ((any_value(hi) - any_value(lo)) / 40), 7) AS "left",
       count(*) AS n, round(CAST(count(*) AS DOUBLE) / (any_value(t) * ((any_value(hi) - any_value(lo)) / 40)), 9) AS density
       FROM bench JOIN (SELECT label, count({c}) AS t FROM bench GROUP BY label) USING (label),
            (SELECT min({c}) AS lo, max({c}) AS hi FROM bench)
       WHERE {c} IS NOT NULL GROUP BY label, {_grid_sql(c, 40, "lo", "hi")}""" for c in NUM))
def histograms_by_label(spark, sf_dir):
    out = bins.histogram(bench(spark, sf_dir), NUM, 40, by=["label"], density=True)
    return _rounded(_rounded(out, ["left"], 7), ["density"], 9)


@query(union_all(f"""SELECT * FROM (WITH e AS (SELECT min({c}) AS lo, max({c}) AS hi FROM bench),
       s AS (SELECT split, count({c}) AS n, stddev_samp({c}) * pow(count({c}), -0.2e0) AS h FROM bench GROUP BY split),
       b AS (SELECT split, least(floor(({c} - lo) / (hi - lo) * 400), 399) AS bin, count(*) AS m
             FROM bench, e WHERE {c} IS NOT NULL GROUP BY ALL)
       SELECT split, '{c}' AS "column", CAST(point AS INTEGER) AS point,
         round(any_value(lo + point * (hi - lo) / 49), 9) AS x,
         round(sum(m / (n * h * sqrt(2 * pi())) * exp(-0.5e0 * pow((lo + point * (hi - lo) / 49
           - (lo + bin * ((hi - lo) / 400) + (hi - lo) / 400 / 2)) / h, 2))), 9) AS density
       FROM b JOIN s USING (split), e, (SELECT unnest(range(50)) AS point) GROUP BY split, point)""" for c in NUM))
def density_by_split(spark, sf_dir):
    return _rounded(bins.kde(bench(spark, sf_dir), NUM, by=["split"]), ["x", "density"], 9)


@query(union_all(f"""SELECT label, '{c}' AS "column", count({c}) AS n, round(any_value(q1), 9) AS q1, round(any_value(md), 9) AS median,
       round(any_value(q3), 9) AS q3, min({c}) FILTER ({c} >= q1 - 1.5e0 * (q3 - q1)) AS whisker_low,
       max({c}) FILTER ({c} <= q3 + 1.5e0 * (q3 - q1)) AS whisker_high,
       count(*) FILTER ({c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS n_outside
       FROM bench JOIN (SELECT label, quantile_cont({c}, 0.25) AS q1, median({c}) AS md, quantile_cont({c}, 0.75) AS q3
                        FROM bench GROUP BY label) USING (label) GROUP BY label""" for c in NUM))
def box_statistics(spark, sf_dir):
    return _rounded(bins.box_stats(bench(spark, sf_dir), NUM, ["label"]), ["q1", "median", "q3"], 9)


@query(f"""SELECT label, {_grid_sql("voltage", 20, "vl", "vh")} AS x_bin, {_grid_sql("current_a", 20, "cl", "ch")} AS y_bin,
       count(*) AS n, round(avg(ref), 6) AS mean_ref
       FROM bench, (SELECT min(voltage) AS vl, max(voltage) AS vh, min(current_a) AS cl, max(current_a) AS ch FROM bench)
       GROUP BY ALL""")
def operating_map(spark, sf_dir):
    return _rounded(bins.grid2d(bench(spark, sf_dir), "voltage", "current_a", "ref", by=["label"]), ["mean_ref"])


SENSOR_PAIRS = [("s1", "s2"), ("s1", "s3"), ("s1", "s4"), ("s2", "s3"), ("s2", "s4"), ("s3", "s4")]


@query(union_all(f"""SELECT label, '{a}' AS x, '{b}' AS y, {_grid_sql(a, 20, "al", "ah")} AS x_bin,
       {_grid_sql(b, 20, "bl", "bh")} AS y_bin, count(*) AS n
       FROM bench, (SELECT min({a}) AS al, max({a}) AS ah, min({b}) AS bl, max({b}) AS bh FROM bench)
       WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL""" for a, b in SENSOR_PAIRS))
def sensor_pair_grids(spark, sf_dir):
    return bins.pair_grids(bench(spark, sf_dir), SENSOR_PAIRS, by=["label"])


@query("""SELECT event_type, CAST(floor(log10(greatest(value, 1e-6)) * 10) AS INTEGER) AS log_bin, count(*) AS n,
       round(pow(10e0, floor(log10(any_value(greatest(value, 1e-6))) * 10) / 10e0), 9) AS "left"
       FROM events GROUP BY event_type, log_bin""")
def log_histogram(spark, sf_dir):
    return _rounded(bins.log_hist(table(spark, sf_dir, "events"), "value", by=["event_type"]), ["left"], 9)
