"""Queries of the sensor twin: residuals, thresholds, fault buckets, verdicts, stress tests.

The SQL-checked ones use a straight-line twin in the squared current, which both engines can fit; the
polynomial twin is checked against the planted truth by the tests.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import rowwise as rw
from plumbline.operators import damage as dm
from plumbline.operators import features, folds, metrics, twin
from plumbline.plans.registry import ROLES, bench, query, test, train, union_all
from plumbline.sources import sinks

S3, M = list(ROLES.sensors), ROLES.measurements
SQUARE, K = "current_a * current_a", 2.0


def rounded(df, cols, d=5):
    return df.withColumns({c: F.round(c, d) for c in cols})


def folded(df):
    return folds.group_kfold(df, M, 5)


# --- flagship --------------------------------------------------------------------------------------
def fitted(spark, sf_dir):
    valid = features.valid_rows(train(spark, sf_dir), ROLES)
    model = twin.fit_twin(valid, ROLES, checked=False)
    return model, twin.derive_threshold(valid, model)


@query("SELECT planted AS bucket, CASE WHEN planted = 'none' THEN 'Valid' ELSE 'Invalid' END AS verdict, label, count(*) AS n "
       "FROM bench WHERE split = 'test' GROUP BY ALL")
def twin_verdict_counts(spark, sf_dir):
    """Twin fitted on Valid training rows, applied to the test rows; must equal the planted truth."""
    model, threshold = fitted(spark, sf_dir)
    scored = twin.predict_validity(test(spark, sf_dir), model, threshold, ROLES)
    return scored.groupBy("bucket", "verdict", "label").agg(F.count("*").alias("n"))


@query("SELECT test_id, planted AS bucket, CASE WHEN planted = 'none' THEN 'Valid' ELSE 'Invalid' END AS verdict FROM bench "
       "WHERE split = 'test'")
def twin_verdicts(spark, sf_dir):
    model, threshold = fitted(spark, sf_dir)
    return twin.predict_validity(test(spark, sf_dir), model, threshold, ROLES).select("test_id", "bucket", "verdict")


@query("SELECT planted AS bucket, CASE WHEN planted = 'none' THEN 'Valid' ELSE 'Invalid' END AS verdict, count(*) AS n "
       "FROM bench WHERE split = 'train' GROUP BY ALL")
def twin_out_of_fold_verdicts(spark, sf_dir):
    """Twins refitted for every fold judge only rows they did not see."""
    scored = twin.oof_verdict(folded(train(spark, sf_dir)), "fold", roles=ROLES)
    return scored.groupBy("bucket", "verdict").agg(F.count("*").alias("n"))


@query()
def twin_out_of_fold_scores(spark, sf_dir):
    scored = twin.oof_verdict(folded(train(spark, sf_dir)), "fold", roles=ROLES)
    return metrics.classification_metrics(scored, F.col("label") == "Invalid", F.col("verdict") == "Invalid")


@query()
def twin_quality(spark, sf_dir):
    """Out-of-fold R², MAE and residual deviation of each sensor's polynomial."""
    valid = features.valid_rows(folded(train(spark, sf_dir)), ROLES)
    twins = twin.fold_twins(valid, "fold", ROLES)
    out = twin.with_fold_expectations(valid, twins, "fold")
    cells = F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(s).alias("y"), F.col(f"expected_{s}").alias("p")) for s in S3])
    return out.select(F.inline(cells)).groupBy("sensor").agg(
        metrics.r2_of(F.col("y"), F.col("p")).alias("r2"), F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
        F.stddev_samp(F.col("y") - F.col("p")).alias("sigma"))


@query()
def twin_separation_gap(spark, sf_dir):
    model, threshold = fitted(spark, sf_dir)
    return twin.gap(twin.predict_validity(train(spark, sf_dir), model, threshold, ROLES), ROLES)


@query()
def twin_fault_taxonomy(spark, sf_dir):
    model, threshold = fitted(spark, sf_dir)
    return twin.taxonomy(twin.predict_validity(train(spark, sf_dir), model, threshold, ROLES), ROLES)


@query()
def twin_threshold_sweep(spark, sf_dir):
    model, threshold = fitted(spark, sf_dir)
    scored = twin.predict_validity(train(spark, sf_dir), model, threshold, ROLES)
    always = rw.any_missing(S3) | F.col("is_dup")
    return metrics.threshold_sweep(scored, F.col("label") == "Invalid", "max_abs_residual", always=always)


# --- the same with a twin that SQL can fit ----------------------------------------------------------
LINES = f"""fit AS (SELECT {", ".join(f"regr_slope({s}, {SQUARE}) AS b_{s}, regr_intercept({s}, {SQUARE}) AS a_{s}" for s in S3)}
       FROM bench WHERE split = 'train' AND label = 'Valid'),
       res AS (SELECT bench.*, {", ".join(f"{s} - (b_{s} * ({SQUARE}) + a_{s}) AS r_{s}" for s in S3)},
         count(*) OVER (PARTITION BY split, {", ".join(M)}) > 1 AS is_dup FROM bench, fit),
       thr AS (SELECT {K}e0 * 1.4826e0 * greatest({", ".join(f"median(abs(r_{s}))" for s in S3)}) AS t FROM res
         WHERE split = 'train' AND label = 'Valid'),
       mx AS (SELECT *, greatest({", ".join(f"abs(r_{s})" for s in S3)}) AS m FROM res, thr),
       bk AS (SELECT *, CASE {" ".join(f"WHEN abs(r_{s}) = m THEN '{s}'" for s in S3)} END AS suspect,
         CASE WHEN s1 IS NULL OR s2 IS NULL OR s3 IS NULL THEN 'missing' WHEN is_dup THEN 'duplicate'
           WHEN m > t THEN 'spike' ELSE 'none' END AS bucket FROM mx)"""


def line_fitted(spark, sf_dir):
    valid = features.valid_rows(train(spark, sf_dir), ROLES)
    model = twin.fit_line_twin(valid, S3, SQUARE)
    return model, twin.derive_threshold(valid, model, k=K)


def line_scored(spark, sf_dir, rows=test):
    model, threshold = line_fitted(spark, sf_dir)
    return twin.predict_validity(rows(spark, sf_dir), model, threshold, ROLES), threshold


@query(f"WITH {LINES} SELECT test_id, {', '.join(f'round(r_{s}, 5) AS residual_{s}' for s in S3)}, round(m, 5) AS max_abs_residual, "
       "suspect AS suspect_sensor FROM bk -- of bench")
def line_residuals(spark, sf_dir):
    model, _ = line_fitted(spark, sf_dir)
    names = [f"residual_{s}" for s in S3] + ["max_abs_residual"]
    return rounded(twin.with_residuals(bench(spark, sf_dir), model), names).select("test_id", *names, "suspect_sensor")


@query(f"WITH {LINES} SELECT round(t, 5) AS threshold FROM thr -- of bench")
def line_threshold(spark, sf_dir):
    _, threshold = line_fitted(spark, sf_dir)
    return train(spark, sf_dir).agg(F.round(F.max(F.lit(threshold)), 5).alias("threshold"))


@query(f"WITH {LINES} SELECT test_id, bucket, CASE WHEN bucket = 'none' THEN 'Valid' ELSE 'Invalid' END AS verdict FROM bk "
       "WHERE split = 'test' -- of bench")
def line_verdicts(spark, sf_dir):
    return line_scored(spark, sf_dir)[0].select("test_id", "bucket", "verdict")


@query(f"WITH {LINES} SELECT bucket, CASE WHEN bucket = 'spike' THEN suspect END AS sensor, count(*) AS n FROM bk "
       "WHERE split = 'train' AND label = 'Invalid' GROUP BY ALL -- of bench")
def line_taxonomy(spark, sf_dir):
    return twin.taxonomy(line_scored(spark, sf_dir, train)[0], ROLES)


@query(f"""WITH {LINES}, g AS (SELECT max(m) FILTER (label = 'Valid') AS vm, min(m) FILTER (label = 'Invalid' AND NOT is_dup
         AND s1 IS NOT NULL AND s2 IS NOT NULL AND s3 IS NOT NULL) AS sm, stddev_samp(m) FILTER (label = 'Valid') AS sd
         FROM bk WHERE split = 'train')
       SELECT round(vm, 5) AS valid_max, round(sm, 5) AS spike_min, round(sd, 5) AS valid_sigma, round(sm / vm, 5) AS ratio FROM g -- of bench""")
def line_separation_gap(spark, sf_dir):
    out = twin.gap(line_scored(spark, sf_dir, train)[0], ROLES)
    return rounded(out, ["valid_max", "spike_min", "valid_sigma", "ratio"])


@query(f"""WITH {LINES} SELECT bucket <> 'none' AS rule, m > t AS residual_only, count(*) AS n,
       NOT ((bucket <> 'none') IS NOT DISTINCT FROM (m > t)) AS disagrees FROM bk GROUP BY ALL -- of bench""")
def verdict_disagreement(spark, sf_dir):
    model, threshold = line_fitted(spark, sf_dir)
    df = twin.with_residuals(bench(spark, sf_dir), model)
    from plumbline.operators.dedup import is_duplicate

    df = is_duplicate(df, ["split", *M])
    df = df.select((twin.fault_bucket(threshold, S3) != "none").alias("rule"),
                   (F.col("max_abs_residual") > threshold).alias("residual_only"))
    return metrics.disagreement(df, "rule", "residual_only")


REFERENCE = f"""ref_line AS (SELECT regr_slope(ref, {SQUARE}) AS rb, regr_intercept(ref, {SQUARE}) AS ra, min(ref) AS lo, max(ref) AS hi
         FROM bench WHERE split = 'train' AND label = 'Valid'),
       pred AS (SELECT bk.*, greatest(least(rb * ({SQUARE}) + ra, hi + (hi - lo) * 0.2e0), lo - (hi - lo) * 0.2e0) AS p
         FROM bk, ref_line WHERE split = 'test'),
       att AS (SELECT *, CAST(bucket <> 'none' AS DOUBLE) AS a1, coalesce(least(m / t, 1e0), 0e0) AS a2,
         (CAST(s1 IS NULL AS INTEGER) + CAST(s2 IS NULL AS INTEGER) + CAST(s3 IS NULL AS INTEGER) + CAST(s4 IS NULL AS INTEGER)) / 4e0 AS a3,
         percent_rank() OVER (ORDER BY p) AS a4 FROM pred)"""


def attended(spark, sf_dir):
    valid = features.valid_rows(train(spark, sf_dir), ROLES)
    line = twin.fit_line_twin(valid, ["ref"], SQUARE)
    ends = valid.agg(F.min("ref").alias("lo"), F.max("ref").alias("hi")).first()
    scored, threshold = line_scored(spark, sf_dir)
    predicted = scored.withColumn("predicted", rw.clip_range(line.expected("ref"), F.lit(ends["lo"]), F.lit(ends["hi"])))
    return twin.attention(predicted, threshold, "predicted", ROLES)


PARTS = ["part_invalid", "part_residual", "part_missing", "part_prediction", "attention"]


@query(f"""WITH {LINES}, {REFERENCE} SELECT test_id, round(a1, 5) AS part_invalid, round(a2, 5) AS part_residual, round(a3, 5) AS part_missing,
       round(a4, 5) AS part_prediction, round((a1 + a2 + a3 + a4) / 4, 5) AS attention FROM att -- of bench""")
def attention_scores(spark, sf_dir):
    return rounded(attended(spark, sf_dir), PARTS).select("test_id", *PARTS)


@query(f"""WITH {LINES}, {REFERENCE} SELECT test_id, round((a1 + a2 + a3 + a4) / 4, 5) AS attention FROM att
       ORDER BY round((a1 + a2 + a3 + a4) / 4, 5) DESC, test_id LIMIT 3 -- of bench""")
def top_attention(spark, sf_dir):
    return twin.top_attention(rounded(attended(spark, sf_dir), ["attention"]), "test_id")


@query(f"""WITH {LINES}, {REFERENCE} SELECT test_id, CASE WHEN bucket = 'none' THEN 'Valid' ELSE 'Invalid' END AS verdict, bucket, is_dup,
       round(m, 5) AS max_abs_residual, suspect AS suspect_sensor, {', '.join(f'round(r_{s}, 5) AS residual_{s}' for s in S3)},
       round(a1, 5) AS part_invalid, round(a2, 5) AS part_residual, round(a3, 5) AS part_missing, round(a4, 5) AS part_prediction,
       round((a1 + a2 + a3 + a4) / 4, 5) AS attention FROM att -- of bench""")
def record_diagnostics(spark, sf_dir):
    out = twin.diagnostics(attended(spark, sf_dir), "test_id")
    return rounded(out, [c for c, t in out.dtypes if t == "double"])


@query(f"""WITH {LINES}, {REFERENCE} SELECT test_id, round(p, 5) AS predicted, CASE WHEN bucket = 'none' THEN 'Valid' ELSE 'Invalid' END
       AS verdict FROM att -- of bench""")
def submission_rows(spark, sf_dir):
    rows = test(spark, sf_dir)
    template = rows.select("test_id", (F.abs("test_id") * 2 + (F.col("test_id") < 0).cast("int")).alias("ord"))
    pred = rounded(attended(spark, sf_dir), ["predicted"]).select("test_id", "predicted", "verdict")
    return sinks.submission(pred, template, "test_id", ["test_id", "predicted", "verdict"])


@query("""WITH t AS (SELECT abs(test_id) AS a, count(*) OVER (PARTITION BY test_id) AS c FROM bench WHERE split = 'test')
       SELECT count(*) FILTER (c > 1 OR a % 7 = 1 OR a % 19 = 2) AS missing_ids,
       count(*) FILTER (c = 1 AND a % 7 <> 1 AND a % 19 = 2) AS extra_ids,
       count(*) FILTER (c = 1 AND a % 7 <> 1 AND a % 11 = 3) AS bad_values,
       count(*) FILTER (c = 1 AND a % 7 <> 1 AND a % 13 = 4) AS bad_labels, CAST(0 AS BIGINT) AS repeated_ids FROM t""")
def submission_checks(spark, sf_dir):
    """Planted faults: missing ids, unknown ids, NaN values and unknown labels are all counted."""
    a = F.abs("test_id")
    wide = F.col("test_id").cast("decimal(19,0)")  # a thousand times an id may exceed 64 bits
    once = Window.partitionBy("test_id")
    pred = attended(spark, sf_dir).withColumn("_c", F.count("*").over(once)).filter("_c = 1").filter(a % 7 != 1).select(
        F.when(a % 19 == 2, wide * 1000 + 7).otherwise(wide).alias("test_id"),
        F.when(a % 11 == 3, F.lit(float("nan"))).otherwise(F.col("predicted")).alias("predicted"),
        F.when(a % 13 == 4, "maybe").otherwise(F.col("verdict")).alias("verdict"))
    return sinks.submission_problems(pred, test(spark, sf_dir).select("test_id"), "test_id", "predicted", "verdict")


@query(f"""WITH {LINES}, {REFERENCE}, q AS (SELECT *, (a1 + a2 + a3 + a4) / 4 AS a FROM att)
       SELECT count(*) AS records_analysed, count(*) FILTER (bucket <> 'none') AS invalid_records, round(min(p), 6) AS minimum_predicted,
       round(max(p), 6) AS maximum_predicted, round(avg(p), 6) AS average_predicted,
       (SELECT list(test_id ORDER BY round(a, 5) DESC, test_id) FROM (SELECT * FROM q ORDER BY round(a, 5) DESC, test_id LIMIT 3))
         AS highest_attention_ids FROM q -- of bench""")
def submission_summary(spark, sf_dir):
    pred = rounded(attended(spark, sf_dir), ["attention"])
    out = sinks.summary(pred, "test_id", "predicted", "verdict", "attention")
    return rounded(out, ["minimum_predicted", "maximum_predicted", "average_predicted"], 6)


@query(f"""WITH {LINES} SELECT count(*) FILTER (p < lo - (hi - lo) * 0.2e0 OR p > hi + (hi - lo) * 0.2e0) AS n_clipped,
       round(min(greatest(least(p, hi + (hi - lo) * 0.2e0), lo - (hi - lo) * 0.2e0)), 5) AS min,
       round(max(greatest(least(p, hi + (hi - lo) * 0.2e0), lo - (hi - lo) * 0.2e0)), 5) AS max
       FROM (SELECT 3e0 * ref - 40 AS p FROM bench), (SELECT min(ref) AS lo, max(ref) AS hi FROM bench WHERE label = 'Valid') -- of bench""")
def clipped_predictions(spark, sf_dir):
    df = bench(spark, sf_dir)
    ends = features.valid_rows(df, ROLES).agg(F.min("ref").alias("lo"), F.max("ref").alias("hi")).first()
    p = F.col("ref") * 3.0 - 40
    clip = rw.clip_range(p, F.lit(ends["lo"]), F.lit(ends["hi"]))
    return df.agg(F.count_if(clip != p).alias("n_clipped"), F.round(F.min(clip), 5).alias("min"), F.round(F.max(clip), 5).alias("max"))


# --- robustness --------------------------------------------------------------------------------------
@query()
def noise_separation(spark, sf_dir):
    """Gap between Valid and spiked residuals with noise added to the Valid rows' sensors."""
    model, threshold = fitted(spark, sf_dir)
    rows = train(spark, sf_dir)
    valid, rest = rows.filter("label = 'Valid'"), rows.filter("label <> 'Valid'")
    parts = []
    for sigma in (0.1, 0.25, 0.5):
        noisy = dm.add_noise(valid, S3, sigma, "test_id").unionByName(rest)
        parts.append(twin.gap(twin.predict_validity(noisy, model, threshold, ROLES), ROLES).withColumn("sigma", F.lit(sigma)))
    return sinks.stack(*parts)


@query()
def damaged_verdicts(spark, sf_dir):
    """Verdict counts after each kind of damage to the test rows."""
    from plumbline.sources.tables import align_schema

    model, threshold = fitted(spark, sf_dir)
    parts = []
    for kind in ("null_readings", "drop_extra", "copies", "overload", "zero_sensors", "shuffle_columns"):
        hurt = dm.damage(test(spark, sf_dir), kind, ROLES)
        scored = twin.predict_validity(align_schema(hurt, ROLES, ["label"]), model, threshold, ROLES,
                                       keys=twin.duplicate_keys(hurt, ROLES))
        parts.append(scored.groupBy("verdict", "bucket").agg(F.count("*").alias("n")).withColumn("damage", F.lit(kind)))
    return sinks.stack(*parts)


@query(union_all(["""SELECT label, count(*) AS n FROM (SELECT * FROM bench UNION ALL SELECT * FROM bench WHERE planted = 'spike')
       GROUP BY label"""]))
def appended_copies(spark, sf_dir):
    return dm.append_copies(bench(spark, sf_dir), F.col("planted") == "spike").groupBy("label").agg(F.count("*").alias("n"))
