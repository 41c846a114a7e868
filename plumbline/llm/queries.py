"""Registered queries of the text operators: each applies its operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query()
def op1_mix_sources(spark, sf_dir):
    from plumbline.llm.mixing import mix

    copies = mix(documents(spark, sf_dir))
    return copies.groupBy("row_id").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("words").alias("taken"),
        F.min(F.when(F.col("words") > 0, F.col("position"))).alias("first_position")).drop("row_id")


@query()
def op6_hilbert_shards(spark, sf_dir):
    from plumbline.llm.sharding import hilbert_shards

    docs = documents(spark, sf_dir)
    utf8 = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select("doc_id", "lang", "source", (F.octet_length(utf8) + 16).cast("long").alias("size"),
                       F.crc32(utf8).alias("text_crc32")).withColumn("log_size", F.log2("size"))
    placed = hilbert_shards(rows, ["lang", "source", "log_size", "doc_id"], shards=40, ties=["text_crc32", "doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


@query()
def op4_pack_sequences(spark, sf_dir):
    import public_tokenizers

    from plumbline.llm.packing import pack

    pieces = pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query()
def op10_count_tokens(spark, sf_dir):
    import public_tokenizers

    from plumbline.llm.tokens import count_tokens

    return count_tokens(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), 512)


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
      FROM documents)
WINDOW same AS (PARTITION BY body)""")
def op7_exact_duplicates(spark, sf_dir):
    from plumbline.llm.exactdup import exact_duplicates

    return exact_duplicates(documents(spark, sf_dir))


def _secret_spans_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
SELECT doc_id, unnest(list_transform(range(1, len(ins) + 1), lambda i: {{'start': CAST(list_sum(gaps[1:i])
       + coalesce(list_sum(ins[1:i - 1]), 0) AS BIGINT), 'size': ins[i], 'tested': tested[i]}})) AS m,
       '{kind}' AS kind, {rank} AS rank, {least} AS least
FROM (SELECT doc_id, list_transform(string_split_regex(body, '{quoted}'), lambda x: length(x)) AS gaps,
             list_transform(regexp_extract_all(body, '{quoted}'), lambda x: length(x)) AS ins,
             list_transform(regexp_extract_all(body, '{quoted}', {group}), lambda x: length(x)) AS tested
      FROM bodies WHERE regexp_matches(body, '{quoted}'))"""


def secrets_sql() -> str:
    from plumbline.llm.secrets import RULES

    parts = "\nUNION ALL\n".join(_secret_spans_sql(r.kind, i, r.pattern, r.group, r.least) for i, r in enumerate(RULES))
    return f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
spans AS (SELECT doc_id, kind, rank, m.start AS s, m.start + m.size AS e FROM ({parts}) WHERE m.tested >= least),
lists AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
                 count(*) FILTER (kind = 'hex') AS h,
                 string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
                 string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(lists.spans, '') AS spans
FROM documents LEFT JOIN lists USING (doc_id)"""


@query(secrets_sql())
def op8_scan_secrets(spark, sf_dir):
    from plumbline.llm.secrets import BASE, scan, span_text
    from plumbline.sources.shared import shared_folder

    found = scan(documents(spark, sf_dir), shared_folder(spark, "secret-ledger"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select(F.col("path").alias("doc_id"), of("assign").alias("n_assign"), of("access").alias("n_access"),
                        of("hex").alias("n_hex"), F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


@query()
def op2_judge_quality(spark, sf_dir):
    from plumbline.llm.quality import judge

    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@query()
def op5_score_toxicity(spark, sf_dir):
    from plumbline.llm.toxicity import score_documents

    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query()
def op3_near_duplicates(spark, sf_dir):
    from plumbline.llm.neardup import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


@query()
def op9_remove_repeats(spark, sf_dir):
    from plumbline.llm.repeats import remove_repeats

    return remove_repeats(documents(spark, sf_dir)).drop("removed")


def centroids_sql(k: int = 40, components: int = 64, rounds: int = 5) -> str:
    """Distances to every centroid, round after round, in double arithmetic that is exact for these sizes."""
    nearest = """SELECT vec_id, row, x, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT vec_id, row, x, c, list_inner_product(x, x) - 2 * list_inner_product(x, m) + list_inner_product(m, m) AS d
        FROM whole, {centroids}) GROUP BY vec_id, row, x"""
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS ({nearest.format(centroids=f'm{r}')})")
        steps.append(f"""m{r + 1} AS (SELECT c, coalesce(moved.m, old.m) AS m FROM m{r} AS old LEFT JOIN (
            SELECT c, list(floor(s / n) ORDER BY i) AS m FROM (
                SELECT c, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, range(1, {components + 1}) AS t(i) GROUP BY c, i) GROUP BY c
            ) AS moved USING (c))""")
    return f"""WITH whole AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row,
        list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x FROM embeddings
        WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda v: isfinite(v))) = {components}),
    m0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x AS m FROM (
        SELECT sha256('2:' || vec_id) AS h, x FROM whole ORDER BY h, x LIMIT {k})),
    {', '.join(steps)},
    last AS ({nearest.format(centroids=f'm{rounds}')})
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(list_transform(m, lambda v: CAST(v AS BIGINT)), ',')) AS centroid_sha256
    FROM last JOIN m{rounds} USING (c)"""


@query(centroids_sql())
def op11_cluster_centroids(spark, sf_dir):
    from plumbline.llm.clustering import cluster

    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query()
def op12_byte_pair_ids(spark, sf_dir):
    import public_tokenizers

    from plumbline.llm.bytepairs import decode, encode

    how = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = decode(encode(documents(spark, sf_dir).select("doc_id", "text"), *how), *how)
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def infilling_sql() -> str:
    h = [f"CAST('0x' || substr(digest, {1 + 8 * i}, 8) AS BIGINT)" for i in range(4)]
    return f"""WITH units AS (SELECT doc_id, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
        FROM documents),
    cut AS (SELECT doc_id, body, u, len(u) AS n, least({h[0]} % (len(u) + 1), {h[1]} % (len(u) + 1)) AS a,
        greatest({h[0]} % (len(u) + 1), {h[1]} % (len(u) + 1)) AS b, CASE WHEN body = '' OR contains(body, '<P>')
        OR contains(body, '<S>') OR contains(body, '<M>') OR {h[2]} % 100 >= 100 THEN 'plain' WHEN {h[3]} % 100 < 50
        THEN 'spm' ELSE 'psm' END AS form FROM units),
    parts AS (SELECT doc_id, body, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
        array_to_string(u[b + 1:], '') AS s FROM cut)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(CASE form WHEN 'plain' THEN body
        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(body) AS restored_sha256 FROM parts"""


@query(infilling_sql())
def op13_fill_in_middle(spark, sf_dir):
    from plumbline.llm.infilling import fill_in_middle, restored

    rows = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
                       F.sha2(F.encode(restored(), "UTF-8"), 256).alias("restored_sha256"))
