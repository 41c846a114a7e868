"""Secret scans with an incremental ledger of content-addressed blobs. DataFrame functions only."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators.skew import attach_groups
from plumbline.sources.shared import settled


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match must have ``least`` characters; raise ``version`` with any change."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Kinds in report order. A run of 24 or more of a class is what is left of all its runs
# after dropping shorter ones, so access and hex state their least length in the pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
SCANNED = "blob string, rules array<string>"
FINDINGS = "blob string, kind string, version int, start bigint, end bigint"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """A ledger table; empty before its first scan."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{table}")
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(schema).parquet(f"{path}/{table}")
    return spark.createDataFrame([], schema)


def matches(text: Column, rule: Rule) -> Column:
    """Lengths between, of, and of the tested group of a rule's matches, in order; null without a match.

    What splitting by the pattern leaves and what extracting it finds alternate, so running sums of
    both lengths are the matches' code point positions.
    """
    length = lambda a: F.transform(a, lambda s: F.length(s).cast("long"))
    found = lambda group: F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))
    return F.when(text.rlike(rule.pattern), F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"),
        length(F.split(text, rule.pattern, -1)).alias("gaps"), length(found(0)).alias("sizes"),
        length(found(rule.group)).alias("tested")))


def spans_of(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings rows of ``blobs`` (``blob``, ``text``, ``seen``: keys of rules not to run again)."""
    unseen = [F.when(~F.array_contains("seen", r.key), matches(F.col("text"), r)) for r in rules]
    hits = blobs.select("blob", F.explode(F.filter(F.array(*unseen), lambda h: h.isNotNull())).alias("hit"))
    each = hits.select("blob", "hit.kind", "hit.version", "hit.least",
                       F.posexplode(F.arrays_zip("hit.gaps", "hit.sizes", "hit.tested")).alias("place", "m"))
    order = Window.partitionBy("blob", "kind").orderBy("place")
    end = F.sum(F.col("m.gaps") + F.coalesce("m.sizes", F.lit(0))).over(order)
    return (each.withColumn("end", end).filter(F.col("m.tested") >= F.col("least"))
            .select("blob", "kind", "version", (F.col("end") - F.col("m.sizes")).alias("start"), "end"))


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id") -> DataFrame:
    """Findings of every version of every path, scanning only what ``ledger`` has not seen.

    ``docs`` holds a row for each version (``doc_id`` as its path, ``text``; null counts as empty).
    A text's SHA-256 names its blob, and each blob is scanned once for each rule and rule version,
    whatever paths share it. ``ledger`` is a folder that keeps findings and the pairs scanned;
    findings are appended before the pairs, so a run that is lost in between is scanned again and its
    repeated findings count once.

    Returns a row for each row of ``docs``: ``path``, ``blob`` and ``spans``, an array of (start,
    rank, kind, end) by start and the order of ``rules``, code points, end exclusive; findings of
    other versions of a rule are left out. An empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    paths = settled(docs.select(F.col(path_col).alias("path"), blob_id(F.col("text")).alias("blob")), "secret-paths")
    blobs = settled(paths.groupBy("blob").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("paths")), "secret-blobs")
    keys = [r.key for r in rules]
    seen = (read_ledger(spark, ledger, "scanned", SCANNED).select("blob", F.explode("rules").alias("rule"))
            .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
    todo = (blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
            .withColumn("rules", F.array_except(F.array(*map(F.lit, keys)), "seen")).filter(F.size("rules") > 0))
    todo = settled(todo.select("blob", "path", "seen", "rules"), "secret-todo")
    # one copy of each blob, joined on blob and path so that a blob with many paths is not one key; rows that
    # share both are one. A struct equals itself with a null inside, so join and deduplication have the same keys
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.struct(F.col(path_col).alias("path")).alias("_path"),
                        blob_id(F.col("text")).alias("blob"))
    unseen = texts.join(todo.withColumn("_path", F.struct("path")).drop("path"), ["blob", "_path"]).dropDuplicates(
        ["blob", "_path"]).select("blob", "text", "seen")
    spans_of(unseen, rules).write.mode("append").parquet(f"{ledger}/findings")
    todo.select("blob", "rules").write.mode("append").parquet(f"{ledger}/scanned")

    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    found = (read_ledger(spark, ledger, "findings", FINDINGS).distinct()
             .filter(F.concat_ws("@", "kind", "version").isin(keys))
             .groupBy("blob").agg(F.sort_array(F.collect_list(
                 F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end"))).alias("spans")))
    groups = settled(blobs.join(found, "blob").select("blob", "paths", "spans"), "secret-found")
    placed = attach_groups(paths, groups, ["blob"], "paths")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return placed.select("path", "blob", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
