"""Loading named tables with a checked schema, and the fold table."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from plumbline.roles import Roles

FOLD_SCHEMA = T.StructType([T.StructField("test_id", T.LongType()), T.StructField("fold", T.IntegerType())])


def measurement_schema(roles: Roles = Roles(), targets: bool = True) -> T.StructType:
    """Schema of a training table, or of a scoring table without target and label."""
    fields = [T.StructField(roles.id, T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in roles.measurements]
    if targets:
        fields += [T.StructField(roles.target, T.DoubleType()), T.StructField(roles.label, T.StringType())]
    return T.StructType(fields)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column: Spark orders NaN above every number."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
                       for c in df.columns])


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name; fail when one is absent or of another type."""
    found = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: expected {f.dataType.simpleString()}, found "
             f"{found[f.name].simpleString() if f.name in found else 'nothing'}"
             for f in schema if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df.select(*schema.names)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One parquet or CSV table, NaN as NULL. CSV needs a schema; nothing is inferred from rows."""
    if PurePosixPath(path).suffix == ".csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return nan_to_null(spark.read.schema(schema).option("header", True)
                           .option("enforceSchema", False).csv(path))
    df = spark.read.parquet(path)
    return nan_to_null(check_schema(df, schema) if schema is not None else df)


def load_tables(spark: SparkSession, directory: str,
                schemas: Mapping[str, T.StructType | None] | Sequence[str]) -> dict[str, DataFrame]:
    """Named parquet tables of a directory; a schema per name is checked when given."""
    named = schemas if isinstance(schemas, Mapping) else {name: None for name in schemas}
    return {name: load_table(spark, f"{directory}/{name}.parquet", s) for name, s in named.items()}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a table that arrives in fewer pieces than there are cores.

    A table of many files is returned as it is; only a small one read from few files or row groups is
    shuffled, so that later work on it runs on all cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def schema_profile(df: DataFrame) -> DataFrame:
    """Column list with types and positions as a table."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def align_schema(df: DataFrame, roles: Roles = Roles(), carry: Sequence[str] = ()) -> DataFrame:
    """Columns by name in role order; an absent extra sensor becomes NULL."""
    optional = set(roles.extra)
    missing = [c for c in [roles.id, *roles.measurements] if c not in df.columns and c not in optional]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    wanted = [roles.id, *roles.measurements, *carry]
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c)
                       for c in wanted])


def get_folds(df: DataFrame, path: str, build) -> DataFrame:
    """The saved fold table at ``path``; built by ``build(df)`` and saved on first use."""
    spark = df.sparkSession

    def read() -> DataFrame:
        return spark.read.schema(FOLD_SCHEMA).option("header", True).csv(path)

    try:
        return read()
    except AnalysisException:
        build(df).select(*FOLD_SCHEMA.names).write.mode("errorifexists").option("header", True).csv(path)
        return read()
