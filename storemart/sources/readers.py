"""Readers: CSV-or-table sources, first existing of candidates, tagged multi-file
loads, importance from metadata (S04-S07, S23, S24).

Schemas are declared (no inference on large inputs); a missing source yields
an empty DataFrame of the declared schema so downstream plans still resolve.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import importance as IM


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def load_dataset(spark: SparkSession, csv_path: str | None = None, table: str | None = None,
                 schema: StructType | str | None = None) -> DataFrame:
    """CSV extract when given, else a catalog table."""
    if csv_path:
        return read_csv(spark, csv_path, schema)
    if table:
        return spark.table(table)
    raise ValueError("either csv_path or table is required")


def first_existing(spark: SparkSession, candidates: list, schema: StructType | str,
                   fmt: str = "csv") -> tuple[DataFrame, str | None]:
    """First candidate path that exists, else an empty frame of the schema."""
    for c in candidates:
        if _exists(spark, c):
            df = read_csv(spark, c, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(c)
            return df, c
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return spark.createDataFrame([], st), None


def reference_for_model(spark: SparkSession, model_key: str, candidates: list, schema) -> DataFrame:
    """Reference inputs of one model, tagged with its key."""
    df, _ = first_existing(spark, candidates, schema)
    return df.withColumn("source_model_key", F.lit(model_key))


def tagged_union(spark: SparkSession, paths: list, fmt: str = "csv", schema=None) -> DataFrame:
    """Every existing file read, tagged with its file, unioned by name with missing
    columns null, then de-duplicated (the tag is added first, so equal rows of two
    files both remain) (S07, U02, U04)."""
    frames = []
    for p in paths:
        if not _exists(spark, p):
            continue
        df = read_csv(spark, p, schema) if fmt == "csv" else spark.read.format(fmt).load(p)
        frames.append(df.withColumn("source_file", F.lit(p)))
    if not frames:
        return spark.createDataFrame([], "source_file string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).distinct()


# Metadata keys that may hold an importance table, in order.
METADATA_KEYS = ["feature_importance", "feature_importances", "shap_feature_importance",
                 "feature_importance_table"]


def importance_from_metadata(spark: SparkSession, metadata_json: DataFrame, col: str = "value") -> DataFrame:
    """Importance table from JSON metadata (S23): the first present key holding either
    {feature: number}, {feature: {field: value}} or [{...}] is turned into rows and
    normalised (A19)."""
    raw = F.coalesce(*[F.get_json_object(F.col(col), f"$.{k}") for k in METADATA_KEYS])
    j = metadata_json.select(raw.alias("raw")).where(F.col("raw").isNotNull())
    as_list = F.from_json("raw", "array<map<string,string>>")
    as_map = F.from_json("raw", "map<string,string>")
    rows_list = j.where(F.col("raw").startswith("[")).select(F.explode(as_list).alias("m"))
    pairs = j.where(~F.col("raw").startswith("[")).select(F.explode(as_map).alias("feature", "v"))
    nested = F.from_json("v", "map<string,string>")
    from_map = pairs.select(
        F.col("feature"),
        F.when(F.col("v").startswith("{"), F.coalesce(*[nested.getItem(c) for c in IM.IMPORTANCE_COLUMN_CANDIDATES]))
         .otherwise(F.col("v")).alias("importance"),
        F.when(F.col("v").startswith("{"), F.coalesce(*[nested.getItem(c) for c in IM.PCT_COLUMN_CANDIDATES])).alias("importance_pct"))
    from_list = rows_list.select(
        F.coalesce(*[F.col("m").getItem(c) for c in IM.FEATURE_COLUMN_CANDIDATES]).alias("feature"),
        F.coalesce(*[F.col("m").getItem(c) for c in IM.IMPORTANCE_COLUMN_CANDIDATES]).alias("importance"),
        F.coalesce(*[F.col("m").getItem(c) for c in IM.PCT_COLUMN_CANDIDATES]).alias("importance_pct"))
    both = from_map.unionByName(from_list)
    has_pct = both.where(F.col("importance_pct").isNotNull()).limit(1).count() > 0
    return IM.normalise_importance(both if has_pct else both.drop("importance_pct"))


def load_importance(spark: SparkSession, metadata_json: DataFrame | None, candidates: list) -> DataFrame:
    """Importance from metadata, else from the first non-empty candidate file, else
    empty (S24)."""
    if metadata_json is not None:
        m = importance_from_metadata(spark, metadata_json)
        if m.limit(1).count() > 0:
            return m
    for c in candidates:
        if _exists(spark, c):
            df = read_csv(spark, c)
            if df.limit(1).count() > 0:
                return IM.normalise_importance(df)
    return spark.createDataFrame([], "feature string, importance double, importance_pct double, "
                                     "cumulative_importance_pct double")
