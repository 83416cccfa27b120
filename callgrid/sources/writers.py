"""Tables, exports and the model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.base import as_list
from ..functions.model_json import REGISTRY_FIELDS, feature_importances, importance_map, metric_at, parse_model_json, sort_by_abs
from ..functions.text import shorten_names, spec_hash

MODES = {"fail": "error", "replace": "overwrite", "append": "append"}


def write_table(df: DataFrame, path: str, if_exists: str = "fail", pk=None, partition_by=(), fmt: str = "parquet") -> None:
    """Write files; with `pk`, only if the key is present and unique."""
    if pk:
        require_key(df, pk)
    writer = df.write.mode(MODES[if_exists]).format(fmt)
    (writer.partitionBy(*as_list(partition_by)) if partition_by else writer).save(path)


def save_table(df: DataFrame, name: str, if_exists: str = "fail", pk=None, bucket_by=None) -> None:
    """Write a catalog table; `bucket_by` is (buckets, columns) and spares later joins on them their shuffle."""
    if pk:
        require_key(df, pk)
    writer = df.write.mode(MODES[if_exists])
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *as_list(bucket_by[1])).sortBy(*as_list(bucket_by[1]))
    writer.saveAsTable(name)


def require_key(df: DataFrame, pk) -> None:
    """Raise when the key has NULLs or repeats."""
    keys = as_list(pk)
    missing = " or ".join(f"`{k}` is null" for k in keys)
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(f"__n > 1 or {missing}").limit(1).count()
    if bad:
        raise ValueError(f"{keys} is no key: a value is missing or repeated")


def copy_table(spark: SparkSession, table: str, schema_from: str, schema_to: str) -> str | None:
    """Copy a catalog table under its lower-case name; one without columns, or one that exists, is skipped."""
    source = spark.table(f"{schema_from}.{table}")
    target = f"{schema_to}.{table.lower()}"
    if not source.columns or spark.catalog.tableExists(target):
        return None
    source.write.saveAsTable(target)
    return target


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, path: str, sep: str = "|", if_exists: str = "replace") -> None:
    df.write.mode(MODES[if_exists]).option("header", True).option("sep", sep).csv(path)


def export_dictionary(df: DataFrame, folder: str, key: str, suggested: str, required: str) -> None:
    """Three tables: everything, the new dictionary, and the codes that change."""
    write_table(df, f"{folder}/full_data", "replace")
    write_table(df.select(key, suggested), f"{folder}/new_dictionary", "replace")
    write_table(df.where(~F.col(suggested).eqNullSafe(F.col(required))), f"{folder}/all_changes", "replace")


def registry_entry(df: DataFrame) -> DataFrame:
    """Rows of label, model_spec, model_metrics, ... as (timestamp, id, json, pickle) registry rows.

    `model_metrics` is an array of (k, array of numbers) structs, `model_feats_imps` one of (feature, importance).
    """
    metrics = F.transform("model_metrics", lambda m: F.array(m["k"].cast("string"), F.to_json(m["values"])))
    pairs = F.transform("model_feats_imps", lambda p: F.array(p["feature"], p["importance"].cast("string")))
    sources = {"MODEL METRICS": metrics, "MODEL FEATS & IMPS": pairs}
    fields = [
        sources.get(name, F.col(name.lower().replace(" ", "_"))).alias(name) for name in REGISTRY_FIELDS
    ]
    return df.select(
        F.col("timestamp"), F.col("model_spec").alias("id"), F.to_json(F.struct(*fields)).alias("json"), F.col("path").alias("pickle")
    )


def append_registry(df: DataFrame, path: str) -> None:
    write_table(registry_entry(df), path, "append")


def write_scores(df: DataFrame, path: str) -> None:
    """Score rows (model_hash, split, key, score), one folder per model and split."""
    write_table(df, path, "append", partition_by=["model_hash", "split"])


def load_registry(spark: SparkSession, path: str, subset=None, k_values=(5, 30, 60, 90)) -> DataFrame:
    return expand_registry(spark.read.parquet(path), subset, k_values)


def expand_registry(registry: DataFrame, subset=None, k_values=(5, 30, 60, 90)) -> DataFrame:
    """One wide row per trained model, optionally only those from a time on.

    Columns of the JSON, features alphabetically and by importance, p/r/auc/wsc per cut, hashes and short names.
    """
    if subset is not None:
        registry = registry.where(F.col("timestamp") >= F.lit(subset))
    parsed = registry.select(parse_model_json("json").alias("m")).select("m.*")
    pairs = feature_importances("model_feats_imps")
    metrics = {
        f"{name}_{k}": metric_at("model_metrics", i, name) for i, k in enumerate(k_values) for name in ("p", "r", "auc", "wsc")
    }
    wide = parsed.withColumns(
        {
            "features_list_alpha": F.transform(pairs, lambda p: p["feature"]),
            "importance_list_alpha": F.transform(pairs, lambda p: p["importance"]),
            "features_sorted": sort_by_abs(pairs),
            "importance": importance_map("model_feats_imps"),
            **metrics,
        }
    )
    return wide.withColumns(
        {
            "feature_hash": F.md5(F.array_join("features_list_alpha", " ")),
            "model_hash": spec_hash(["model_spec"]),
            "model_str": shorten_names("model_spec"),
            "weights_str": F.concat(F.lit("["), F.array_join(F.col("weights").cast("array<string>"), ", "), F.lit("]")),
        }
    )
