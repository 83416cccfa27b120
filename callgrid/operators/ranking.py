"""Sorts, top-k and thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.base import as_list
from .ordered import bucket_count, running_sum


def order_desc(df: DataFrame, column: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(column), *ties)


def top_n(df: DataFrame, column: str, n: int = 10, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(column), *ties).limit(n)


def order_limit(df: DataFrame, cols, n: int = 100) -> DataFrame:
    return df.orderBy(*as_list(cols)).limit(n)


def top_n_with_other(df: DataFrame, key: str, value: str, n: int, other: str = "other") -> DataFrame:
    """The n largest shares and one row with what they leave of 1."""
    top = top_n(df.select(F.col(key).cast("string").alias(key), F.col(value).alias(value)), value, n, key)
    rest = top.agg((1 - F.coalesce(F.sum(value), F.lit(0.0))).alias(value)).select(F.lit(other).alias(key), value)
    return top.unionByName(rest)


def best_per_group(df: DataFrame, group, score: str, *ties: str, largest: bool = False) -> DataFrame:
    """The row with the lowest (or largest) score of each group; a task sends at most one row per group."""
    first = F.desc(score) if largest else F.asc_nulls_last(score)
    w = W.partitionBy(*as_list(group)).orderBy(first, *ties)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def kth_largest(df: DataFrame, column: str, k: float, out: str = "threshold", n: int | None = None) -> DataFrame:
    """The value at position int(k * rows) of the values sorted from the largest, as one row."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("__down", -F.col("value"))
    )
    ranked = running_sum(counts, "n", ["__down"], out="upto", total="rows", n=n or bucket_count(df))
    at = F.floor(F.lit(float(k)) * F.col("rows"))
    return ranked.agg(F.max(F.when(F.col("upto") > at, F.col("value"))).alias(out))


def random_pick(df: DataFrame, n: int = 10, seed: int = 0, key=None) -> DataFrame:
    """n rows chosen by a hash of the seed and the key columns (all by default), whatever the partitions."""
    cols = as_list(key) or df.columns
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return df.orderBy(F.md5(text), *cols).limit(n)
