"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..functions.base import as_list


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs).distinct()


def common_keys(a: DataFrame, b: DataFrame, key) -> DataFrame:
    keys = as_list(key)
    return a.select(*keys).intersect(b.select(*keys))


def complement(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Keys of a that b does not have."""
    keys = as_list(key)
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), keys, "left_anti")
