"""Hourly demand kept up to date as incidents arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.base import as_list, count_if
from .trailing import END_OF_TIME, watermarked


def hourly_demand_stream(
    incidents: DataFrame, ts: str, group: str, flags=(), lateness: str = "2 hours", total: str = "total_incidents"
) -> DataFrame:
    """As `operators.aggregates.hourly_demand`, on a stream: an hour is emitted once nothing for it can arrive any more.

    State is one row per open (hour, group), whatever the number of incidents.
    """
    dated = incidents.withColumn(ts, F.col(ts).cast("timestamp"))
    dated = dated.where(F.col(group).isNotNull() | (F.col(ts) >= F.lit(END_OF_TIME).cast("timestamp")))
    return (
        watermarked(dated, ts, lateness)
        .groupBy(F.window(ts, "1 hour").alias("__w"), F.col(group))
        .agg(F.count(F.lit(1)).alias(total), *[count_if(f).alias(f) for f in as_list(flags)])
        .select(F.col("__w.start").alias("time_created"), group, total, *as_list(flags))
    )
