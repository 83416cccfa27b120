"""One row per hour and station, with counts of incidents and of flags, 0 where nothing happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.base import Col, as_list, col
from ..functions.calendar import date_parts, series_key
from ..operators.aggregates import daily_rollup, hourly_demand
from ..operators.joins import spine, zero_fill
from ..operators.series import label_lags

FLAGS = ("trns_to_hosp", "m_required", "m_sent")


def demand_table(
    incidents: DataFrame,
    stations: DataFrame,
    start: Col,
    end: Col,
    group: str = "station_name",
    ts: str = "time_created",
    flags=FLAGS,
) -> DataFrame:
    """Hourly demand of every station from `start` to `end`, both included."""
    counts = hourly_demand(incidents, ts, group, flags)
    hours = spine(stations.select(group).where(F.col(group).isNotNull()).distinct(), start, end)
    filled = zero_fill(hours, counts, ["time_created", group], ["total_incidents", *as_list(flags)])
    return filled.select(
        series_key("time_created", group).alias("pk_demand"),
        "time_created",
        group,
        *date_parts("time_created"),
        "total_incidents",
        *as_list(flags),
    )


def observed_hours(incidents: DataFrame, ts: str = "time_created") -> tuple[Column, Column]:
    """First and last hour of the data, as scalars for `demand_table`."""
    ends = incidents.agg(F.date_trunc("hour", F.min(ts)).alias("a"), F.date_trunc("hour", F.max(ts)).alias("b"))
    return ends.select("a").scalar(), ends.select("b").scalar()


def daily_samples(
    demand: DataFrame,
    label: str = "trns_to_hosp",
    lags=(1, 7),
    sums=("m_required", "trns_to_hosp"),
    group: str = "station_name",
    ts: str = "time_created",
    means=(),
) -> DataFrame:
    """Daily rows per station for the regressors: sums, means, a key and the label's lags."""
    day = daily_rollup(demand, col(ts), group, sums, means)
    keyed = day.withColumn("demand_key", series_key("day", group))
    return label_lags(keyed, "day", group, label, lags)
