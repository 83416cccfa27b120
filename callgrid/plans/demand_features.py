"""Feature columns of the hourly demand table, and daily samples with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.features import FeatureSet, FeatureSpec
from .demand import daily_samples
from .incident_features import CENSUS, INCIDENT_FEATURES

# The features of an (hour, station) row that are used by default, with their kinds, and those that are not.
USED = {
    "weekday": "cat", "time_year": "cat", "m_required": "float", "trns_to_hosp": "float", "time_of_day": "cat",
    "within_1day_full_moon": "bool", "common_weather": "float", "weather_event": "float", "station_name": "cat",
    "time_month": "cat", "time_day": "cat", "temp_above": "bool", "temp_below": "bool", "time_weekend": "bool",
    "relative_max_temperature": "float", "relative_min_temperature": "float",
}
UNUSED = {**dict.fromkeys(CENSUS, "float"), "common_weather_tmax": "float"}

#: What the incident features compute from a time, a place's census key and daily tables holds for hours and stations too.
_SHARED = [n for n in (*USED, *UNUSED) if n in INCIDENT_FEATURES.functions]
DEMAND_FEATURES = FeatureSet(
    {n: INCIDENT_FEATURES.functions[n] for n in _SHARED},
    {n: INCIDENT_FEATURES.needs[n] for n in _SHARED},
    {n for n in _SHARED if n in INCIDENT_FEATURES.lookups},
    {n for n in _SHARED if n in INCIDENT_FEATURES.daily},
)


def demand_specs() -> list[FeatureSpec]:
    return [FeatureSpec(n, k) for n, k in USED.items()] + [FeatureSpec(n, k, incl=False) for n, k in UNUSED.items()]


def demand_features(
    demand: DataFrame, context: dict, specs: list[FeatureSpec] | None = None, pk: str = "pk_demand", store: bool = True
) -> DataFrame:
    """The key and all wanted features of the demand table; `context` holds weather, weather_kinds, moon (and census).

    The table is written before it is read, unless `store` is off because it has been already.
    """
    return DEMAND_FEATURES.apply(demand, demand_specs() if specs is None else specs, pk, context, store)


def daily_feature_samples(
    demand: DataFrame, features: DataFrame, label: str = "trns_to_hosp", lags=(1, 7), pk: str = "pk_demand"
) -> tuple[DataFrame, list[str]]:
    """(daily rows per station, names of the predictors): sums of the counts, means of the other features, label lags.

    Times of day are text and have no mean; year, month and day tell the rows apart.
    """
    counts = ("m_required", "trns_to_hosp")
    apart = {pk, "station_name", "time_year", "time_month", "time_day", *counts}
    numeric = (T.NumericType, T.BooleanType)
    means = [f.name for f in features.schema if f.name not in apart and isinstance(f.dataType, numeric)]
    plain = features.select(pk, *[F.col(c).cast("double").alias(c) for c in means])
    rows = demand.select(pk, "time_created", "station_name", *counts).join(plain, pk)
    days = daily_samples(rows, label, lags, counts, means=means)
    return days, [*[f"{label}_lag{k}" for k in lags], "m_required", *means]
