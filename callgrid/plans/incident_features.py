"""Feature columns of the incident table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar as cal
from ..functions.numeric import fill, safe_ratio, sum_cols
from ..functions.text import geoid as strip_geoid
from ..operators.aggregates import WEATHER_EVENTS, daily_event_pivot, daily_pivot, daily_threshold
from ..operators.features import FeatureSet
from ..operators.filters import refused
from ..operators.joins import join_daily, lookup_by_year, near_date_flag
from ..operators.windows import change_vs_delayed, count_last, delayed_feature, prior_count, sum_last

INCIDENT_FEATURES = FeatureSet()
_feature = INCIDENT_FEATURES.feature

TS, KEY, STATION = "time_created", "incident", "station_name"
DAY, WEEK = 86_400, 604_800

# Census tables, the first year each is used for, and the columns that make up each measure.
CENSUS = {
    "acs_income": ("B19013", 2010, ["b19013001"], None),
    "acs_age": ("B01002", 2010, ["b01002001"], None),
    "acs_no_insurance": ("B27010", 2013, ["b27010017", "b27010033", "b27010050", "b27010066"], "b27010001"),
    "acs_edu": ("B15003", 2012, ["b15003022", "b15003023", "b15003024", "b15003025"], "b15003001"),
    "acs_white": ("B02001", 2010, ["b02001002"], "b02001001"),
    "acs_black": ("B02001", 2010, ["b02001003"], "b02001001"),
}


def _census(name: str):
    table, floor, parts, total = CENSUS[name]

    def build(df: DataFrame, context: dict) -> DataFrame:
        measure: Column = F.col(parts[0]) if total is None else safe_ratio(sum_cols(parts), total)
        ref = context["census"][table].select(
            F.col("year").alias("census_year"), strip_geoid("geoid").alias("geoid"), measure.alias(name)
        )
        return lookup_by_year(df, ref, "time_year", "geoid", "census_year", 2, floor)

    return build


for _name in CENSUS:
    _feature(_name, lookup=True)(_census(_name))


@_feature("weekday")
def weekday(df, context):
    return cal.weekday0(TS)


@_feature("time_weekend")
def time_weekend(df, context):
    return cal.is_weekend(TS)


@_feature("time_of_day")
def time_of_day(df, context):
    return cal.day_part(F.hour(TS))


@_feature("is_holiday")
def is_holiday(df, context):
    return cal.is_holiday(TS)


@_feature("building_type")
def building_type(df, context):
    return fill("call_type", "other")


@_feature("incident_duration")
def incident_duration(df, context):
    return cal.minutes_between(TS, "time_closed")


@_feature("trns_or_refused", lookup=True)
def trns_or_refused(df, context):
    flagged = refused(df, "comments", "trns_or_refused")
    return flagged.withColumn("trns_or_refused", F.col("trns_or_refused") | F.col("trns_to_hosp"))


@_feature("within_1day_full_moon", lookup=True, daily=True)
def within_1day_full_moon(df, context):
    full = context["moon"].where(F.col("phase") == "Full Moon")
    return near_date_flag(df, full, TS, "date", 1, "within_1day_full_moon")


def _measured(context: dict) -> DataFrame:
    """Measurements within the days of the incidents."""
    return context["weather"].where(F.col("date").between(F.lit(context["first_day"]), F.lit(context["last_day"])))


def _prefixed(daily: DataFrame, prefix: str) -> DataFrame:
    return daily.withColumnsRenamed({c: f"{prefix}_{c}" for c in daily.columns if c != "date"})


def _join_filled(df: DataFrame, daily: DataFrame) -> DataFrame:
    new = [c for c in daily.columns if c != "date"]
    return join_daily(df, daily, TS).na.fill(0.0, new)


@_feature("common_weather", lookup=True, daily=True)
def common_weather(df, context):
    """One column per measured kind; `context["weather_kinds"]` lists the kinds, so that no job is needed to find them."""
    weather = _measured(context).where(~F.col("datatype").startswith("WT"))
    return _join_filled(df, _prefixed(daily_pivot(weather, "date", "datatype", "value", context["weather_kinds"]), "common_weather"))


@_feature("weather_event", lookup=True, daily=True)
def weather_event(df, context):
    weather = _measured(context)
    return _join_filled(df, _prefixed(daily_event_pivot(weather, "date", "datatype", "value", WEATHER_EVENTS), "weather_event"))


@_feature("temp_above", lookup=True, daily=True)
def temp_above(df, context):
    hot = context["weather"].where(F.col("datatype") == "TMAX")
    return join_daily(df, daily_threshold(hot, "date", "value", "max", ">=", 90, "temp_above"), TS)


@_feature("temp_below", lookup=True, daily=True)
def temp_below(df, context):
    cold = context["weather"].where(F.col("datatype") == "TMIN")
    return join_daily(df, daily_threshold(cold, "date", "value", "min", "<=", 25, "temp_below"), TS)


@_feature("relative_max_temperature", needs="common_weather", daily=True)
def relative_max_temperature(df, context):
    return change_vs_delayed(df, TS, "common_weather_tmax", 7, "relative_max_temperature")


@_feature("relative_min_temperature", needs="common_weather", daily=True)
def relative_min_temperature(df, context):
    return change_vs_delayed(df, TS, "common_weather_tmin", 7, "relative_min_temperature")


def _transports(name: str, days: int, agg: str, group=None, roll: int = 1):
    @_feature(name)
    def build(df, context):
        counted = df.withColumn("__trns", F.col("trns_to_hosp").cast("int"))
        return delayed_feature(counted, TS, "__trns", days, agg, group, roll, name).drop("__trns")

    return build


frac_trans_1day = _transports("frac_trans_1day", 1, "mean")
frac_trans_1week = _transports("frac_trans_1week", 7, "mean")
total_transports_1month = _transports("total_transports_1month", 1, "sum", roll=30)
total_transports_1day_bystation = _transports("total_transports_1day_bystation", 1, "sum", STATION)
total_transports_lastweek_bystation = _transports("total_transports_lastweek_bystation", 1, "sum", STATION, 7)
total_transports_lastweek_bycode = _transports("total_transports_lastweek_bycode", 1, "sum", "code_type", 7)


@_feature("total_transports_lasthour")
def total_transports_lasthour(df, context):
    """Transports in the hour of the clock before the incident's hour."""
    hour = F.date_trunc("hour", TS)
    hourly = df.groupBy(hour.alias("__hour")).agg(F.sum(F.col("trns_to_hosp").cast("int")).alias("total_transports_lasthour"))
    following = hourly.withColumn("__hour", F.col("__hour") + F.expr("interval 1 hour"))
    joined = df.withColumn("__hour", hour).join(following, "__hour", "left").drop("__hour")
    return joined.na.fill(0, ["total_transports_lasthour"])


@_feature("operator_experience")
def operator_experience(df, context):
    return prior_count(df, "operator_name", [TS, KEY], "operator_experience")


@_feature("repeated_loc_24h")
def repeated_loc_24h(df, context):
    return count_last(df, ["x", "y"], TS, DAY, "repeated_loc_24h")


def _station_lag(name: str, seconds: int, transports: bool):
    @_feature(name)
    def build(df, context):
        value = F.col("trns_to_hosp").cast("bigint") if transports else F.lit(1).cast("bigint")
        return sum_last(df, STATION, TS, value, seconds, name)

    return build


lag_24h_station_incidents = _station_lag("lag_24h_station_incidents", DAY, False)
lag_24h_station_trns = _station_lag("lag_24h_station_trns", DAY, True)
lag_1w_station_incidents = _station_lag("lag_1w_station_incidents", WEEK, False)
lag_1w_station_trns = _station_lag("lag_1w_station_trns", WEEK, True)
