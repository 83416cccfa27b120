"""Trailing and delayed features."""

from pyspark.sql import functions as F

from ..operators import windows as w
from .base import INCIDENTS, query


def _delayed_sql(agg: str, days: int, roll: int, group: str | None) -> str:
    """Delayed feature over a dense day x group calendar, the definition itself."""
    g = f", {group}" if group else ""
    on = f"AND v.{group} = q.{group}" if group else ""
    first = f"AND f.{group} = q.{group}" if group else ""
    imputed = (
        f"(SELECT cast(greatest(least(q.day - {days}, m.first - 1) - greatest(q.day - {days + roll - 1}, m.first - {days}) + 1, 0) AS double))"
    )
    return f"""
    daily AS (SELECT cast(time_created AS date) AS day{g}, {agg} AS v FROM incidents GROUP BY ALL),
    m AS (SELECT min(day) AS first FROM daily),
    known AS (
      SELECT q.day{', q.' + group if group else ''},
             coalesce((SELECT sum(v.v) FROM daily v WHERE v.day BETWEEN q.day - {days + roll - 1} AND q.day - {days} {on}), 0)
             + {imputed} * coalesce((SELECT f.v FROM daily f WHERE f.day = m.first {first}), 0) AS delayed
      FROM daily q, m)
    """


@query(
    "frac_trans_1week",
    f"""
    WITH {INCIDENTS}, {_delayed_sql('avg(trns_to_hosp::int)', 7, 1, None)}
    SELECT incident, round(delayed, 6) AS delayed FROM incidents JOIN known ON day = cast(time_created AS date)
    """,
)
def _(t):
    rows = t.incidents.withColumn("y", F.col("trns_to_hosp").cast("int"))
    return w.delayed_feature(rows, "time_created", "y", 7, "mean").select("incident", "delayed")


@query(
    "total_transports_1month",
    f"""
    WITH {INCIDENTS}, {_delayed_sql('sum(trns_to_hosp::int)', 1, 30, None)}
    SELECT incident, cast(delayed AS bigint) AS delayed FROM incidents JOIN known ON day = cast(time_created AS date)
    """,
)
def _(t):
    rows = t.incidents.withColumn("y", F.col("trns_to_hosp").cast("int"))
    return w.delayed_feature(rows, "time_created", "y", 1, "sum", roll=30).select("incident", "delayed")


@query(
    "total_transports_lastweek_by_station",
    f"""
    WITH {INCIDENTS}, {_delayed_sql('sum(trns_to_hosp::int)', 1, 7, 'station_name')}
    SELECT incident, cast(delayed AS bigint) AS delayed
    FROM incidents i JOIN known k ON k.day = cast(time_created AS date) AND k.station_name = i.station_name
    """,
)
def _(t):
    rows = t.incidents.withColumn("y", F.col("trns_to_hosp").cast("int"))
    return w.delayed_feature(rows, "time_created", "y", 1, "sum", "station_name", 7).select("incident", "delayed")


@query(
    "total_transports_by_code",
    f"""
    WITH {INCIDENTS}, {_delayed_sql('sum(trns_to_hosp::int)', 2, 3, 'code_type')}
    SELECT incident, cast(delayed AS bigint) AS delayed
    FROM incidents i JOIN known k ON k.day = cast(time_created AS date) AND k.code_type = i.code_type
    """,
)
def _(t):
    rows = t.incidents.withColumn("y", F.col("trns_to_hosp").cast("int"))
    return w.delayed_feature(rows, "time_created", "y", 2, "sum", "code_type", 3).select("incident", "delayed")


@query(
    "change_vs_median_a_week_ago",
    f"""
    WITH {INCIDENTS}, {_delayed_sql('median(value)', 7, 1, None)}
    SELECT incident, round(value - delayed, 6) AS change FROM incidents JOIN known ON day = cast(time_created AS date)
    """,
)
def _(t):
    return w.change_vs_delayed(t.incidents, "time_created", "value").select("incident", "change")


@query(
    "operator_experience",
    """
    SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS prior FROM events
    """,
)
def _(t):
    return w.prior_count(t.events, "user_id", ["ts", "event_id"]).select("event_id", "prior")


@query(
    "operator_experience_in_buckets",
    """
    SELECT event_id, row_number() OVER (PARTITION BY user_id % 2 ORDER BY ts, event_id) - 1 AS prior FROM events
    """,
)
def _(t):
    rows = t.events.withColumn("half", F.col("user_id") % 2)
    return w.prior_count(rows, "half", ["ts", "event_id"], n=8).select("event_id", "prior")


_DAY = "range BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING"
_WEEK = "range BETWEEN INTERVAL 168 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING"


@query(
    "repeated_location_24h",
    f"SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts {_DAY}) AS trailing FROM events",
)
def _(t):
    return w.count_last(t.events, "user_id", "ts").select("event_id", "trailing")


@query(
    "repeated_location_24h_of_two_keys",
    f"SELECT event_id, count(*) OVER (PARTITION BY user_id % 2 ORDER BY ts {_DAY}) AS trailing FROM events",
)
def _(t):
    rows = t.events.withColumn("half", F.col("user_id") % 2)
    return w.count_last(rows, "half", "ts").select("event_id", "trailing")


_PRICES = """
    SELECT l_orderkey, l_linenumber, round(coalesce(sum(l_extendedprice) OVER (PARTITION BY {key} ORDER BY l_shipdate
           range BETWEEN INTERVAL 168 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 0), 3) AS trailing FROM lineitem
    """


@query("sum_last_double", _PRICES.format(key="l_suppkey"), digits=3)
def _(t):
    return w.sum_last(t.lineitem, "l_suppkey", "l_shipdate", "l_extendedprice", 604800).select("l_orderkey", "l_linenumber", "trailing")


@query("sum_last_double_of_one_key", _PRICES.format(key="l_linenumber > 0"), digits=3)
def _(t):
    rows = t.lineitem.withColumn("all", F.col("l_linenumber") > 0)
    return w.sum_last(rows, "all", "l_shipdate", "l_extendedprice", 604800).select("l_orderkey", "l_linenumber", "trailing")


@query(
    "station_lags",
    f"""
    WITH {INCIDENTS}
    SELECT incident, count(*) OVER (PARTITION BY station_name ORDER BY time_created {_DAY}) AS incidents_24h,
           cast(coalesce(sum(trns_to_hosp::int) OVER (PARTITION BY station_name ORDER BY time_created {_DAY}), 0) AS bigint) AS trns_24h,
           count(*) OVER (PARTITION BY station_name ORDER BY time_created {_WEEK}) AS incidents_1w,
           cast(coalesce(sum(trns_to_hosp::int) OVER (PARTITION BY station_name ORDER BY time_created {_WEEK}), 0) AS bigint) AS trns_1w
    FROM incidents
    """,
)
def _(t):
    y, one = F.col("trns_to_hosp").cast("bigint"), F.lit(1).cast("bigint")
    sums = {"incidents_24h": (one, 86400), "trns_24h": (y, 86400), "incidents_1w": (one, 604800), "trns_1w": (y, 604800)}
    return w.sums_last(t.incidents, "station_name", "time_created", sums).select("incident", *sums)
