"""Calendar and number expressions."""

from pyspark.sql import functions as F

from ..functions import calendar as cal, numeric as num
from .base import DISPATCHES, INCIDENTS, query


@query(
    "date_parts",
    """
    SELECT event_id, year(ts) AS time_year, month(ts) AS time_month, day(ts) AS time_day, hour(ts) AS time_hour,
           strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_of, strftime(ts, '%Y-%m-%d') AS day_of
    FROM events
    """,
)
def _(t):
    return t.events.select("event_id", *cal.date_parts("ts"), cal.hour_of("ts").alias("hour_of"), cal.day_of("ts").alias("day_of"))


@query(
    "weekday_weekend_week",
    """
    SELECT o_orderkey, isodow(o_orderdate) - 1 AS weekday, cast(isodow(o_orderdate) > 5 AS int) AS time_weekend,
           week(o_orderdate) AS iso_week
    FROM orders
    """,
)
def _(t):
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", cal.weekday0(d).alias("weekday"), cal.is_weekend(d).alias("time_weekend"), cal.iso_week(d).alias("iso_week")
    )


@query(
    "time_of_day",
    """
    SELECT CASE WHEN hour(ts) BETWEEN 7 AND 12 THEN '7a-1p' WHEN hour(ts) BETWEEN 13 AND 18 THEN '1p-7p'
                WHEN hour(ts) >= 19 OR hour(ts) = 0 THEN '7p-1a' ELSE '1a-7a' END AS time_of_day, count(*) AS n
    FROM events GROUP BY 1
    """,
)
def _(t):
    return t.events.groupBy(cal.day_part(F.hour("ts")).alias("time_of_day")).agg(F.count("*").alias("n"))


HOLIDAY_SQL = """
  (month(d) = 12 AND day(d) = 25) OR (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4)
  OR (month(d) = 1 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21)
  OR (month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21)
  OR (month(d) = 5 AND isodow(d) = 1 AND day(d) >= 25)
  OR (month(d) = 9 AND isodow(d) = 1 AND day(d) <= 7)
  OR (month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14)
  OR (month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28)
  OR (month(d) = 11 AND isodow(d) = 5 AND day(d) BETWEEN 23 AND 29)
  OR (month(d) = 12 AND isodow(d) = 1 AND day(d) IN (26, 27))
"""


@query(
    "is_holiday",
    f"""
    SELECT strftime(d, '%Y-%m-%d') AS day, cast({HOLIDAY_SQL} AS int) AS is_holiday, count(*) AS n
    FROM (SELECT cast(o_orderdate AS date) AS d FROM orders) GROUP BY ALL
    """,
)
def _(t):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return days.select("day", cal.is_holiday("day").alias("is_holiday"), "n")


@query(
    "ts_sequence",
    """
    SELECT event_type, strftime(t, '%Y-%m-%d %H:%M:%S') AS t
    FROM (SELECT event_type, unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS t
          FROM events GROUP BY event_type)
    """,
)
def _(t):
    hour = F.date_trunc("hour", "ts")
    ends = t.events.groupBy("event_type").agg(F.min(hour).alias("a"), F.max(hour).alias("b"))
    return ends.select("event_type", cal.ts_sequence("a", "b").alias("t"))


@query(
    "series_key",
    f"WITH {INCIDENTS} SELECT incident, strftime(date_trunc('hour', time_created), '%Y-%m-%d %H:%M:%S') || '_' || station_name AS pk FROM incidents",
)
def _(t):
    return t.incidents.select("incident", cal.series_key(cal.hour_of("time_created"), "station_name").alias("pk"))


@query(
    "minutes_between",
    f"""
    WITH {DISPATCHES}
    SELECT event, unit, line, l_partkey, round(epoch_us(clear - sent) / 6e7, 6) AS minutes
    FROM (SELECT *, sent AS s FROM dispatches)
    """.replace("epoch_us(clear - sent)", "(epoch_us(clear) - epoch_us(sent))"),
)
def _(t):
    return t.dispatches.select("event", "unit", "line", "l_partkey", cal.minutes_between("sent", "clear").alias("minutes"))


@query(
    "timestamps_from_numbers_and_text",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS from_number,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS from_text
    FROM orders
    """,
)
def _(t):
    number = F.date_format("o_orderdate", "yyyyMMddHHmmss").cast("bigint")
    text = F.date_format("o_orderdate", "yyyy-M-d H:m:s")
    return t.orders.select(
        "o_orderkey", cal.intdate_to_datetime(number).alias("from_number"), cal.text_to_timestamp(text).alias("from_text")
    )


@query(
    "safe_ratio_and_sums",
    """
    SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE round(value / (user_id % 3), 6) END AS ratio,
           round(value + user_id + event_id, 6) AS total, CASE WHEN event_type = 'error' THEN 'other' ELSE event_type END AS filled
    FROM events
    """,
)
def _(t):
    known = F.when(F.col("event_type") != "error", F.col("event_type"))
    return t.events.select(
        "event_id",
        num.safe_ratio("value", F.col("user_id") % 3).alias("ratio"),
        num.sum_cols(["value", "user_id", "event_id"]).alias("total"),
        num.fill(known).alias("filled"),
    )


@query(
    "percentiles_per_type",
    "SELECT event_type, round(quantile_cont(value, 0.445), 6) AS p FROM events GROUP BY 1",
)
def _(t):
    return t.events.groupBy("event_type").agg(num.pct("value", 0.445).alias("p"))
