"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .base import Col, col, micros


def date_parts(ts: Col) -> list[Column]:
    t = col(ts)
    return [
        F.year(t).alias("time_year"),
        F.month(t).alias("time_month"),
        F.dayofmonth(t).alias("time_day"),
        F.hour(t).alias("time_hour"),
    ]


def hour_of(ts: Col) -> Column:
    return F.date_trunc("hour", col(ts))


def day_of(ts: Col) -> Column:
    return F.to_date(col(ts))


def weekday0(ts: Col) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(col(ts))


def is_weekend(ts: Col) -> Column:
    return weekday0(ts) > 4


def day_part(hour: Col) -> Column:
    h = col(hour)
    return (
        F.when((h >= 7) & (h < 13), "7a-1p")
        .when((h >= 13) & (h < 19), "1p-7p")
        .when((h >= 19) | (h < 1), "7p-1a")
        .otherwise("1a-7a")
    )


def iso_week(ts: Col) -> Column:
    return F.weekofyear(col(ts))


def _nth_weekday(day: Column, month: int, weekday: int, nth: int) -> Column:
    """`day` is the nth given weekday of the month; nth = -1 is the last one of a 31-day month."""
    first = 25 if nth < 0 else 7 * (nth - 1) + 1
    return (
        (F.month(day) == month)
        & (F.weekday(day) == weekday)
        & F.dayofmonth(day).between(first, 31 if nth < 0 else first + 6)
    )


def is_holiday(day: Col) -> Column:
    """Federal and state holidays, with the day after Thanksgiving and the Monday after a weekend Christmas."""
    d = F.to_date(col(day))
    month_day = F.month(d) * 100 + F.dayofmonth(d)
    fixed = month_day.isin(101, 704, 1225)
    after_weekend_christmas = month_day.isin(1226, 1227) & (F.weekday(d) == 0)
    # month, weekday (Monday = 0), which one: King, Presidents, Memorial, Labour, Columbus, Thanksgiving
    moving = [(1, 0, 3), (2, 0, 3), (5, 0, -1), (9, 0, 1), (10, 0, 2), (11, 3, 4)]
    out = fixed | after_weekend_christmas | _nth_weekday(F.date_sub(d, 1), 11, 3, 4)
    for month, weekday, nth in moving:
        out = out | _nth_weekday(d, month, weekday, nth)
    return out


def ts_sequence(start: Col, end: Col, step: str = "1 hour") -> Column:
    """One row per step from start to end, both included."""
    return F.explode(F.sequence(col(start), col(end), F.expr(f"interval {step}")))


def series_key(ts: Col, group: Col) -> Column:
    return F.concat_ws("_", F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss"), col(group).cast("string"))


def minutes_between(start: Col, end: Col) -> Column:
    return (micros(end) - micros(start)) / F.lit(60_000_000.0)


def text_to_timestamp(c: Col) -> Column:
    """`2015-08-16 23:59:59`, with any mix of blank, dash and colon between the six numbers."""
    parts = F.split(F.trim(F.translate(col(c).cast("string"), "-:", "  ")), r"\s+")
    number = lambda i: F.lpad(F.get(parts, F.lit(i)), 4 if i == 0 else 2, "0")
    return F.try_to_timestamp(F.concat(*[number(i) for i in range(6)]), F.lit("yyyyMMddHHmmss"))


def intdate_to_datetime(c: Col) -> Column:
    """20150816235959 as a number to a timestamp."""
    return F.try_to_timestamp(col(c).cast("bigint").cast("string"), F.lit("yyyyMMddHHmmss"))
