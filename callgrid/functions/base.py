"""Small helpers shared by every module."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Col = Column | str


def col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(names) -> list:
    if names is None:
        return []
    return [names] if isinstance(names, (str, Column)) else list(names)


def micros(ts: Col) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone."""
    return F.unix_micros(col(ts).cast("timestamp"))


def flag(c: Col) -> Column:
    """1 where the boolean is true, 0 where it is false or NULL."""
    return F.coalesce(col(c).cast("boolean"), F.lit(False)).cast("int")


def count_if(cond: Col) -> Column:
    return F.sum(flag(cond)).cast("bigint")
