"""Trailing and delayed features per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.base import Col, as_list, col, micros
from .ordered import bucket_count, exact_quantiles, is_heavy, plan_cuts, row_positions, task_count, with_buckets

#: An instant is two rows for each span, with all its sums, sorted in both directions.
_FINER = 64


def _daily(df: DataFrame, day: Column, feature: str, agg: str, group: list[str]) -> DataFrame:
    """One value per day (and group)."""
    rows = df.select(day.alias("__day"), *group, F.col(feature).cast("double").alias("__v"))
    if agg == "median":
        return exact_quantiles(rows, "__v", {"__v": 0.5}, ["__day", *group])
    return rows.groupBy("__day", *group).agg({"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[agg]("__v").alias("__v"))


def delayed_feature(
    df: DataFrame,
    ts: str,
    feature: str,
    days: int,
    agg: str = "median",
    group=None,
    roll: int = 1,
    out: str = "delayed",
) -> DataFrame:
    """A feature aggregated per day (and group), summed over `roll` calendar days, as known `days` days earlier.

    A day without rows counts 0. The `days` days before the first day of the data take that day's value.

    Only (day, group) pairs that occur are touched: a calendar-day range frame over the daily values takes the place
    of a dense day x group table, and its partitions are bounded by the number of days.
    """
    groups = as_list(group)
    day = F.to_date(ts)
    daily = _daily(df.where(F.col(ts).isNotNull()), day, feature, agg, groups)
    first = F.unix_date(df.agg(F.min(day).alias("first")).scalar())
    at = F.unix_date("__day")
    by_day = W.partitionBy(*groups).orderBy(at)
    summed = F.sum("__v").over(by_day.rangeBetween(-(days + roll - 1), -days))
    first_value = F.max(F.when(at == first, F.col("__v"))).over(W.partitionBy(*groups))
    imputed = F.greatest(
        F.least(at - days, first - 1) - F.greatest(at - (days + roll - 1), first - days) + 1, F.lit(0)
    )
    known = daily.select(
        "__day",
        *groups,
        (F.coalesce(summed, F.lit(0.0)) + imputed * F.coalesce(first_value, F.lit(0.0))).alias(out),
    )
    joined = df.withColumn("__day", day).join(known, ["__day", *groups], "left").drop("__day")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0.0))).select(*df.columns, out)


def change_vs_delayed(df: DataFrame, ts: str, feature: str, days: int = 7, out: str = "change") -> DataFrame:
    """Value minus the daily median `days` days earlier."""
    return delayed_feature(df, ts, feature, days, "median", out=out).withColumn(out, F.col(feature) - F.col(out))


def prior_count(df: DataFrame, key: str, order, out: str = "prior", n: int | None = None) -> DataFrame:
    """How many earlier rows the key has; NULL for a row without a key."""
    counted = row_positions(df, order, [key], out, n)
    return counted.withColumn(out, F.when(F.col(key).isNotNull(), F.col(out)))


def sums_last(df: DataFrame, key, ts: str, sums: dict[str, tuple[Col, int]], n: int | None = None) -> DataFrame:
    """Trailing sums: `sums` maps each new column to (value, seconds).

    Each is the sum over the same key's rows from that many seconds before a row up to, but without, its own instant; 0 if
    there are none, and for a row without a time.

    Rows of an instant merge first. Time is cut into stretches as long as the sum looks back, so that what a row looks back
    on is the end of one stretch and the start of the next. Both are sums that only grow, one backwards and one
    forwards: nothing is subtracted, so that large values, NaN and infinity leave no trace once they are out of sight. A
    key with many rows is spread over its stretches, and they are cut into buckets of time: each of these starts, in
    either direction, with what those behind it add up to.
    """
    keys = as_list(key)
    names = df.columns
    by_span: dict[int, list[str]] = {}
    for out, (_, seconds) in sums.items():
        by_span.setdefault(seconds * 1_000_000, []).append(out)
    values = [F.sum(F.coalesce(col(v), F.lit(0))).alias(f"__v_{out}") for out, (v, _) in sums.items()]
    inner = [f"__k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(i) for k, i in zip(keys, inner, strict=True)]
    at = df.where(F.col(ts).isNotNull()).select("*", *renamed, micros(ts).alias("__at")).groupBy(*inner, "__at").agg(*values)

    # each instant is a value in its own stretch, and a question to the stretch before
    places = F.explode(
        F.array(
            *[
                F.struct(F.lit(span).alias("span"), (F.col("__at") - shift).alias("at"), F.lit(shift > 0).alias("asks"))
                for span in by_span
                for shift in (0, span)
            ]
        )
    )
    rows = at.withColumn("__p", places).select("*", "__p.*").drop("__p").withColumn("__part", F.floor(F.col("at") / F.col("span")))
    stretch, first, behind = [*inner, "span", "__part"], [], {}
    order = [*inner[:1], "at"]
    given = df.where(F.col(ts).isNotNull()).select(*renamed[:1], micros(ts).alias("at"))
    cuts = plan_cuts(given, order, n or bucket_count(df, _FINER))
    if cuts.heavy or (cuts.first and not keys):
        rows = with_buckets(rows, order, cuts)
        cut_up = rows.where(is_heavy(rows, inner[0], cuts)) if keys else rows
        values = [F.sum(F.when(~F.col("asks"), F.col(f"__v_{out}"))).alias(f"__v_{out}") for out in sums]
        pieces = cut_up.groupBy(*stretch, "__bucket").agg(*values)
        along = W.partitionBy(*stretch).orderBy("__bucket")
        below, above = along.rowsBetween(W.unboundedPreceding, -1), along.rowsBetween(1, W.unboundedFollowing)
        seeds = pieces.select(
            *stretch,
            "__bucket",
            F.lit(True).alias("__seed"),
            *[F.sum(f"__v_{out}").over(w).alias(f"__{d}_{out}") for out in sums for d, w in (("below", below), ("above", above))],
        )
        rows = rows.withColumn("__seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
        stretch, first = [*stretch, "__bucket"], [F.col("__seed").desc()]
        rows = rows.repartition(task_count(df, cuts.buckets), *stretch)
    part = W.partitionBy(*stretch)
    ahead = part.orderBy(*first, "at", "asks").rowsBetween(W.unboundedPreceding, -1)
    back = part.orderBy(*first, F.col("at").desc(), "asks").rowsBetween(W.unboundedPreceding, 0)
    found = []
    for span, outs in by_span.items():
        for out in outs:
            v = F.when(~F.col("asks"), F.col(f"__v_{out}"))
            up, down = (F.when(F.col("__seed"), F.col(f"__{d}_{out}")).otherwise(v) if first else v for d in ("below", "above"))
            seen = F.when(F.col("asks"), F.sum(down).over(back)).otherwise(F.sum(up).over(ahead))
            found.append(F.when(F.col("span") == span, seen).alias(f"__s_{out}"))
    seen = rows.select(*inner, "__at", *(["__seed"] if first else []), *found)
    parts = (seen.where(~F.col("__seed")) if first else seen).groupBy(*inner, "__at")
    trailing = parts.agg(*[F.coalesce(F.sum(f"__s_{out}"), F.lit(0)).alias(f"__t_{out}") for out in sums])
    same = micros(ts) == F.col("__at")
    for k, i in zip(keys, inner, strict=True):
        same = same & df[k].eqNullSafe(F.col(i))
    kinds = trailing.select(*[f"__t_{out}" for out in sums]).schema
    zero = {f.name: F.lit(0).cast(f.dataType) for f in kinds}
    return df.join(trailing, same, "left").select(
        *[df[c] for c in names], *[F.coalesce(f"__t_{out}", zero[f"__t_{out}"]).alias(out) for out in sums]
    )


def sum_last(df: DataFrame, key, ts: str, value: Col, seconds: int, out: str = "trailing") -> DataFrame:
    """`sums_last` of a single value."""
    return sums_last(df, key, ts, {out: (value, seconds)})


def count_last(df: DataFrame, key, ts: str, seconds: int = 86400, out: str = "trailing") -> DataFrame:
    return sum_last(df, key, ts, F.lit(1).cast("bigint"), seconds, out)
