"""Equi-joins for enrichment, series and scores.

No join carries a broadcast hint: Spark broadcasts a side below ``spark.sql.autoBroadcastJoinThreshold`` by its
measured size, and adaptive execution splits the partitions of a hot key otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.base import Col, as_list, col, micros
from .filters import between_ts


def lookup_left(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return df.join(lookup, df[left_key] == lookup[right_key], "left")


def star_enrich(fact: DataFrame, dims) -> DataFrame:
    """Left join of a fact to several dimensions; each is (dimension, key or keys shared by name)."""
    return reduce(lambda left, dim: left.join(dim[0], as_list(dim[1]), "left"), dims, fact)


def chain_inner(df: DataFrame, steps) -> DataFrame:
    """Inner joins in a row; each step is (right frame, left key, right key), right columns keep their names."""
    for right, left_key, right_key in steps:
        key = f"__{right_key}"
        df = df.join(right.withColumnRenamed(right_key, key), F.col(left_key) == F.col(key), "inner").drop(key)
    return df


def event_comments(events, incidents, cases, comments, event, incident, case) -> DataFrame:
    """Event -> incident -> case -> comment; `event`, `incident`, `case` are (left key, right key) pairs."""
    return chain_inner(events, [(incidents, *event), (cases, *incident), (comments, *case)])


def event_patients(events, incidents, cases, patients, event, incident, patient) -> DataFrame:
    """Event -> incident -> case -> patient; `event`, `incident`, `patient` are (left key, right key) pairs."""
    return chain_inner(events, [(incidents, *event), (cases, *incident), (patients, *patient)])


def spine(groups: DataFrame, start: Col, end: Col, step: str = "1 hour", ts: str = "time_created") -> DataFrame:
    """One row per group and time step. Each group row is expanded in place, so no cross join is needed."""
    return groups.select("*", F.explode(F.sequence(col(start), col(end), F.expr(f"interval {step}"))).alias(ts))


def zero_fill(spine_df: DataFrame, agg: DataFrame, keys, cols) -> DataFrame:
    """All rows of the spine with the aggregate's columns, 0 where it has no row."""
    return spine_df.join(agg, as_list(keys), "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in as_list(cols)})


def left_join_prefixed(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    right_name: str = "",
    cond=None,
    prefix: bool = True,
) -> DataFrame:
    """Left join that keeps column names unique.

    Right columns become `right_name__column`, or, without `prefix`, those the left side already has are dropped.
    `cond` is (left column, (lowest, highest)) and restricts the left side.
    """
    if cond:
        left = between_ts(left, cond[0], *cond[1])
    key = "__right_key"
    if prefix:
        kept = [F.col(c).alias(f"{right_name}__{c}") for c in right.columns]
    else:
        kept = [F.col(c) for c in right.columns if c not in left.columns]
    picked = right.select(F.col(right_key).alias(key), *kept)
    return left.join(picked, F.col(left_key) == F.col(key), "left").drop(key)


def join_chain(tables: dict[str, DataFrame], edges, cond=None) -> DataFrame:
    """Left joins along ((left table, right table), (left key, right key)) edges, right columns prefixed.

    A left key of a table joined earlier is found under its prefixed name. `cond` restricts the first table.
    """
    base = edges[0][0][0]
    out = tables[base]
    for i, ((left, right), (left_key, right_key)) in enumerate(edges):
        key = left_key if left == base else f"{left}__{left_key}"
        out = left_join_prefixed(out, tables[right], key, right_key, right, cond if i == 0 else None)
    return out


def join_two_systems(
    first: dict[str, DataFrame],
    first_edges,
    second: dict[str, DataFrame],
    second_edges,
    link: tuple[str, str],
    start,
    end,
    first_ts: str,
    second_ts: str | None = None,
    dictionary: tuple[DataFrame, str, str, str] | None = None,
) -> DataFrame:
    """Two joined systems linked by (left key, right key) within a date range, plus a lookup dictionary.

    With `second_ts` the second system is restricted to the date range too and joined as a whole; without it only
    its tables reached by `second_edges` are added. `dictionary` is (frame, name, left key, right key).
    """
    left = join_chain(first, first_edges, (first_ts, (start, end)))
    right = join_chain(second, second_edges, (second_ts, (start, end)) if second_ts else None)
    out = left_join_prefixed(left, right, link[0], link[1], second_edges[0][0][0])
    if dictionary:
        frame, name, left_key, right_key = dictionary
        out = left_join_prefixed(out, frame, left_key, right_key, name)
    return out


def lookup_by_year(
    df: DataFrame, ref: DataFrame, year: str, key: str, ref_year: str, lag: int = 2, floor: int | None = None
) -> DataFrame:
    """Reference values of `lag` years earlier (not before `floor`) for the same key; `ref` is partitioned by year."""
    wanted = F.col(year) - lag
    if floor is not None:
        wanted = F.greatest(wanted, F.lit(floor))
    picked = ref.withColumnRenamed(ref_year, "__ref_year").withColumnRenamed(key, "__ref_key")
    joined = df.join(picked, (wanted == F.col("__ref_year")) & (F.col(key) == F.col("__ref_key")), "left")
    return joined.drop("__ref_year", "__ref_key")


def join_daily(df: DataFrame, daily: DataFrame, ts: str, day: str = "date") -> DataFrame:
    picked = daily.withColumnRenamed(day, "__day")
    return df.join(picked, F.to_date(ts) == F.col("__day"), "left").drop("__day")


def near_date_flag(df: DataFrame, dates: DataFrame, ts: str, date: str, days: int = 1, out: str = "near") -> DataFrame:
    """True where the row's day lies within `days` days of one of the dates."""
    around = F.sequence(F.date_sub(F.to_date(date), days), F.date_add(F.to_date(date), days))
    wide = dates.select(F.explode(around).alias("__day")).distinct().withColumn(out, F.lit(True))
    joined = df.join(wide, F.to_date(ts) == F.col("__day"), "left").drop("__day")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def late_events(df: DataFrame, key: str, ts: str, seconds: int, out: str = "n_late") -> DataFrame:
    """Events with rows more than `seconds` after their first row, and how many. Equal rows merge before the join."""
    times = df.where(F.col(ts).isNotNull()).groupBy(key, micros(ts).alias("__at")).agg(F.count(F.lit(1)).alias("__n"))
    firsts = times.groupBy(key).agg(F.min("__at").alias("__first"))
    late = times.join(firsts, key).where(F.col("__at") > F.col("__first") + F.lit(seconds * 1_000_000))
    return late.groupBy(key).agg(F.sum("__n").alias(out))


def lag_by_key(df: DataFrame, day: str, column: str, lags, group=(), default=0, prefix: str | None = None) -> DataFrame:
    """Value of exactly k calendar days earlier for the same group, `default` when that day has no row.

    The frame holds one row per (day, group). One window by calendar day serves every lag, without self-joins;
    its partitions are bounded by the number of days.
    """
    w = W.partitionBy(*as_list(group)).orderBy(F.unix_date(F.to_date(day)))
    return df.withColumns(
        {
            f"{prefix or column}_lag{k}": F.coalesce(F.max(column).over(w.rangeBetween(-k, -k)), F.lit(default))
            for k in as_list([lags] if isinstance(lags, int) else lags)
        }
    )


def merge(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right, as_list(on), how)


def stack_scores(frames: dict[str, DataFrame], key: str, score: str = "score") -> DataFrame:
    """Score frames of several models as rows (key, model, score), the form to keep at scale."""
    parts = [f.select(key, F.lit(model).alias("model"), F.col(score).alias("score")) for model, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def align_scores(frames: dict[str, DataFrame], key: str, score: str = "score") -> DataFrame:
    """One column per model, all keys of all models: one aggregation instead of a chain of full outer joins."""
    long = stack_scores(frames, key, score)
    return long.groupBy(key).pivot("model", list(frames)).agg(F.max("score"))


def attach_scores(pred: DataFrame, feats: DataFrame, key: str, suffix: str = "_left") -> DataFrame:
    """Predictions left-joined to features; columns both sides have get the suffix on the prediction side."""
    clash = {c: c + suffix for c in pred.columns if c in feats.columns and c != key}
    return pred.withColumnsRenamed(clash).join(feats, key, "left")


def transfer_by_key(train: DataFrame, test: DataFrame, key: str, column: str) -> DataFrame:
    """Test rows whose key occurs in train, with train's column."""
    return test.drop(column).join(train.select(key, column), key, "inner")


def join_on_expr(left: DataFrame, right: DataFrame, left_expr: Column, right_expr: Column, how: str = "left") -> DataFrame:
    keyed = right.withColumn("__rk", right_expr)
    return left.withColumn("__lk", left_expr).join(keyed, F.col("__lk") == F.col("__rk"), how).drop("__lk", "__rk")


def align_overlap(a: DataFrame, b: DataFrame, day: str, value: str) -> DataFrame:
    """Two series joined by day, strictly between the later first day and the earlier last day."""
    start = F.greatest(a.agg(F.min(day).alias("d")).scalar(), b.agg(F.min(day).alias("d")).scalar())
    end = F.least(a.agg(F.max(day).alias("d")).scalar(), b.agg(F.max(day).alias("d")).scalar())
    left = a.select(day, F.col(value).alias(f"{value}_1")).where((F.col(day) > start) & (F.col(day) < end))
    return left.join(b.select(day, F.col(value).alias(f"{value}_2")), day)
