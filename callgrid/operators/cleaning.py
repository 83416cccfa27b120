"""Cleaning, key and column checks. Checks return a DataFrame with a boolean column `ok`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.base import as_list, col, count_if
from ..functions.text import fix_letter_o, format_key


def drop_empty_columns(df: DataFrame, max_distinct: int = 1, keep=()) -> tuple[DataFrame, list[str]]:
    """Drop columns with at most 1 (or 2) distinct values, NULL counted as a value.

    Two passes of map-side aggregates decide it (lowest, highest, and whether anything lies between), so no column
    is shuffled to count its distinct values.
    """
    if max_distinct not in (1, 2):
        raise ValueError("max_distinct is 1 or 2")
    names = [c for c in df.columns if c not in as_list(keep)]
    first = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(names)],
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(names)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(names)],
    ).first()

    def seen(i: int) -> int:
        """Distinct values known from the ends alone: 0, 1 or 2, plus one for NULL."""
        lo, hi, n = first[f"lo_{i}"], first[f"hi_{i}"], first[f"n_{i}"]
        return (0 if n == 0 else 1 if lo == hi else 2) + (1 if n < first["rows"] else 0)

    low = [i for i in range(len(names)) if seen(i) <= max_distinct]
    open_ = [i for i in low if max_distinct == 2 and first[f"lo_{i}"] != first[f"hi_{i}"]]
    if open_:
        between = df.agg(
            *[
                F.max((F.col(names[i]) != F.lit(first[f"lo_{i}"])) & (F.col(names[i]) != F.lit(first[f"hi_{i}"]))).alias(
                    f"b_{i}"
                )
                for i in open_
            ]
        ).first()
        low = [i for i in low if i not in open_ or not between[f"b_{i}"]]
    dropped = [names[i] for i in low]
    return df.drop(*dropped), dropped


def _date_readings(column: str) -> list[tuple[str, Column]]:
    """The ways a column may hold a time, in the order they are tried."""
    c = F.col(column)
    text = F.nullif(F.trim(c.cast("string")), F.lit(""))
    number = F.expr(f"try_cast(try_cast(nullif(trim(cast(`{column}` as string)), '') as double) as bigint)")
    whole = number.cast("string")
    hhmmss = F.lpad(whole, 6, "0")
    seconds = (
        F.substring(hhmmss, 1, 2).cast("int") * 3600
        + F.substring(hhmmss, 3, 2).cast("int") * 60
        + F.substring(hhmmss, 5, 2).cast("int")
    )
    in_a_day = (
        (F.length(whole) <= 6)
        & F.substring(hhmmss, 1, 2).between("00", "23")
        & F.substring(hhmmss, 3, 2).between("00", "59")
        & F.substring(hhmmss, 5, 2).between("00", "59")
    )
    native = F.when(~text.rlike(r"^\d+(\.\d+)?(E\d+)?$"), F.try_to_timestamp(text))
    return [
        ("timestamp", native),
        ("number", F.try_to_timestamp(whole, F.lit("yyyyMMddHHmmss"))),
        ("time", F.when(in_a_day, seconds)),
    ]


def prettify_date(df: DataFrame, column: str, reading: str | None = None) -> DataFrame:
    """Turn a column into a timestamp, or into seconds of the day when it holds HHMMSS.

    The first reading that fits every non-empty value of the column wins: native text, then YYYYMMDDHHMMSS as a number
    or as text of a number, then HHMMSS. One aggregate finds it; pass `reading` to skip the pass. A column that fits
    no reading stays as it is.
    """
    readings = dict(_date_readings(column))
    if reading is None:
        given = F.nullif(F.trim(F.col(column).cast("string")), F.lit("")).isNotNull()
        misfits = df.agg(*[count_if(given & r.isNull()).alias(name) for name, r in readings.items()]).first()
        reading = next((name for name in readings if not misfits[name]), None)
        if reading is None:
            return df
    return df.withColumn(column, readings[reading])


def cast_column(df: DataFrame, column: str, kind: str, strict: bool = True) -> DataFrame:
    return df.withColumn(column, F.col(column).cast(kind) if strict else F.col(column).try_cast(kind))


def fix_indices(df: DataFrame, column: str, prefix: str = "FCF", width: int = 12) -> DataFrame:
    """Event key written uniformly: letter O read as zero, blanks dropped, zero padded behind a prefix."""
    digits = fix_letter_o(F.replace(F.col(column).cast("string"), F.lit(" ")))
    return df.withColumn(column, format_key(digits.try_cast("bigint"), prefix, width))


def delete_duplicates(df: DataFrame, keys, order) -> DataFrame:
    """First row of each key by `order`. Each task sends at most one row per key to the shuffle."""
    w = W.partitionBy(*as_list(keys)).orderBy(*[col(c) for c in as_list(order)])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def clean_table(df: DataFrame, date_columns=(), keep=(), max_distinct: int = 1) -> tuple[DataFrame, list[str]]:
    """Lower-case names, drop columns without variation, convert the listed time columns."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    dates = [c.lower() for c in as_list(date_columns)]
    kept, dropped = drop_empty_columns(lowered, max_distinct, [k.lower() for k in as_list(keep)])
    for c in dates:
        if c in kept.columns:
            kept = prettify_date(kept, c)
    return kept, dropped


def check_column_value(df: DataFrame, predicate: Column) -> DataFrame:
    """ok where the predicate holds on every row on which it is not NULL."""
    return df.agg(F.coalesce(F.bool_and(predicate), F.lit(True)).alias("ok"))


def check_unique(df: DataFrame, key) -> DataFrame:
    keys = as_list(key)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_distinct"))
        .select(
            F.coalesce("n", F.lit(0)).alias("n"), "n_distinct", (F.coalesce("n", F.lit(0)) == F.col("n_distinct")).alias("ok")
        )
    )


def check_column_is_not_null(df: DataFrame, column: str) -> DataFrame:
    """ok when the column holds at least one value."""
    return df.agg((F.count(column) > 0).alias("ok"))


def check_table_has_nrows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n).agg((F.count(F.lit(1)) >= n).alias("ok"))


def misaligned_rows(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Keys whose row counts differ between two frames; empty when the frames hold the same keys."""
    keys = as_list(key)
    side = lambda df, x, y: df.select(*keys, F.lit(x).alias("n_left"), F.lit(y).alias("n_right"))
    return (
        side(a, 1, 0)
        .unionByName(side(b, 0, 1))
        .groupBy(*keys)
        .agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
        .where("n_left <> n_right")
    )


def check_binary_domain(df: DataFrame, column: str, both: bool = True) -> DataFrame:
    """ok when the column holds only 0 and 1 and, if `both`, each of them at least once."""
    c = F.col(column).cast("double")
    only = F.coalesce(F.bool_and(F.coalesce(c.isin(0.0, 1.0), F.lit(False))), F.lit(False))
    each = (F.min(c) == 0) & (F.max(c) == 1) if both else F.lit(True)
    return df.agg((only & F.coalesce(each, F.lit(False))).alias("ok"))


def drop_null_rows(df: DataFrame, subset=None, how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=as_list(subset) or None)


def drop_null_columns(df: DataFrame, how: str = "all") -> DataFrame:
    """Drop columns that are NULL everywhere (`all`) or anywhere (`any`)."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in df.columns]).first()
    empty = [c for c in df.columns if (counts[c] == 0 if how == "all" else counts[c] < counts["rows"])]
    return df.drop(*empty)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
