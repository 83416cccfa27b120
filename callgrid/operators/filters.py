"""Projections, predicates and flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.base import Col, as_list, col
from ..functions.text import like_any
from .ordered import exact_quantiles

# Disposition codes that never mean a transport although they end in T.
NOT_TRANSPORT_CODES = ("TEST", "AST", "CIT", "EXT", "NOT")
# Codes of calls that are no incidents.
NON_INCIDENT_CODES = ("INFOF", "FADV", "FTEST", "TESTF", "TESTC", "DETAIL", "FDRILL", "FSERV")
# Wildcards of units able to transport a patient.
TRANSPORT_UNITS = ("M__", "A__", "R__")


def flag_by_code_text(df: DataFrame, code: str, text: str, out: str = "transported") -> DataFrame:
    """Whether a disposition code and text mean that a patient was transported; never NULL."""
    c, t = F.col(code), F.col(text)
    negated = t.contains("NO")
    by_code = c.like("%T") & ~negated & ~c.isin(*NOT_TRANSPORT_CODES)
    by_text = t.contains("TRANSPORT") & ~negated
    return df.withColumn(out, F.coalesce(by_code | by_text | c.like("TRAN%") | (c == "NCT"), F.lit(False)))


def default_false(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in as_list(cols)})


def filter_like_any(df: DataFrame, column: str, patterns=TRANSPORT_UNITS) -> DataFrame:
    return df.where(like_any(column, patterns))


def exclude_codes(df: DataFrame, column: str, codes=NON_INCIDENT_CODES) -> DataFrame:
    """Rows with a code that is not in the list; rows without a code go too."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*as_list(codes)))


def since(df: DataFrame, ts: str, start) -> DataFrame:
    return df.where(F.col(ts) >= F.lit(start))


def between_ts(df: DataFrame, ts: str, start, end) -> DataFrame:
    return df.where(F.col(ts).between(F.lit(start), F.lit(end)))


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """A range rather than `year(ts) = y`, so that the file scan can skip row groups."""
    return df.where((F.col(ts) >= F.lit(f"{year}-01-01")) & (F.col(ts) < F.lit(f"{year + 1}-01-01")))


def categorize_text(df: DataFrame, column: str, needles, default="NA", out: str = "category") -> DataFrame:
    """Label of the first needle the text contains."""
    label = F.lit(default)
    for needle, name in reversed(list(needles)):
        label = F.when(F.col(column).contains(needle), F.lit(name)).otherwise(label)
    return df.withColumn(out, label)


def flag_contains(df: DataFrame, column: str, needle: str, out: str = "flag") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(column).contains(needle), F.lit(False)))


def refused(df: DataFrame, text: str, out: str = "refused", needles=("refused transport", "refusal")) -> DataFrame:
    hit = reduce(lambda a, b: a | b, [F.col(text).contains(n) for n in as_list(needles)])
    return df.withColumn(out, F.coalesce(hit, F.lit(False)))


def split_by_year(df: DataFrame, year: Col, y0: int, n_train: int, y1: int, n_test: int):
    """(train, test) by half-open year ranges."""
    y = col(year)
    return df.where((y >= y0) & (y < y0 + n_train)), df.where((y >= y1) & (y < y1 + n_test))


def split_last_days(df: DataFrame, ts: str, y0: int, days: int):
    """(train, test): the test set is the last `days` calendar days, the train set all earlier days from year y0 on."""
    first_test_day = F.date_sub(df.agg(F.max(F.to_date(ts)).alias("last")).scalar(), days - 1)
    day = F.to_date(ts)
    return df.where((F.year(day) >= y0) & (day < first_test_day)), df.where(day >= first_test_day)


def subset_bucket(df: DataFrame, code: str, codes) -> DataFrame:
    return df.where(F.col(code).isin(*as_list(codes)))


def select_family(df: DataFrame, families, always=(), exclude=()) -> DataFrame:
    """Columns whose name starts with one of the families, and the columns always kept."""
    always, exclude = as_list(always), as_list(exclude)
    chosen = [c for c in df.columns if c in always or any(c.startswith(f) for f in as_list(families))]
    return df.select(*[c for c in chosen if c not in exclude])


def trim_iqr(df: DataFrame, column: str, lo: float = 0, k: float = 1.0) -> DataFrame:
    """Rows with lo <= x <= p75 + k * (p75 - p25)."""
    q = exact_quantiles(df, column, {"p25": 0.25, "p75": 0.75})
    upper = q.select((F.col("p75") + k * (F.col("p75") - F.col("p25"))).alias("upper")).scalar()
    return df.where((F.col(column) >= lo) & (F.col(column) <= upper))


def keep_above_share_of_max(df: DataFrame, column: str, share: float = 0.1) -> DataFrame:
    """Rows of an aggregate whose value exceeds a share of the largest value."""
    return df.where(F.col(column) > share * df.agg(F.max(column).alias("top")).scalar())


def keep_in(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, as_list(on), "left_semi")


def flag_not_in(df: DataFrame, keys: DataFrame, on, out: str = "absent") -> DataFrame:
    """True where the row's key is not among `keys`; a NULL key is absent."""
    on = as_list(on)
    marked = keys.select(*on).distinct().withColumn(out, F.lit(False))
    return df.join(marked, on, "left").withColumn(out, F.coalesce(F.col(out), F.lit(True)))


def rename_drop(df: DataFrame, mapping: dict[str, str] | None = None, drops=()) -> DataFrame:
    return df.drop(*as_list(drops)).withColumnsRenamed(mapping or {})


def skip_until(df: DataFrame, ts: str, hour: int | None = None, start=None) -> DataFrame:
    """Drop the rows before the first one at or after an hour of the day, or before a start time."""
    if start is not None:
        return since(df, ts, start)
    first = df.where(F.hour(ts) >= hour).agg(F.min(ts).alias("first")).scalar()
    return df.where(F.col(ts) >= first)


def prune(df: DataFrame, pk, cols, deps=()) -> DataFrame:
    wanted = [*as_list(pk), *as_list(cols), *as_list(deps)]
    return df.select(*[c for c in dict.fromkeys(wanted) if c in df.columns])


def changed_rows(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows on which two flags differ; NULL differs from a value."""
    return df.where(~F.col(a).eqNullSafe(F.col(b)))

