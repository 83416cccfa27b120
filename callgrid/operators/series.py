"""Regular series per group.

What looks at rows nearby works in stretches of a series, each with the few rows around it that it needs, so that one long
series is many tasks. `stretch` sets the rows of a stretch; without it small inputs are one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.base import as_list
from .joins import lag_by_key
from .ordered import neighbour, running_sum, with_halo


def label_lags(df: DataFrame, day: str, group, label: str, lags=(1, 7)) -> DataFrame:
    """`label_lag{k}`: the label k calendar days earlier for the same group, 0 when there was none."""
    return lag_by_key(df, day, label, list(lags), group)


def regular_series(df: DataFrame, ts: str, step: str = "day", group=None, out: str = "n") -> DataFrame:
    """Row counts per step, from each group's first to its last step, 0 where nothing happened."""
    groups = as_list(group)
    counts = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*groups, F.date_trunc(step, F.col(ts)).alias("t"))
        .agg(F.count(F.lit(1)).alias(out))
    )
    return fill_series(counts, "t", out, step, group)


def fill_series(df: DataFrame, t: str, column: str, step: str = "day", group=None) -> DataFrame:
    """Add the missing steps of a series with the value 0."""
    groups = as_list(group)
    ends = df.groupBy(*groups).agg(F.min(t).alias("__a"), F.max(t).alias("__b"))
    steps = ends.where("__a is not null").select(
        *groups, F.explode(F.sequence("__a", "__b", F.expr(f"interval 1 {step}"))).alias(t)
    )
    return steps.join(df, [*groups, t], "left").withColumn(column, F.coalesce(F.col(column), F.lit(0)))


def lag1_predictor(df: DataFrame, group, day: str, column: str, out: str = "pred") -> DataFrame:
    """The previous row's value as prediction; rows without one or with a zero value are dropped."""
    w = W.partitionBy(*as_list(group)).orderBy(day)
    return df.withColumn(out, F.lag(column).over(w)).where(F.col(out).isNotNull() & (F.col(column) != 0))


def moving_average(df: DataFrame, group, t: str, column: str, n: int = 7, out: str = "mean", stretch: int | None = None) -> DataFrame:
    """Mean of a row and the n - 1 rows after it; at the end the missing rows count 0."""
    groups = as_list(group)
    rows = with_halo(df, t, groups, ahead=n - 1, stretch=stretch)
    w = W.partitionBy(*groups, "__stretch").orderBy(t).rowsBetween(0, n - 1)
    return rows.withColumn(out, F.sum(column).over(w) / n).where("__home").select(*df.columns, out)


def rolling_mean_daily(df: DataFrame, group, ts: str, days: int = 7, out: str = "mean") -> DataFrame:
    """Daily counts, their mean over `days` days with data, then 0 for the days without."""
    groups = as_list(group)
    counts = df.groupBy(*groups, F.date_trunc("day", F.col(ts)).alias("t")).agg(F.count(F.lit(1)).alias("__n"))
    w = W.partitionBy(*groups).orderBy("t").rowsBetween(-(days - 1), 0)
    means = (
        counts.withColumn(out, F.avg("__n").over(w))
        .withColumn("__rows", F.count(F.lit(1)).over(w))
        .where(F.col("__rows") == days)
        .select(*groups, "t", out)
    )
    return fill_series(means, "t", out, "day", group)


def first_difference(df: DataFrame, group, t: str, column: str, out: str = "diff") -> DataFrame:
    """Change from the previous row; the first row of a group has none and is dropped."""
    before = neighbour(df, {"__before": column}, t, group)
    return before.withColumn(out, F.col(column) - F.col("__before")).where(F.col(out).isNotNull()).drop("__before")


def integrate(df: DataFrame, group, t: str, diff: str, start: str, out: str = "level") -> DataFrame:
    """Levels from differences and a start value."""
    summed = running_sum(df, F.col(diff), t, group, "__sum")
    return summed.withColumn(out, F.col(start) + F.col("__sum")).drop("__sum")


def _centred(df: DataFrame, column: str, groups: list[str]) -> DataFrame:
    """Add `__d`, the distance of a value from the mean of its group."""
    value = F.col(column).cast("double")
    if not groups:
        return df.withColumn("__d", value - df.agg(F.avg(value)).scalar())
    means = df.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)]).agg(F.avg(value).alias("__mean"))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return df.join(means, same).withColumn("__d", value - F.col("__mean"))


def acf(df: DataFrame, t: str, column: str, nlags: int = 40, group=None, stretch: int | None = None) -> DataFrame:
    """Autocorrelation for lags 0 .. nlags of a gap-free series, as rows (group, lag, acf)."""
    groups = as_list(group)
    rows = with_halo(_centred(df, column, groups).select(*groups, t, "__d"), t, groups, back=nlags, stretch=stretch)
    w = W.partitionBy(*groups, "__stretch").orderBy(t)
    lags = [F.lag("__d", k).over(w).alias(f"__d{k}") for k in range(1, nlags + 1)]
    lagged = rows.select(*groups, "__d", "__home", *lags).where("__home")
    square = F.sum(F.col("__d") * F.col("__d"))
    values = [F.try_divide(square, square)] + [
        F.try_divide(F.coalesce(F.sum(F.col("__d") * F.col(f"__d{k}")), F.lit(0.0)), square) for k in range(1, nlags + 1)
    ]
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), v.alias("acf")) for k, v in enumerate(values)])
    packed = lagged.groupBy(*groups).agg(rows.alias("__a"))
    return packed.select(*groups, F.explode("__a").alias("__r")).select(*groups, "__r.lag", "__r.acf")


def pacf(df: DataFrame, t: str, column: str, nlags: int = 40, group=None, stretch: int | None = None) -> DataFrame:
    """Partial autocorrelation by the Durbin-Levinson recursion on the nlags + 1 autocorrelations of each group."""
    groups = as_list(group)
    series = acf(df, t, column, nlags, group, stretch)
    kinds = ", ".join(f"`{g}` {series.schema[g].dataType.simpleString()}" for g in groups)

    def recursion(pdf):
        import numpy as np

        r = pdf.sort_values("lag")["acf"].to_numpy(dtype=float)
        coefficients, partial = np.zeros(0), [1.0]
        for k in range(1, len(r)):
            gap = 1.0 - coefficients @ r[1:k]
            phi = (r[k] - coefficients @ r[1:k][::-1]) / gap if gap > 1e-12 else float("nan")
            coefficients = np.append(coefficients - phi * coefficients[::-1], phi)
            partial.append(phi)
        out = pdf.sort_values("lag")[[*groups, "lag"]].copy()
        out["pacf"] = partial
        return out

    schema = ", ".join(p for p in (kinds, "lag int, pacf double") if p)
    keyed = series if groups else series.withColumn("__all", F.lit(1))
    return keyed.groupBy(*(groups or ["__all"])).applyInPandas(recursion, schema)


def granger_f(df: DataFrame, t: str, y: str, x: str, max_lag: int = 5, stretch: int | None = None) -> DataFrame:
    """Does x help to predict y? F statistic of adding 1 .. max_lag lags of x to a regression of y on its own lags.

    Spark sums the cross products of the lag columns; the normal equations of at most 2 * max_lag + 1 unknowns are
    solved from those sums. Values are taken from their means, which changes no statistic and keeps the sums small.
    """
    import numpy as np

    rows = with_halo(df.select(t, y, x), t, back=max_lag, stretch=stretch)
    w = W.partitionBy("__stretch").orderBy(t)
    means = dict(zip((y, x), df.agg(F.avg(y), F.avg(x)).first(), strict=True))
    names, cols = {}, []
    for k in range(max_lag + 1):
        for kind, c in (("y", y), ("x", x)):
            names[kind, k] = f"{kind}{k}"
            value = (F.col(c) if k == 0 else F.lag(c, k).over(w)).cast("double")
            cols.append((value - F.lit(float(means[c] or 0.0))).alias(f"{kind}{k}"))
    lagged = rows.select("__home", *cols).where("__home")
    aggs = []
    terms = {}
    for lag in range(1, max_lag + 1):
        used = ["one"] + [f"y{k}" for k in range(1, lag + 1)] + [f"x{k}" for k in range(1, lag + 1)] + ["y0"]
        terms[lag] = used
        present = F.col(f"y{lag}").isNotNull()
        for i, a in enumerate(used):
            for j, b in enumerate(used[: i + 1]):
                value = (F.lit(1.0) if a == "one" else F.col(a)) * (F.lit(1.0) if b == "one" else F.col(b))
                aggs.append(F.sum(F.when(present, value)).alias(f"s_{lag}_{i}_{j}"))
    row = lagged.agg(*aggs).first()

    def residual(gram, keep: list[int]) -> float:
        target = gram.shape[0] - 1
        xtx, xty = gram[np.ix_(keep, keep)], gram[keep, target]
        beta = np.linalg.lstsq(xtx, xty, rcond=None)[0]
        return float(gram[target, target] - beta @ xty)

    out = []
    for lag, used in terms.items():
        size = len(used)
        gram = np.zeros((size, size))
        for i in range(size):
            for j in range(i + 1):
                gram[i, j] = gram[j, i] = row[f"s_{lag}_{i}_{j}"] or 0.0
        n = int(gram[0, 0])
        free = n - 2 * lag - 1
        restricted, full = residual(gram, list(range(lag + 1))), residual(gram, list(range(size - 1)))
        f = (restricted - full) / lag / (full / free) if free > 0 and full > 0 else None
        out.append((lag, n, restricted, full, lag, free, f))
    schema = "lag int, n bigint, ssr_restricted double, ssr_full double, df_num int, df_denom int, f_stat double"
    return df.sparkSession.createDataFrame(out, schema)
