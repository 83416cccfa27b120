"""Group aggregates, pivots, heat maps and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.base import Col, as_list, col, count_if, flag
from ..functions.calendar import day_part, iso_week, weekday0
from ..functions.text import lookup
from .ordered import plan_cuts, with_buckets

# Daily weather event codes of the public GHCN-Daily format and the names used for them.
WEATHER_EVENTS = {
    "WT01": "ice_fog", "WT02": "heavy_fog", "WT03": "thunder", "WT04": "ice_pellets", "WT05": "hail",
    "WT06": "glaze", "WT07": "dust", "WT08": "smoke", "WT09": "drifting_snow", "WT10": "tornado",
    "WT11": "high_winds", "WT12": "blowing_spray", "WT13": "mist", "WT14": "drizzle",
    "WT15": "freezing_drizzle", "WT16": "rain", "WT17": "freezing_rain", "WT18": "snow",
    "WT19": "unknown_precip", "WT21": "ground_fog", "WT22": "ice_fog",
}


def hourly_demand(df: DataFrame, ts: str, group: str, flags=(), total: str = "total_incidents") -> DataFrame:
    """Rows and flag sums per hour and group; rows without a group are left out."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(F.date_trunc("hour", ts).alias("time_created"), F.col(group))
        .agg(F.count(F.lit(1)).alias(total), *[count_if(f).alias(f) for f in as_list(flags)])
    )


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    return (df.select(*as_list(cols)) if cols else df).distinct()


distinct_values = distinct_rows


def first_per_key(df: DataFrame, key, order) -> DataFrame:
    w = W.partitionBy(*as_list(key)).orderBy(*as_list(order))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def concat_text(
    df: DataFrame, key: str, text: str, order, sep: str = " | ", out: str = "comments", n: int | None = None
) -> DataFrame:
    """Texts of a key joined in order. Runs of the order are joined first, so a hot key is sorted in pieces."""
    order = as_list(order)
    quoted = sep.replace("'", "\\'")

    def glue(c: str, by: list[str]) -> Column:
        return F.expr(f"listagg(`{c}`, '{quoted}') within group (order by {', '.join(f'`{b}`' for b in by)})")

    present = df.select(key, text, *[o for o in order if o not in (key, text)]).where(F.col(text).isNotNull())
    cuts = plan_cuts(present, order, n)
    if not cuts.first:
        return present.groupBy(key).agg(glue(text, order).alias(out))
    pieces = with_buckets(present, order, cuts, "__piece").groupBy(key, "__piece").agg(glue(text, order).alias("__t"))
    return pieces.groupBy(key).agg(glue("__t", ["__piece"]).alias(out))


def max_per_key(df: DataFrame, key, cols) -> DataFrame:
    return df.groupBy(*as_list(key)).agg(*[F.max(c).alias(c) for c in as_list(cols)])


def daily_pivot(df: DataFrame, date: Col, kind: str, value: str, kinds, fill: float = 0.0) -> DataFrame:
    """Mean per day and kind, one lower-case column per kind, 0 where a day lacks a kind."""
    wide = (
        df.groupBy(F.to_date(col(date)).alias("date")).pivot(kind, list(kinds)).agg(F.avg(value))
    )
    return wide.toDF("date", *[str(k).lower() for k in kinds]).na.fill(fill)


def daily_event_pivot(df: DataFrame, date: Col, kind: str, value: str, mapping: dict | None = None) -> DataFrame:
    """As `daily_pivot` for event codes under their names; codes that share a name are averaged together."""
    mapping = mapping or WEATHER_EVENTS
    named = df.where(F.col(kind).isin(*mapping)).withColumn("__event", lookup(kind, mapping))
    return daily_pivot(named, date, "__event", value, list(dict.fromkeys(mapping.values())))


def daily_threshold(
    df: DataFrame, date: Col, value: str, agg: str = "max", op: str = ">=", t: float = 90, out: str = "flag"
) -> DataFrame:
    """Per day, whether the highest (or lowest) value passes a threshold."""
    best = {"max": F.max, "min": F.min}[agg](value)
    test = {">=": best >= t, "<=": best <= t, ">": best > t, "<": best < t}[op]
    return df.groupBy(F.to_date(col(date)).alias("date")).agg(test.alias(out))


def code_summary(
    df: DataFrame, codes, flag_col: str = "trns_to_hosp", required: str = "m_required"
) -> DataFrame:
    """Per code: transported share, incidents, required share; most frequent first."""
    return (
        df.groupBy(*as_list(codes))
        .agg(
            F.avg(flag(flag_col)).alias("frac_trans"),
            F.count(F.lit(1)).alias("n_incidents"),
            F.avg(flag(required)).alias("mt_required"),
        )
        .orderBy(F.desc("n_incidents"))
    )


def ratio_of_sums(df: DataFrame, group, num: Col, den: Col, out: str = "ratio") -> DataFrame:
    """sum(num * den) / sum(den) per group."""
    weighted = col(num).cast("double") * col(den)
    return df.groupBy(*as_list(group)).agg(F.try_divide(F.sum(weighted), F.sum(col(den))).alias(out))


def daily_rollup(df: DataFrame, day: Col, group, sums=(), means=()) -> DataFrame:
    return df.groupBy(F.to_date(col(day)).alias("day"), *as_list(group)).agg(
        *[F.sum(c).alias(c) for c in as_list(sums)], *[F.avg(c).alias(c) for c in as_list(means)]
    )


def rollup_sum(df: DataFrame, ts: str, unit: str, group, cols) -> DataFrame:
    return df.groupBy(F.date_trunc(unit, ts).alias(unit), *as_list(group)).agg(
        *[F.sum(c).alias(c) for c in as_list(cols)]
    )


def counts_by_year(df: DataFrame, ts: str, predicates: dict[str, Column] | None = None) -> DataFrame:
    """Rows per year, and per year the rows that satisfy each named predicate, in one pass."""
    return df.groupBy(F.year(ts).alias("time_year")).agg(
        F.count(F.lit(1)).alias("n"), *[count_if(p).alias(name) for name, p in (predicates or {}).items()]
    )


def weighted_confusion(df: DataFrame, pred: Col, frac: Col, n: Col) -> DataFrame:
    """Confusion shares when each row stands for n cases of which the share `frac` is positive."""
    p, f, w = flag(pred), col(frac), col(n)
    cells = {"tp": p * f, "fn": (1 - p) * f, "fp": p * (1 - f), "tn": (1 - p) * (1 - f)}
    sums = df.agg(F.sum(w).alias("total"), *[F.sum(w * c).alias(k) for k, c in cells.items()])
    return sums.select(*[(F.col(k) / F.col("total")).alias(k) for k in cells])


def increase_ratio(df: DataFrame, old: Col, new: Col, frac: Col, n: Col) -> DataFrame:
    """Relative increase of dispatches, and of transport runs, from an old to a new rule."""
    w = col(n)

    def runs(rule: Col) -> tuple[Column, Column]:
        sent = F.sum(flag(rule) * w)
        return sent, sent + F.sum((1 - flag(rule)) * col(frac) * w)

    (old_sent, old_runs), (new_sent, new_runs) = runs(old), runs(new)
    return df.agg(
        F.try_divide(new_sent - old_sent, old_sent).alias("dispatch_increase"),
        F.try_divide(new_runs - old_runs, old_runs).alias("transport_increase"),
    )


def confusion_delta(df: DataFrame, old: Col, new: Col, frac: Col, n: Col) -> DataFrame:
    """Change of each confusion cell in cases, from an old to a new rule."""
    w, f = col(n), col(frac)
    step = (flag(new) - flag(old)) * w
    return df.agg(
        F.sum(step * f).alias("tp"),
        F.sum(-step * f).alias("fn"),
        F.sum(step * (1 - f)).alias("fp"),
        F.sum(-step * (1 - f)).alias("tn"),
    )


def _confusion_cells(pred: Col, obs: Col) -> dict[str, Column]:
    p, o = flag(pred), flag(obs)
    return {"tp": p * o, "fp": p * (1 - o), "fn": (1 - p) * o, "tn": (1 - p) * (1 - o)}


def confusion_rates(df: DataFrame, pred: Col, obs: Col, group=()) -> DataFrame:
    return df.groupBy(*as_list(group)).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(k) for k, c in _confusion_cells(pred, obs).items()]
    )


def agreement_rates(df: DataFrame, pairs: dict[str, tuple[Col, Col]]) -> DataFrame:
    """Share of rows on which two flags agree, per named pair."""
    return df.agg(*[F.avg((flag(a) == flag(b)).cast("int")).alias(name) for name, (a, b) in pairs.items()])


def confusion_top_groups(df: DataFrame, group: str, pred: Col, obs: Col, n: int = 10, sort: str = "count") -> DataFrame:
    """Confusion shares of the n most frequent groups, by count or by group name."""
    per_group = confusion_rates(df.where(F.col(group).isNotNull()), pred, obs, group)
    top = per_group.orderBy(F.desc("n"), group).limit(n)
    return top if sort == "count" else top.orderBy(group)


def frequency(df: DataFrame, column: str, n: int | None = None, out: str = "n") -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), column)
    return counts.limit(n) if n else counts


def group_stats(df: DataFrame, column: str, value, pred: Col, obs: Col) -> DataFrame:
    """Confusion shares of one group and its share of all rows, in one pass."""
    inside = F.col(column) == F.lit(value)
    cells = {k: F.avg(F.when(inside, c)).alias(k) for k, c in _confusion_cells(pred, obs).items()}
    return df.agg(count_if(inside).alias("n"), *cells.values(), F.avg(flag(inside)).alias("share"))


def per_event(df: DataFrame, key, order, firsts=(), sums=()) -> DataFrame:
    """First values by `order`, and sums, per event."""
    by = F.struct(*[F.col(c) for c in as_list(order)])
    return df.groupBy(*as_list(key)).agg(
        *[F.min_by(c, by).alias(c) for c in as_list(firsts)], *[F.sum(c).alias(c) for c in as_list(sums)]
    )


def undersend_rate(df: DataFrame, kind: str, late: Col) -> DataFrame:
    """Share of events of a type that had late units."""
    return df.groupBy(kind).agg(F.avg(flag(col(late) > 0)).alias("undersend"))


def oversend_rate(df: DataFrame, kind: str, needed: Col, sent: Col) -> DataFrame:
    """Share of events of a type with fewer transports than units sent."""
    return df.groupBy(kind).agg(F.avg(flag(col(needed) < col(sent))).alias("oversend"))


def pct_distribution(df: DataFrame, column: str, out: str = "share") -> DataFrame:
    """Count of each value and its share of all rows. The total is the sum of the counts, whose shuffle it shares."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn(out, F.col("n") / total)


def unit_share(df: DataFrame, unit: str) -> DataFrame:
    """Dispatches per unit and their share in percent."""
    return pct_distribution(df, unit, "pct").withColumn("pct", F.col("pct") * 100)


def heat_dow_hour(df: DataFrame, ts: str) -> DataFrame:
    """Mean row count per weekday and hour, over the ISO weeks that have any."""
    t = F.col(ts)
    weekly = df.groupBy(
        weekday0(t).alias("day_of_week"), F.hour(t).alias("hour"), iso_week(t).alias("week"), F.year(t).alias("year")
    ).agg(F.count(F.lit(1)).alias("n"))
    return weekly.groupBy("day_of_week", "hour").agg(F.avg("n").alias("mean_count"))


def heat_dow_hour_pivot(df: DataFrame, ts: str, start_hour: int = 7, weeks: float = 52.0) -> DataFrame:
    """Rows per weekday (one row each) and hour (one column each, from `start_hour` on), per week."""
    hours = [(start_hour + i) % 24 for i in range(24)]
    wide = (
        df.select(weekday0(F.col(ts)).alias("day_of_week"), F.hour(ts).alias("__h"))
        .groupBy("day_of_week")
        .pivot("__h", hours)
        .agg(F.count(F.lit(1)))
        .toDF("day_of_week", *[f"h{h:02d}" for h in hours])
        .na.fill(0)
    )
    return wide.select("day_of_week", *[(F.col(f"h{h:02d}") / weeks).alias(f"h{h:02d}") for h in hours])


def heat_month_day(df: DataFrame, ts: str, cap: float | None = None) -> DataFrame:
    """Mean yearly row count per month and day of month; with `cap`, all rows counted and larger counts NULL."""
    t = F.col(ts)
    keys = [F.month(t).alias("month"), F.dayofmonth(t).alias("day")]
    if cap is None:
        yearly = df.groupBy(*keys, F.year(t).alias("year")).agg(F.count(F.lit(1)).alias("n"))
        return yearly.groupBy("month", "day").agg(F.avg("n").alias("value"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("month", "day", F.when(F.col("n") <= cap, F.col("n")).alias("value"))


def widen_days(heat: DataFrame) -> DataFrame:
    """A month-day heat map with one column per day of month."""
    days = list(range(1, 32))
    return heat.groupBy("month").pivot("day", days).agg(F.max("value")).toDF("month", *[f"d{d:02d}" for d in days])


def median_runs(df: DataFrame, unit: str, shift: str) -> DataFrame:
    """Median of a unit's runs per shift, over the shifts in which it ran."""
    runs = df.groupBy(unit, shift).agg(F.count(F.lit(1)).alias("runs"))
    return runs.groupBy(unit).agg(F.median("runs").alias("median_runs"))


def distinct_units_hist(df: DataFrame, day: Col, unit: str) -> DataFrame:
    """How many days had each number of distinct units."""
    pairs = df.select(F.to_date(col(day)).alias("day"), F.col(unit)).where(F.col(unit).isNotNull()).distinct()
    per_day = pairs.groupBy("day").agg(F.count(F.lit(1)).alias("units"))
    return per_day.groupBy("units").agg(F.count(F.lit(1)).alias("days"))


def outcome_class(df: DataFrame, key, sent: Col, trns: Col, out: str = "outcome") -> DataFrame:
    """Per event: 0 neither sent nor transported, 1 transported only, 2 sent only, 3 both."""
    return df.groupBy(*as_list(key)).agg((2 * F.max(flag(sent)) + F.max(flag(trns))).alias(out))


def daily_fraction(df: DataFrame, day: Col, flag_col: Col, out: str = "fraction") -> DataFrame:
    return df.groupBy(F.to_date(col(day)).alias("day")).agg(F.avg(flag(flag_col)).alias(out))


def type_probability(df: DataFrame, kind: str, flag_col: Col) -> DataFrame:
    """Per type: share transported, and the type's share of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_type = df.groupBy(kind).agg(F.avg(flag(flag_col)).alias("p_trns"), F.count(F.lit(1)).alias("n"))
    return per_type.select(kind, "p_trns", (F.col("n") / total).alias("p_type"))


def base_accuracy(df: DataFrame, kind: str, flag_col: Col, variant: str = "random") -> DataFrame:
    """Accuracy without a model: guessing at the observed rate (`random`) or always the majority (`majority`)."""
    p = F.avg(flag(flag_col))
    accuracy = p * p + (1 - p) * (1 - p) if variant == "random" else F.greatest(p, 1 - p)
    return df.groupBy(kind).agg(accuracy.alias("base_acc"))


def accuracy_gain(df: DataFrame, accuracy: str, base: str = "base_acc", out: str = "pct_acc_gain") -> DataFrame:
    return df.withColumn(out, F.try_divide(F.col(accuracy) - F.col(base), F.col(base)))


def min_group_size(df: DataFrame, group, n: int = 50) -> DataFrame:
    """Rows of the groups that have at least n rows."""
    keys = as_list(group)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= n).drop("__n")
    return df.join(large, keys, "left_semi")


def median_by_daypart(df: DataFrame, ts: str, value: str, out: str = "median") -> DataFrame:
    """Median of whole numbers (such as busy units) by part of the day."""
    return df.groupBy(day_part(F.hour(ts)).alias("daypart")).agg(F.median(value).alias(out))


def argmax_group(df: DataFrame, group: str, predicate: Column) -> DataFrame:
    """The group with most rows that satisfy the predicate; of equals, the smallest group."""
    counts = df.where(predicate).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), group).limit(1)


def daily_share(df: DataFrame, day: Col, flag_col: Col) -> DataFrame:
    """Per day: share of all rows, and positive rate."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_day = df.groupBy(F.to_date(col(day)).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(flag(flag_col)).alias("positive_rate")
    )
    return per_day.select("day", (F.col("n") / total).alias("share"), "positive_rate")


def day_of_month_hist(df: DataFrame, ts: str, where: Column | None = None) -> DataFrame:
    """Rows per day of month, without February and without the 31st."""
    kept = df.where((F.month(ts) != 2) & (F.dayofmonth(ts) < 31))
    if where is not None:
        kept = kept.where(where)
    return kept.groupBy(F.dayofmonth(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: Col, bins: int = 100) -> DataFrame:
    """Equal-width histogram, empty bins included; the last bin holds the maximum."""
    v = col(column).cast("double")
    ends = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo = ends.select("lo").scalar()
    width = ends.select(((F.col("hi") - F.col("lo")) / bins).alias("w")).scalar()
    at = F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = ends.where("lo is not null").select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", ((F.col("hi") - F.col("lo")) / bins).alias("w")
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("w")).alias("from"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def rate_per_area(counts: DataFrame, population: DataFrame, key: str, n: str, pop: str) -> DataFrame:
    """Every area of the population table with its count and count / population (NULL without either)."""
    return population.join(counts, key, "left").withColumn(
        "rate", F.try_divide(F.col(n).cast("double"), F.col(pop).cast("double"))
    )


def area_weighted(df: DataFrame, weights: DataFrame, key: str, target: str, cols, weight: str = "multiplier") -> DataFrame:
    """Values of small areas summed up to large ones by overlap weight."""
    return (
        df.join(weights, key)
        .groupBy(target)
        .agg(*[F.sum(F.col(weight) * F.col(c)).alias(c) for c in as_list(cols)])
    )
