"""Ordered work (running sums, previous rows, exact quantiles) that stays parallel when one key is hot.

A window partitioned by a key puts all rows of the key into one task. Here rows are first cut into buckets along the
order, at approximate quantiles of the data, and windows run per (key, bucket). What a bucket needs from the earlier
ones arrives as one extra row, computed from one total per (key, bucket). The cut points are literals in the plan, so
they steer only the load, and a recomputed task sees the same buckets. Results are the same for whole numbers; sums of doubles
may be added up in another order.

Small inputs, by the size of their files, keep a single bucket, which is a plain window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.base import Col, as_list, col

BUCKET_BYTES_KEY = "spark.callgrid.bucketBytes"
DEFAULT_BUCKET_BYTES = 128 * 1024 * 1024
#: Cut points are literals in the plan. Beyond so many, buckets grow with the data and their windows spill.
MOST_BUCKETS, MOST_TEXT_BUCKETS = 4096, 512
#: Inputs without a file listing say that they are larger than this.
UNKNOWN_BYTES = 1 << 60

_BUCKET, _CARRIED, _SEED = "__bucket", "__carried", "__seed"


def input_bytes(df: DataFrame) -> int:
    """Bytes of the inputs of a plan, from file listings; no job is run. Unknown inputs count as huge.

    A session without access to its plans (Spark Connect) counts the rows instead.
    """
    if not hasattr(type(df), "_jdf") and "_jdf" not in vars(df):
        return df.count() * 16 * len(df.columns)
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def bucket_count(df: DataFrame, finer: int = 1) -> int:
    """Buckets for a plan's inputs, `finer` times as many where a row of input becomes several rows to be sorted."""
    per_bucket = int(df.sparkSession.conf.get(BUCKET_BYTES_KEY, str(DEFAULT_BUCKET_BYTES)))
    return max(1, min(MOST_BUCKETS, math.ceil(finer * input_bytes(df) / per_bucket)))


def task_count(df: DataFrame, buckets: int) -> int:
    """Tasks for rows dealt by their buckets: the session's number, or one per bucket if these are more."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, buckets) if input_bytes(df) < UNKNOWN_BYTES else least


def _kind(df: DataFrame, c: Col) -> str:
    return df.select(col(c).alias("v")).schema[0].dataType.typeName()


def _as_double(df: DataFrame, c: Col) -> Column:
    """An order column other than text as a double that never falls along its order, NULL first."""
    kind = _kind(df, c)
    c = col(c)
    if kind.startswith("timestamp"):
        c = F.unix_micros(c.cast("timestamp"))
    elif kind == "date":
        c = F.unix_date(c)
    return F.coalesce(c.cast("double"), F.lit(float("-inf")))


def _cut_points(df: DataFrame, c: Col, n: int) -> list:
    """Values at n - 1 approximate quantiles, ascending; frequent ones several times. Text: those of a random sample."""
    if _kind(df, c) == "string":
        n = min(n, MOST_TEXT_BUCKETS)
        some = df.select(col(c).alias("v")).where("v is not null").orderBy(F.rand(0)).limit(64 * n).collect()
        found = sorted((r["v"] for r in some), key=lambda v: v.encode())
        return [found[i * len(found) // n] for i in range(1, n)] if found else []
    values = df.select(_as_double(df, c).alias("v"))
    cuts = values.approxQuantile("v", [i / n for i in range(1, n)], max(0.25 / n, 1e-4))
    return sorted(x for x in cuts if not math.isinf(x))


def _after(x):
    """The next value after a cut point."""
    return x + "\0" if isinstance(x, str) else math.nextafter(x, math.inf)


def _bucketed(df: DataFrame, c: Col, cuts: list, out: str) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0))
    if isinstance(cuts[0], str):
        value = col(c)
        below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x <= value))
        return df.withColumn(out, F.when(value.isNotNull(), below).otherwise(F.lit(0)))
    splits = [-math.inf, *cuts, math.inf]
    tmp = out + "_v"
    cut = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return cut.transform(df.withColumn(tmp, _as_double(df, c))).withColumn(out, F.col(out).cast("int")).drop(tmp)


@dataclass(frozen=True)
class Cuts:
    """Cut points along an order: of its first column, and of its second within the values listed as heavy."""

    first: tuple[float | str, ...] = ()
    heavy: tuple[float | str, ...] = ()
    second: tuple[float | str, ...] = ()

    @property
    def width(self) -> int:
        """Numbers that `with_buckets` keeps for each stretch of the first column."""
        return len(self.second) + 2 if self.heavy else 1

    @property
    def buckets(self) -> int:
        return len(self.first) + 1 + len(self.heavy) * len(self.second)

    def stretch(self, bucket: Col) -> Column:
        """The number of a bucket's stretch of the first column."""
        return F.floor(col(bucket) / F.lit(self.width)).cast("int")

    def one_value(self, bucket: Col) -> Column:
        """Whether a bucket holds (a part of) a heavy value alone."""
        return self.stretch(bucket).isin([self.first.index(x) + 1 for x in self.heavy])


def plan_cuts(df: DataFrame, order, n: int | None = None) -> Cuts:
    """Cut points that spread the rows over about n buckets; a job reads the order columns only.

    A value so frequent that it fills a bucket of its own is cut further along the second order column. Any cuts are
    right for any frame, so those of an input can serve what is computed from it.
    """
    order = as_list(order)
    n = n or bucket_count(df)
    if n <= 1:
        return Cuts()
    cuts = _cut_points(df, order[0], n)
    repeated = {x for x in cuts if cuts.count(x) > 1 and (isinstance(x, str) or abs(x) < 2**53)}
    heavy = _in_order(repeated) if len(order) > 1 else []
    first = _in_order({*cuts, *map(_after, heavy)})
    second = _cut_points(df, order[1], max(cuts.count(x) for x in heavy) + 1) if heavy else []
    return Cuts(tuple(first), tuple(heavy), tuple(_in_order(set(second))))


def _in_order(values) -> list:
    """Ascending as Spark orders them: text by its bytes."""
    return sorted(values, key=lambda v: v.encode() if isinstance(v, str) else v)


def is_heavy(df: DataFrame, c: Col, cuts: Cuts) -> Column:
    """Whether a value of the first order column is one of the heavy ones; NULL is not."""
    value = col(c) if cuts.heavy and isinstance(cuts.heavy[0], str) else _as_double(df, c)
    return F.coalesce(value.isin(*cuts.heavy), F.lit(False))


def with_buckets(df: DataFrame, order, cuts: Cuts, out: str = _BUCKET) -> DataFrame:
    """Add a bucket number that never decreases along the order."""
    order = as_list(order)
    first = _bucketed(df, order[0], list(cuts.first), out)
    if not cuts.heavy:
        return first
    second = out + "_2"
    both = _bucketed(first, order[1], list(cuts.second), second)
    inside = F.when(is_heavy(df, order[0], cuts), F.col(second)).otherwise(F.lit(0))
    return both.withColumn(out, F.col(out) * F.lit(len(cuts.second) + 2) + inside).drop(second)


def running_sums(
    df: DataFrame,
    values: dict[str, Col],
    order,
    keys=(),
    totals: dict[str, str] | None = None,
    inclusive: bool = True,
    n: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Running sums over the rows of the same keys up to (or, not inclusive, before) each row.

    `values` maps each new column to what it sums; `order` lists columns that put the rows of a key into one definite
    order; `totals` maps a new column to an extra column with the sum over all rows of the key.
    """
    order, keys, totals = as_list(order), as_list(keys), totals or {}
    cuts = plan_cuts(df, order, n) if cuts is None else cuts
    end = 0 if inclusive else -1
    filled = {out: F.coalesce(col(v), F.lit(0)) for out, v in values.items()}
    names = df.columns
    if not cuts.first:
        window = W.partitionBy(*keys)
        before = window.orderBy(*order).rowsBetween(W.unboundedPreceding, end)
        return df.select(
            "*",
            *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(out) for out, v in filled.items()],
            *[F.sum(filled[out]).over(window).alias(total) for out, total in totals.items()],
        )

    carried = {out: f"{_CARRIED}_{i}" for i, out in enumerate(values)}
    rows = with_buckets(df.select("*", *[filled[out].alias(c) for out, c in carried.items()]), order, cuts)
    earlier = W.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    seeds = (
        rows.groupBy(*keys, _BUCKET)
        .agg(*[F.sum(c).alias(c) for c in carried.values()])
        .select(
            *keys,
            _BUCKET,
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in carried.values()],
            *[F.sum(carried[out]).over(W.partitionBy(*keys)).alias(total) for out, total in totals.items()],
            F.lit(True).alias(_SEED),
        )
    )
    both = rows.withColumn(_SEED, F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    window = W.partitionBy(*keys, _BUCKET).orderBy(F.col(_SEED).desc(), *order)
    got = both.select(
        *names,
        _SEED,
        *[F.sum(c).over(window.rowsBetween(W.unboundedPreceding, end)).alias(out) for out, c in carried.items()],
        *[F.first(t).over(window.rowsBetween(W.unboundedPreceding, 0)).alias(t) for t in totals.values()],
    )
    return got.where(~F.col(_SEED)).drop(_SEED)


def running_sum(
    df: DataFrame,
    value: Col,
    order,
    keys=(),
    out: str = "running",
    total: str | None = None,
    inclusive: bool = True,
    n: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """`running_sums` of a single value."""
    return running_sums(df, {out: value}, order, keys, {out: total} if total else None, inclusive, n, cuts)


def neighbour(
    df: DataFrame,
    columns: dict[str, str],
    order,
    keys=(),
    following: bool = False,
    n: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add values of the previous (or following) row of the same keys; `columns` maps new name to source column."""
    order, keys = as_list(order), as_list(keys)
    cuts = plan_cuts(df, order, n) if cuts is None else cuts
    names = df.columns
    step = F.lead if following else F.lag
    if not cuts.first:
        window = W.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[step(src).over(window).alias(new) for new, src in columns.items()])

    rows = with_buckets(df, order, cuts)
    kept = list(dict.fromkeys(columns.values()))
    edge = (F.min_by if following else F.max_by)(F.struct(*kept), F.struct(*order))
    per_key = W.partitionBy(*keys).orderBy(_BUCKET)
    seeds = (
        rows.groupBy(*keys, _BUCKET)
        .agg(edge.alias(_CARRIED))
        .withColumn(_CARRIED, step(_CARRIED).over(per_key))
        .where(F.col(_CARRIED).isNotNull())
        .withColumn(_SEED, F.lit(True))
    )
    both = rows.withColumn(_SEED, F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    both = both.select(
        "*", *[F.when(F.col(_SEED), F.col(_CARRIED)[k]).otherwise(F.col(k)).alias(f"{_CARRIED}_{k}") for k in kept]
    )
    side = F.col(_SEED) if following else F.col(_SEED).desc()
    window = W.partitionBy(*keys, _BUCKET).orderBy(side, *order)
    got = both.select("*", *[step(f"{_CARRIED}_{src}").over(window).alias(new) for new, src in columns.items()])
    return got.where(~F.col(_SEED)).select(*names, *columns)


def row_positions(
    df: DataFrame, order, keys=(), out: str = "position", n: int | None = None, cuts: Cuts | None = None
) -> DataFrame:
    """0-based position of each row of a key along the order."""
    return running_sum(df, F.lit(1).cast("bigint"), order, keys, out, inclusive=False, n=n, cuts=cuts)


def exact_quantiles(
    df: DataFrame, value: Col, probs: dict[str, float], keys=(), n: int | None = None
) -> DataFrame:
    """Percentiles with linear interpolation per key; `probs` maps new column to probability. NULLs are ignored."""
    keys = as_list(keys)
    n = n or bucket_count(df)
    present = df.select(*keys, col(value).cast("double").alias("value")).where("value is not null")
    if n <= 1:
        return present.groupBy(*keys).agg(*[F.percentile("value", F.lit(p)).alias(q) for q, p in probs.items()])
    counts = present.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sum(counts, "n", ["value"], keys, "upto", total="rows", n=n)
    columns, finish = [], []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("rows") - 1)
        columns += [
            F.min(F.when(F.col("upto") > F.floor(at), F.col("value"))).alias(f"__lo_{name}"),
            F.min(F.when(F.col("upto") > F.ceil(at), F.col("value"))).alias(f"__hi_{name}"),
        ]
        share = at - F.floor(at)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        finish.append((lo * (1 - share) + hi * share).alias(name))
    return ranked.groupBy(*keys).agg(F.max("rows").alias("rows"), *columns).select(*keys, *finish)


#: Rows of a stretch of a series.
STRETCH_ROWS = 1 << 17


def with_halo(
    df: DataFrame, order, keys=(), back: int = 0, ahead: int = 0, stretch: int | None = None, out: str = "__stretch", home: str = "__home"
) -> DataFrame:
    """Rows in stretches of a key's order, each with the `back` rows before it and the `ahead` rows after it.

    A window over (keys, `out`) then sees what a window over the keys would see around every row; copies have `home` false
    and are to be dropped afterwards. Rows are counted along the order first, so a stretch always has the same number of
    rows and no row is farther away than in the next stretch. `stretch` is that number; without it small inputs, by the size
    of their files, are one stretch that needs no counting.
    """
    if stretch is None and bucket_count(df) <= 1:
        return df.withColumns({out: F.lit(0).cast("bigint"), home: F.lit(True)})
    size = max(stretch or STRETCH_ROWS, back, ahead, 1)
    placed = row_positions(df, order, keys, "__position", None if stretch is None else 8)
    own = F.floor(F.col("__position") / size)
    first = F.greatest(F.floor((F.col("__position") - ahead) / size), F.lit(0))
    places = F.sequence(first, F.floor((F.col("__position") + back) / size))
    return placed.withColumn(out, F.explode(places)).withColumn(home, F.col(out) == own).drop("__position")
