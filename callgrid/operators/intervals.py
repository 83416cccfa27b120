"""Unit activity from start and end times: idle time, units busy at once, saturation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.base import Col, as_list, col, micros
from ..functions.calendar import minutes_between
from ..sources.scratch import checkpointed
from .ordered import UNKNOWN_BYTES, Cuts, bucket_count, input_bytes, is_heavy, neighbour, plan_cuts, running_sum, task_count, with_buckets

_DAY = 86_400_000_000
#: A dispatch is two events, which are sorted twice.
_FINER = 8


def shift_number(ts: Col, shift0) -> Column:
    """1 for the 24 hours from `shift0` (a timestamp literal such as '2015-01-01 07:00:00'), 2 for the next, ..."""
    start = micros(F.lit(shift0).cast("timestamp")) if not isinstance(shift0, Column) else micros(shift0)
    return (F.floor((micros(ts) - start) / F.lit(_DAY)) + 1).cast("int")


def duration_minutes(df: DataFrame, start: str, end: str, out: str = "minutes") -> DataFrame:
    return df.withColumn(out, minutes_between(start, end))


def unit_events(df: DataFrame, unit: str, start: str, end: str, extra=()) -> DataFrame:
    """(unit, at, state): state 1 when the unit is sent, 0 when it is clear; equal events merge."""
    pair = F.array(
        F.struct(micros(start).alias("at"), F.lit(1).alias("state")),
        F.struct(micros(end).alias("at"), F.lit(0).alias("state")),
    )
    events = df.select(F.col(unit).alias("unit"), *as_list(extra), F.explode(pair).alias("__e"))
    return events.select("unit", *as_list(extra), "__e.at", "__e.state").where("at is not null").distinct()


def idle_time(df: DataFrame, unit: str, start: str, end: str, shift0) -> DataFrame:
    """Idle hours per unit and shift: from the shift's start to the first dispatch, then from a clear to the next one.

    An event belongs to the shift in which its unit was dispatched; shifts before `shift0` are left out. At equal
    times a clear comes before a dispatch.
    """
    shifted = df.withColumn("shift", shift_number(start, shift0)).where("shift > 0")
    n = bucket_count(df, _FINER)
    cuts = plan_cuts(shifted.select(F.col(unit).alias("unit"), micros(start).alias("at")), ["unit", "at"], n)
    hot = is_heavy(shifted, unit, cuts)
    if n > 1 and not shifted.where(F.col(unit).isNull()).isEmpty():
        hot = hot | F.col(unit).isNull()
    elif not cuts.heavy:
        return _idle_in_shifts(shifted, unit, start, end, shift0, task_count(df, n))
    # only shifts of units with a large share of the rows are cut along time
    few = shifted.where(hot)
    times = plan_cuts(few.select(micros(start).alias("at")), "at", n)
    seen = neighbour(
        unit_events(few, unit, start, end, ["shift"]), {"__at": "at", "__state": "state"}, ["at", "state"], ["unit", "shift"], cuts=times
    )
    rest = _idle_in_shifts(shifted.where(~hot), unit, start, end, shift0, task_count(df, n))
    return rest.unionByName(_idle_hours(seen, shift0))


def _idle_in_shifts(shifted: DataFrame, unit: str, start: str, end: str, shift0, tasks: int) -> DataFrame:
    """Idle hours where a shift of a unit fits into a task: rows are dealt once, before they become two events each."""
    rows = shifted.select(F.col(unit).alias("unit"), "shift", micros(start).alias("__sent"), micros(end).alias("__clear"))
    pair = F.array(
        F.struct(F.col("__sent").alias("at"), F.lit(1).alias("state")), F.struct(F.col("__clear").alias("at"), F.lit(0).alias("state"))
    )
    events = rows.repartition(tasks, "unit", "shift").select("unit", "shift", F.inline(pair)).where("at is not null")
    # a repeated event adds nothing: its copy says that the unit is in that state already
    before = W.partitionBy("unit", "shift").orderBy("at", "state")
    seen = events.select("*", F.lag("at").over(before).alias("__at"), F.lag("state").over(before).alias("__state"))
    return _idle_hours(seen, shift0)


def _idle_hours(seen: DataFrame, shift0) -> DataFrame:
    """(unit, shift, idle_hours) from events that see the one before them."""
    began = micros(F.lit(shift0).cast("timestamp")) + (F.col("shift") - 1) * F.lit(_DAY)
    free_since = F.when(F.col("__state").isNull(), began).when(F.col("__state") == 0, F.col("__at"))
    idle = F.when(F.col("state") == 1, F.col("at") - free_since)
    return seen.groupBy("unit", "shift").agg(
        (F.coalesce(F.sum(idle), F.lit(0)) / F.lit(3_600_000_000.0)).alias("idle_hours")
    )


def median_idle(idle: DataFrame) -> DataFrame:
    """Median idle hours of each unit over its shifts."""
    return idle.groupBy("unit").agg(F.median("idle_hours").alias("median_idle_hours"))


def concurrency(df: DataFrame, unit: str, start: str, end: str, n: int | None = None) -> DataFrame:
    """(at, unit, delta, busy): the number of busy units after each change of a unit's state.

    A unit sent again before it was clear changes nothing. `at` is in microseconds since 1970; at equal times units
    become clear before others are sent. `n` is the number of buckets: 1 for plain
    windows; inputs of a known size get more than several if they need them.

    Large inputs are dealt once, into buckets of time, however often a unit occurs. What a bucket needs from the earlier
    ones is known before its rows are in order: a unit's state at a bucket's end is that of its last event there, and
    the changes of a bucket add up to the difference of its units' states.
    """
    rows = df.select(F.col(unit).alias("unit"), micros(start).alias("__sent"), micros(end).alias("__clear"))
    if n is None or (n > 1 and input_bytes(df) < UNKNOWN_BYTES):
        n = max(n or 1, bucket_count(df, _FINER))
    times = rows.select("unit", F.explode(F.array("__sent", "__clear")).alias("at")).where("at is not null")
    cuts = plan_cuts(times, ["at", "unit"], n)
    if not cuts.first:
        states = neighbour(unit_events(df, unit, start, end), {"__was": "state"}, ["at", "state"], ["unit"], cuts=cuts)
        return running_sum(_changes(states), F.col("delta").cast("bigint"), ["at", "delta", "unit"], out="busy", cuts=cuts)

    for time, home in (("__sent", "__on_in"), ("__clear", "__off_in")):
        rows = with_buckets(rows, [time, "unit"], cuts, home).withColumn(home, F.when(F.col(time).isNotNull(), F.col(home)))
    # a dispatch goes to the bucket of either time, once if both share it
    homes = F.array_distinct(F.array_compact(F.array("__on_in", "__off_in")))
    rows = rows.select(F.explode(homes).alias("__bucket"), "*")
    edges = _states_at_edges(rows)
    none = F.lit(None).cast("bigint")
    carried = edges.where("__was = 1").select(
        "__bucket", "unit", none.alias("__sent"), none.alias("__clear"), F.col("__bucket").alias("__on_in"), none.cast("int").alias("__off_in")
    )
    dealt = rows.unionByName(carried).repartition(task_count(df, cuts.buckets), "__bucket")
    pair = F.array(
        F.struct(F.col("__sent").alias("at"), F.lit(1).alias("state"), F.col("__on_in").alias("home")),
        F.struct(F.col("__clear").alias("at"), F.lit(0).alias("state"), F.col("__off_in").alias("home")),
    )
    events = dealt.select("__bucket", "unit", F.explode(pair).alias("__e")).where("__e.home = __bucket")
    # a carried state has no time and comes first
    before = W.partitionBy("__bucket", "unit").orderBy("at", "state")
    states = events.select("__bucket", "unit", "__e.at", "__e.state").withColumn("__was", F.lag("state").over(before))
    return busy_after(_changes(states, "__bucket").where("at is not null"), cuts, _net_changes(edges, cuts))


def _changes(states: DataFrame, *more) -> DataFrame:
    delta = F.col("state") - F.coalesce("__was", F.lit(0))
    return states.select(*more, "at", "unit", delta.alias("delta")).where("delta <> 0")


def _states_at_edges(rows: DataFrame) -> DataFrame:
    """(bucket, unit, was, last, on, off): states before a bucket and at its end, and whether the unit is sent or clear in it."""
    on, off = (
        F.max(F.when(F.col(home) == F.col("__bucket"), F.col(time))).alias(out)
        for time, home, out in (("__sent", "__on_in", "__on"), ("__clear", "__off_in", "__off"))
    )
    # at equal times the unit is clear first, so that it is busy afterwards
    last = F.when(F.col("__on") >= F.coalesce("__off", "__on"), 1).otherwise(0)
    edges = rows.groupBy("__bucket", "unit").agg(on, off).withColumn("__last", last)
    was = F.coalesce(F.lag("__last").over(W.partitionBy("unit").orderBy("__bucket")), F.lit(0))
    on, off = F.col("__on").isNotNull().alias("__on"), F.col("__off").isNotNull().alias("__off")
    return checkpointed(edges.select("__bucket", "unit", was.alias("__was"), "__last", on, off))


def _net_changes(edges: DataFrame, cuts: Cuts) -> DataFrame:
    """(bucket, part, net) as for `busy_after`, from the states at the edges of buckets."""
    alone, busy_before = cuts.one_value("__bucket"), F.col("__was") == 1
    ends = F.when(busy_before & F.col("__off"), -1).otherwise(0)
    begins = F.when(F.col("__on") & (~busy_before | F.col("__off")), 1).otherwise(0)
    first = F.sum(F.when(alone, ends).otherwise(F.col("__last") - F.col("__was"))).alias("__0")
    sums = edges.groupBy("__bucket").agg(first, F.sum(F.when(alone, begins).otherwise(0)).alias("__1"))
    parts = F.array(*[F.struct(F.lit(i).alias("__part"), F.col(f"__{i}").alias("__net")) for i in (0, 1)])
    return sums.select("__bucket", F.inline(parts))


def busy_after(changes: DataFrame, cuts: Cuts, net: DataFrame | None = None) -> DataFrame:
    """(at, unit, delta, busy) of changes that have a `__bucket` of cuts along (at, unit).

    An instant with a large share of the rows is spread over buckets of units. There, changes to clear are part 0 and
    come before those of part 1 in all its buckets. `net` has what the changes of a bucket's part add up to.
    """
    begins = cuts.one_value("__bucket") & (F.col("delta") > 0)
    parts = changes.withColumn("__part", F.when(begins, 1).otherwise(0))
    if net is None:
        net = parts.groupBy("__bucket", "__part").agg(F.sum("delta").alias("__net"))
    # one row per part of a bucket
    earlier = W.orderBy(cuts.stretch("__bucket"), "__part", "__bucket").rowsBetween(W.unboundedPreceding, -1)
    level = net.select("__bucket", "__part", F.coalesce(F.sum("__net").over(earlier), F.lit(0)).alias("__level"))
    upto = W.partitionBy("__bucket", "__part").orderBy("at", "delta", "unit").rowsBetween(W.unboundedPreceding, 0)
    summed = parts.withColumn("__busy", F.sum(F.col("delta").cast("bigint")).over(upto))
    found = summed.join(F.broadcast(level), ["__bucket", "__part"])
    return found.select("at", "unit", "delta", (F.col("__level") + F.col("__busy")).cast("bigint").alias("busy"))


def saturation_episodes(conc: DataFrame, capacity: int, n: int | None = None) -> DataFrame:
    """(episode, start, end) in microseconds: from the change that reaches the capacity to the one that leaves it.

    `end` is NULL when the data ends first.
    """
    before = F.col("busy") - F.col("delta")
    begins = (F.col("busy") >= capacity) & (before < capacity)
    ends = (F.col("busy") < capacity) & (before >= capacity)
    turns = conc.where(begins | ends).withColumn("__begin", F.when(begins, 1).otherwise(0))
    if bucket_count(conc, _FINER) > 1:
        turns = checkpointed(turns)
    numbered = running_sum(turns, F.col("__begin").cast("bigint"), ["at", "delta", "unit"], out="episode", n=n)
    at = F.col("at")
    return numbered.groupBy("episode").agg(
        F.min(F.when(F.col("__begin") == 1, at)).alias("start"), F.min(F.when(F.col("__begin") == 0, at)).alias("end")
    )


def load_band_share(conc: DataFrame, bounds=(4, 8), load: str = "during", n: int | None = None) -> DataFrame:
    """Share of time with at most the first bound busy, at most the second, and more, between first and last change.

    `load="during"` weights each stretch by the units busy in it; `"after"` by those busy at its end.
    """
    low, high = bounds
    # whether instants see the stretch before them or after them, busy is that of the stretch's near end: after an
    # instant's last change, or after its first. Units become clear first, and only they make busy fall.
    later = load == "during"
    fallen, risen = (F.when(F.col("delta") == d, F.col("busy")) for d in (-1, 1))
    near = F.coalesce(F.max(risen), F.min(fallen)) if later else F.coalesce(F.max(fallen), F.min(risen))
    instants = conc.groupBy("at").agg(near.alias("busy"))
    if (n or bucket_count(conc, _FINER)) > 1:
        instants = checkpointed(instants)
    stretch = neighbour(instants, {"__at": "at"}, ["at"], following=later, n=n or bucket_count(instants, _FINER))
    length = F.coalesce(F.abs(F.col("__at") - F.col("at")), F.lit(0))
    busy = F.col("busy")
    total = F.sum(length)
    return stretch.agg(
        F.try_divide(F.sum(F.when(busy <= low, length).otherwise(0)), total).alias("low_share"),
        F.try_divide(F.sum(F.when((busy > low) & (busy <= high), length).otherwise(0)), total).alias("mid_share"),
        F.try_divide(F.sum(F.when(busy > high, length).otherwise(0)), total).alias("high_share"),
    )


def created_while_saturated(
    df: DataFrame, created: str, conc: DataFrame, level: int = 12, out: str = "saturated", n: int | None = None
) -> DataFrame:
    """Add whether at least `level` units were busy just before each row's time.

    The rows are merged into the ordered changes with a step of 0, so one running sum answers all of them.
    """
    names = df.columns
    asked = df.select("*", micros(created).alias("__at"), F.lit(0).alias("__phase"))
    steps = conc.groupBy(F.col("at").alias("__at")).agg(F.sum("delta").alias("__delta")).withColumn("__phase", F.lit(1))
    if bucket_count(conc, _FINER) > 1:
        steps = checkpointed(steps)
    both = asked.unionByName(steps, allowMissingColumns=True)
    cuts = plan_cuts(df.select(micros(created).alias("__at")), "__at", n or bucket_count(both, _FINER))
    level_before = running_sum(both, "__delta", ["__at", "__phase"], out="__busy", cuts=cuts)
    return level_before.where("__phase = 0").select(*names, (F.col("__busy") >= level).alias(out))


def busy_samples(conc: DataFrame, n: int = 10) -> DataFrame:
    return conc.where(F.col("busy") >= n)


def itinerary(
    df: DataFrame,
    unit: str,
    key: str,
    dispatch: str,
    hospital_time: str,
    clear: str,
    place: Col,
    hospital: Col,
) -> DataFrame:
    """(unit, key, at, purpose, location) legs: the patient, then the hospital, if any.

    A hospital without a time is given the clear time and the purpose `h_notime`.
    """
    where, to = col(place), col(hospital)
    legs = F.array(
        F.struct(F.col(dispatch).alias("at"), F.lit("p").alias("purpose"), where.alias("location")),
        F.struct(
            F.coalesce(F.col(hospital_time), F.col(clear)).alias("at"),
            F.when(F.col(hospital_time).isNotNull(), "h").otherwise("h_notime").alias("purpose"),
            to.alias("location"),
        ),
    )
    out = df.select(F.col(unit).alias("unit"), F.col(key).alias("key"), F.explode(legs).alias("__l"))
    return out.select("unit", "key", "__l.at", "__l.purpose", "__l.location").where(
        (F.col("purpose") == "p") | F.col("location").isNotNull()
    )
