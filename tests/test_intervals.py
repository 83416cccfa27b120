"""Unit activity over large inputs: dealt once, right at ties, nulls, hot units and crowded instants."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window as W, functions as F

from callgrid.operators import intervals as iv, ordered as o, windows as w

SCHEMA = "unit {}, s timestamp, e timestamp"


def dispatched(spark, seed, n=600, kind="int", hot=0.3, crowd=0.3):
    """Few instants, one of them crowded; a hot unit; repeated rows, missing units and times, ends before starts."""
    r = random.Random(seed)
    data = []
    for _ in range(n):
        unit = 7 if r.random() < hot else r.choice([None, *range(40)])
        sent = 500 if r.random() < crowd else r.randrange(1000)
        clear = None if r.random() < 0.05 else sent + r.choice([-3, 0, 1, 20, 20, 300])
        data.append((unit if kind == "int" or unit is None else f"u{unit}", None if r.random() < 0.03 else sent, clear))
    df = spark.createDataFrame([*data, *data[:30]], f"unit {kind}, s int, e int")
    at = {c: F.timestamp_seconds(F.col(c) * 60 + 1_700_000_000) for c in ("s", "e")}
    return df.withColumns(at).repartition(4)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["int", "string"])
@pytest.mark.parametrize("crowd", [0.0, 0.4, 1.0])
def test_busy_units_in_buckets_equal_plain_windows(spark, kind, crowd):
    df = dispatched(spark, 1, kind=kind, crowd=crowd)
    events = iv.unit_events(df, "unit", "s", "e")
    was = F.coalesce(F.lag("state").over(W.partitionBy("unit").orderBy("at", "state")), F.lit(0))
    changes = events.withColumn("delta", F.col("state") - was).where("delta <> 0").select("at", "unit", "delta")
    upto = W.orderBy("at", "delta", "unit").rowsBetween(W.unboundedPreceding, 0)
    want = rows(changes.withColumn("busy", F.sum("delta").over(upto)))
    for n in (1, 2, 9):
        assert rows(iv.concurrency(df, "unit", "s", "e", n)) == want


def test_busy_units_are_dealt_once(spark):
    """One exchange of the rows, by bucket alone; both orders are made from it, and nothing is written for it but states at edges."""
    plan = plan_of(iv.concurrency(dispatched(spark, 2), "unit", "s", "e", 8))
    assert plan.count("Exchange hashpartitioning(__bucket") == 2  # the rows, and one sum per bucket
    assert plan.count("Window [") + plan.count("Window (") + plan.count("Window[") >= 3
    assert "HashAggregate(keys=[unit" not in plan and "hashpartitioning(unit" not in plan


def test_crowded_instant_is_spread(spark):
    """No bucket holds most of the rows when all units are sent at one instant."""
    df = spark.range(8000).select(F.col("id").alias("unit"), F.timestamp_seconds(F.lit(0)).alias("s"), F.timestamp_seconds(F.col("id") % 50 + 9).alias("e"))
    got = iv.concurrency(df, "unit", "s", "e", 8)
    assert got.count() == 16000 and got.agg(F.max("busy")).first()[0] == 8000
    cuts = o.plan_cuts(df.select(F.explode(F.array(F.unix_micros("s"), F.unix_micros("e"))).alias("at"), "unit"), ["at", "unit"], 8)
    sizes = o.with_buckets(df.select(F.unix_micros("s").alias("at"), "unit"), ["at", "unit"], cuts, "b").groupBy("b").count().collect()
    assert max(x["count"] for x in sizes) < 4000


@pytest.mark.parametrize("load", ["during", "after"])
def test_load_bands_weigh_instants(spark, monkeypatch, load):
    """Changes of an instant become one row before they are put in order."""
    conc = iv.concurrency(dispatched(spark, 3), "unit", "s", "e", 1).cache()
    inorder = W.orderBy("at", "delta", "unit")
    near = F.lead("at").over(inorder) - F.col("at") if load == "during" else F.col("at") - F.lag("at").over(inorder)
    length = F.sum("length")
    share = [F.coalesce(F.sum(F.when(c, F.col("length"))), F.lit(0)) / length for c in (F.col("busy") <= 5, F.col("busy").between(6, 9), F.col("busy") > 9)]
    want = tuple(conc.withColumn("length", near).agg(*share).first())
    seen = []
    plain = iv.neighbour
    monkeypatch.setattr(iv, "neighbour", lambda df, *a, **k: seen.append(df.count()) or plain(df, *a, **k))
    for n in (1, 6):
        assert tuple(iv.load_band_share(conc, (5, 9), load, n).first()) == pytest.approx(want)
    assert set(seen) == {conc.select("at").distinct().count()} and seen[0] < conc.count()


def test_what_follows_large_inputs_reads_them_once(spark, monkeypatch, small_buckets):
    """The few rows that episodes and levels need are written before they are read several times."""
    df = dispatched(spark, 4)
    conc = iv.concurrency(df, "unit", "s", "e", 1)
    want = {1: rows(iv.saturation_episodes(conc, 6, 1)), 2: rows(iv.created_while_saturated(df.select("s"), "s", conc, 6, n=1))}
    seen = []
    plain = iv.running_sum
    monkeypatch.setattr(iv, "running_sum", lambda df, *a, **k: seen.append(plan_of(df)) or plain(df, *a, **k))
    assert rows(iv.saturation_episodes(conc, 6, 5)) == want[1]
    assert rows(iv.created_while_saturated(df.select("s"), "s", conc, 6, n=5)) == want[2]
    assert len(seen) == 2 and not any("Window" in x or "__bucket" in x for x in seen)


def test_idle_time_deals_rows_once(spark):
    """One exchange for the rows of all units that are not hot, before a row becomes two events."""
    df = dispatched(spark, 5, hot=0.0)
    plan = plan_of(iv._idle_in_shifts(df.withColumn("shift", iv.shift_number("s", "2023-11-14 07:00:00")), "unit", "s", "e", "2023-11-14 07:00:00", 8))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")


@pytest.mark.parametrize("hot", [0.0, 0.7])
def test_idle_time_of_hot_units_and_repeated_rows(spark, tmp_path, hot):
    """Cut or not, idle hours are those of plain windows over distinct events."""
    dispatched(spark, 6, hot=hot).write.parquet(f"{tmp_path}/d")
    df, shift0 = spark.read.parquet(f"{tmp_path}/d"), "2023-11-14 07:00:00"
    before = W.partitionBy("unit", "shift").orderBy("at", "state")
    events = iv.unit_events(df.withColumn("shift", iv.shift_number("s", shift0)).where("shift > 0"), "unit", "s", "e", ["shift"])
    want = rows(iv._idle_hours(events.select("*", F.lag("at").over(before).alias("__at"), F.lag("state").over(before).alias("__state")), shift0))
    assert rows(iv.idle_time(df, "unit", "s", "e", shift0)) == want
    spark.conf.set(o.BUCKET_BYTES_KEY, "9000")
    try:
        assert rows(iv.idle_time(df, "unit", "s", "e", shift0)) == want
    finally:
        spark.conf.unset(o.BUCKET_BYTES_KEY)


@pytest.mark.parametrize("keys", ["unit", ["unit", "odd"], []])
def test_trailing_sums_of_hot_keys_in_buckets(spark, keys):
    """A stretch of a hot key is cut along time, and its sums stay those of the whole stretch."""
    df = dispatched(spark, 7, n=300, hot=0.5, crowd=0.1).select("unit", (F.col("unit") % 2).alias("odd"), F.col("s").alias("ts"), F.monotonically_increasing_id().alias("id"))
    sums = {"a": (F.lit(1).cast("bigint"), 3600), "b": (F.col("id") % 5, 20000), "c": (F.when(F.col("id") % 50 == 0, float("inf")).otherwise(0.5), 1800)}
    df = df.cache()
    got = w.sums_last(df, keys, "ts", sums, n=12)
    assert rows(got) == rows(w.sums_last(df, keys, "ts", sums, n=1))
    assert "__seed" in plan_of(got)
