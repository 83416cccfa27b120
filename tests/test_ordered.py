"""Bucketed order operators give what plain windows give, for hot keys, ties, NULLs and empty frames."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from callgrid.operators import ordered as o, windows as w

SCHEMA = "key string, t long, id long, v double"


def frame(spark, seed, n=400, hot=0.5):
    r = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if r.random() < hot else r.choice(["a", "b", None])
        t = 50 if r.random() < 0.4 else r.randrange(100)  # one instant holds many rows
        data.append((key, None if r.random() < 0.02 else t, i, r.choice([None, 1.0, 2.0, -3.0])))
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sums(spark, seed, keys, inclusive):
    df = frame(spark, seed)
    args = dict(order=["t", "id"], keys=keys, totals={"s": "all"}, inclusive=inclusive)
    plain = o.running_sums(df, {"s": "v", "c": F.lit(1)}, n=1, **args)
    cut = o.running_sums(df, {"s": "v", "c": F.lit(1)}, n=7, **args)
    assert rows(plain, "id", "s", "c", "all") == rows(cut, "id", "s", "c", "all")


@pytest.mark.parametrize("following", [True, False])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_neighbour(spark, keys, following):
    df = frame(spark, 4)
    got = [o.neighbour(df, {"p": "id", "q": "v"}, ["t", "id"], keys, following, n=n) for n in (1, 9)]
    assert rows(got[0], "id", "p", "q") == rows(got[1], "id", "p", "q")


def test_heavy_value_is_cut_further(spark):
    df = frame(spark, 5, n=2000, hot=1.0).where("t is not null")
    cuts = o.plan_cuts(df, ["t", "id"], 10)
    assert cuts.heavy == (50.0,) and len(cuts.second) >= 2
    sizes = o.with_buckets(df, ["t", "id"], cuts, "b").groupBy("b").agg(
        F.count("*").alias("n"), F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi")
    )
    got = sizes.orderBy("b").collect()
    assert max(r["n"] for r in got) < 600
    assert all(tuple(a["hi"]) < tuple(b["lo"]) for a, b in zip(got, got[1:]))


def test_text_order(spark):
    words = [(w_, i) for i, w_ in enumerate(["", "a", "ab", "abcdefg", "abcdefh", "é", "zz", None] * 20)]
    df = spark.createDataFrame(words, "w string, id long")
    got = [rows(o.row_positions(df, ["w", "id"], n=n), "id", "position") for n in (1, 6)]
    assert got[0] == got[1]


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_exact_quantiles(spark, keys):
    df = frame(spark, 6)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = [rows(o.exact_quantiles(df, "t", probs, keys, n=n).select(*keys, *[F.round(p, 9) for p in probs])) for n in (1, 6)]
    assert got[0] == got[1]


def test_empty_and_single_row(spark):
    for data in ([], [("a", 1, 1, 2.0)]):
        df = spark.createDataFrame(data, SCHEMA)
        assert o.running_sum(df, "v", ["t", "id"], ["key"], n=4).count() == len(data)
        assert o.neighbour(df, {"p": "id"}, ["t", "id"], n=4).count() == len(data)
        assert o.exact_quantiles(df, "v", {"m": 0.5}, ["key"], n=4).count() == len(data)


def test_sum_last_against_brute_force(spark):
    r = random.Random(7)
    data = [(r.choice(["a", "b", None]), 1_700_000_000 + r.choice([0, 60, 3600, 86400]) * r.randrange(4), i, r.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(data, "key string, s long, id long, v long").withColumn("ts", F.timestamp_seconds("s"))
    got = {x["id"]: x["trailing"] for x in w.sum_last(df, "key", "ts", "v", 86400).collect()}
    for key, s, i, _ in data:
        assert got[i] == sum(v for k2, s2, _, v in data if k2 == key and s - 86400 <= s2 < s)


def test_sum_last_forgets_large_and_odd_values(spark):
    """What is out of sight leaves no trace: no difference of growing sums."""
    odd = [("a", 0, 1e17), ("a", 100, 1.0), ("a", 110, 2.0), ("a", 120, 4.0), ("a", None, 8.0)]
    odd += [("b", 0, float("nan")), ("b", 2000, 2.0), ("b", 2010, 1.0), ("c", 0, float("inf")), ("c", 40, 1.0), ("c", 95, 1.0)]
    df = spark.createDataFrame(odd, "key string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    got = {(x["key"], x["s"]): x["trailing"] for x in w.sum_last(df, "key", "ts", "v", 50).collect()}
    want = {0: 0.0, 100: 0.0, 110: 1.0, 120: 3.0, None: 0.0}
    assert {s: v for (k, s), v in got.items() if k == "a"} == want
    assert (got["b", 2000], got["b", 2010]) == (0.0, 2.0)
    assert (got["c", 40], got["c", 95]) == (float("inf"), 0.0)


def test_text_order_is_cut_into_many_buckets(spark):
    """Keys with a long common start spread as numbers do, and a frequent text is cut along the second column."""
    df = spark.range(20000).select(F.lit("k").alias("key"), F.format_string("FCF15%09d", "id").alias("t"), "id")
    half = df.withColumn("t", F.when(F.col("id") % 2 == 0, "FCF15x").otherwise(F.col("t")))
    for rows_, order in ((df, ["t"]), (half, ["t", "id"])):
        cuts = o.plan_cuts(rows_, order, 16)
        sizes = [r["n"] for r in o.with_buckets(rows_, order, cuts, "b").groupBy("b").agg(F.count("*").alias("n")).collect()]
        assert len(sizes) >= 12 and max(sizes) < 4000
        got = o.row_positions(rows_, ["t", "id"], ["key"], cuts=cuts).select("t", "id", "position").collect()
        assert [x[2] for x in sorted(got)] == list(range(20000))


def test_prior_count_without_key_is_null(spark):
    df = frame(spark, 8, n=50)
    got = w.prior_count(df, "key", ["t", "id"], n=3)
    assert got.where("key is null and prior is not null").count() == 0
    assert got.where("key = 'hot'").agg(F.max("prior")).first()[0] == df.where("key = 'hot'").count() - 1


def test_hot_key_is_spread(spark):
    """No task sees more than a fraction of a key that holds every row."""
    df = spark.range(20000).select(F.lit("k").alias("key"), F.col("id").alias("t"))
    cuts = o.plan_cuts(df, "t", 16)
    sizes = [r["n"] for r in o.with_buckets(df, "t", cuts, "b").groupBy("key", "b").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 3000


@pytest.mark.parametrize("stretch", [1, 3, 7, 1000])
def test_halo_gives_what_a_window_over_the_key_gives(spark, stretch):
    """Keys of very different length, shorter and longer than a stretch and its surroundings; a null key."""
    from pyspark.sql import Window as W, functions as F

    from callgrid.operators.ordered import with_halo

    data = [(k, i * i % 1009, i) for k, n in (("a", 40), ("b", 1), (None, 9), ("c", 8)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(5)
    near = lambda w: [F.lag("v", 4).over(w).alias("p4"), F.lag("v", 1).over(w).alias("p1"), F.lead("v", 2).over(w).alias("n2"), F.sum("v").over(w.rowsBetween(-4, 2)).alias("s")]
    halo = with_halo(df, "t", "k", back=4, ahead=2, stretch=stretch)
    got = halo.select("k", "t", "v", "__home", *near(W.partitionBy("k", "__stretch").orderBy("t"))).where("__home").drop("__home")
    assert rows(got) == rows(df.select("k", "t", "v", *near(W.partitionBy("k").orderBy("t"))))
