"""Hand-made frames: empty input, NULLs, ties, gaps, single classes, boundary codes."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from callgrid.functions import calendar as cal, numeric as num, text as tx
from callgrid.operators import aggregates as a, cleaning as c, filters as f, intervals as iv, joins as j, ranking as r, scoring as sc, series as s, windows as w

TS = "timestamp'{}'"


def ts(text):
    return dt.datetime.fromisoformat(text)


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "code, kind, level, rest",
    [("6D1", "6", "D", "1"), ("06D1", "6", "D", "1"), ("STRUCT", "STRUCT", None, None), ("123A4", "123", "A", "4"), ("9E", "9", "E", ""), (None, None, None, None)],
)
def test_split_code(spark, code, kind, level, rest):
    got = one(spark, tx.split_code(F.lit(code).cast("string")))
    assert (got["code_type"], got["code_level"], got["code_rest"]) == (kind, level, rest)


@pytest.mark.parametrize(
    "day, expected",
    [
        ("2015-12-25", True), ("2015-01-01", True), ("2015-07-04", True), ("2015-01-19", True), ("2015-02-16", True), ("2015-05-25", True),
        ("2015-09-07", True), ("2014-09-08", False), ("2015-10-12", True), ("2015-11-26", True), ("2015-11-27", True), ("2011-12-26", True),
        ("2010-12-27", True), ("2015-12-26", False), ("2015-03-02", False), ("2016-05-30", True), ("2016-05-31", False),
    ],
)
def test_holidays(spark, day, expected):
    assert one(spark, cal.is_holiday(F.lit(day).cast("date"))) is expected


def test_nln_and_units(spark):
    df = spark.createDataFrame([("6D1",), ("26AO",), ("123A1",), ("D1",), (None,)], "c string")
    assert [x[0] for x in df.select(tx.is_nln("c")).collect()] == [True, True, False, False, False]
    units = spark.createDataFrame([("A23",), ("R1",), ("M05",), ("E12",)], "u string")
    assert [x[0] for x in units.select(tx.unit_to_m("u")).collect()] == ["M23", "R1", "M05", "E12"]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None)], "a double, b double")
    assert [x[0] for x in df.select(num.safe_ratio("a", "b")).collect()] == [0.5, 0.0, 0.0, 0.0]


def test_flag_by_code_text_precedence_and_null(spark):
    df = spark.createDataFrame(
        [("MT", "DONE"), ("MT", "NO PATIENT"), ("TEST", "X"), ("X", "TRANSPORTED"), ("X", "NO TRANSPORT"), ("TRANS", "NO"), ("NCT", None), (None, None), ("MT", None)],
        "c string, t string",
    )
    assert [x["transported"] for x in f.flag_by_code_text(df, "c", "t").collect()] == [True, False, False, True, False, True, True, False, False]


def test_fix_indices(spark):
    df = spark.createDataFrame([("13OO12",), (" 7 ",), ("x",), (None,)], "k string")
    assert [x[0] for x in c.fix_indices(df, "k").collect()] == ["FCF000000130012", "FCF000000000007", None, None]


def test_prettify_date_picks_one_reading_per_column(spark):
    df = spark.createDataFrame(
        [("2015-08-16 23:59:59", "20150816235959", "20150816235959.0", "235959", "x"), (None, "", None, "101", "20150816235959")],
        "a string, b string, c string, d string, e string",
    )
    out = df
    for name in df.columns:
        out = c.prettify_date(out, name)
    first, second = out.collect()
    moment = ts("2015-08-16 23:59:59")
    assert (first["a"], first["b"], first["c"], first["d"], first["e"]) == (moment, moment, moment, 86399, "x")
    assert (second["a"], second["b"], second["c"], second["d"]) == (None, None, None, 61)


def test_drop_empty_columns(spark):
    df = spark.createDataFrame(
        [(1, None, "a", True, None, 1), (2, None, "a", False, "x", 2), (3, None, "a", True, "y", 2)],
        "id int, gone string, same string, two boolean, three string, pair int",
    )
    assert c.drop_empty_columns(df)[1] == ["gone", "same"]
    assert c.drop_empty_columns(df, 2)[1] == ["gone", "same", "two", "pair"]


def test_checks(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 1.0), (None, None)], "k int, y double")
    ok = lambda d: d.first()["ok"]
    assert not ok(c.check_unique(df, "k")) and ok(c.check_unique(df.limit(0), "k"))
    assert not ok(c.check_binary_domain(df, "y")) and ok(c.check_binary_domain(df.na.drop(), "y"))
    assert not ok(c.check_binary_domain(df.where("y = 1"), "y")) and ok(c.check_binary_domain(df.where("y = 1"), "y", both=False))
    assert ok(c.check_column_value(df, F.col("y") >= 0)) and not ok(c.check_table_has_nrows(df, 4))
    assert rows(c.misaligned_rows(df, df.limit(2), "k")) == [(None, 1, 0)]


def test_null_keys_in_joins(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, x string")
    right = spark.createDataFrame([(1, "z"), (None, "n"), (1, "y")], "k int, v string")
    assert rows(j.left_join_prefixed(left, right, "k", "k", "r").select("x", "r__v")) == [("a", "y"), ("a", "z"), ("b", None), ("c", None)]
    assert j.left_join_prefixed(left, right, "k", "k", prefix=False).columns == ["k", "x", "v"]
    assert rows(f.flag_not_in(left, right, "k"), "x", "absent") == [("a", False), ("b", True), ("c", True)]


def test_lag_is_by_calendar_day(spark):
    df = spark.createDataFrame([(dt.date(2015, 1, 1), "a", 5), (dt.date(2015, 1, 3), "a", 7), (dt.date(2015, 1, 2), "b", 9)], "day date, g string, n int")
    got = {(x["day"].day, x["g"]): (x["n_lag1"], x["n_lag2"]) for x in j.lag_by_key(df, "day", "n", [1, 2], "g").collect()}
    assert got == {(1, "a"): (0, 0), (3, "a"): (0, 5), (2, "b"): (0, 0)}


def test_delayed_feature_first_days_gap_and_absent_group(spark):
    data = [(1, "2015-01-01 10:00", "a", 2.0), (2, "2015-01-01 11:00", "a", 4.0), (3, "2015-01-02 10:00", "b", 1.0), (4, "2015-01-04 10:00", "a", 8.0), (5, "2015-01-04 12:00", None, 8.0)]
    df = spark.createDataFrame([(i, ts(t), g, v) for i, t, g, v in data], "id int, t timestamp, g string, v double")
    get = lambda *args, **kw: {x["id"]: x["delayed"] for x in w.delayed_feature(df, "t", "v", *args, **kw).collect()}
    # no group: the first day sees itself, the 2nd the 1st, the 4th a day without rows
    assert get(1, "mean") == {1: 3.0, 2: 3.0, 3: 3.0, 4: 0.0, 5: 0.0}
    # by group: b is absent on the first day
    assert get(1, "sum", "g") == {1: 6.0, 2: 6.0, 3: 0.0, 4: 0.0, 5: 0.0}
    # three days up to yesterday; the imputed day before the first counts once
    assert get(1, "sum", None, 3) == {1: 6.0, 2: 6.0, 3: 12.0, 4: 7.0, 5: 7.0}


def test_concurrency_ties_and_repeats(spark):
    t = "2015-01-01 {}"
    data = [
        ("m1", t.format("08:00"), t.format("09:00")),
        ("m2", t.format("09:00"), t.format("10:00")),  # starts as m1 ends
        ("m2", t.format("09:30"), t.format("10:00")),  # sent again before it was clear
        ("m3", t.format("09:15"), None),
    ]
    df = spark.createDataFrame([(u, ts(x), ts(y) if y else None) for u, x, y in data], "u string, s timestamp, e timestamp")
    conc = iv.concurrency(df, "u", "s", "e")
    got = [(x["unit"], x["delta"], x["busy"]) for x in conc.orderBy("at", "delta", "unit").collect()]
    assert got == [("m1", 1, 1), ("m1", -1, 0), ("m2", 1, 1), ("m3", 1, 2), ("m2", -1, 1)]
    episodes = iv.saturation_episodes(conc, 2).collect()
    assert len(episodes) == 1 and episodes[0]["end"] - episodes[0]["start"] == 45 * 60 * 1_000_000
    open_end = iv.saturation_episodes(conc, 1).orderBy("episode").collect()
    assert [x["end"] is None for x in open_end] == [False, True]
    share = iv.load_band_share(conc, (0, 1)).first()
    assert share["mid_share"] == pytest.approx((60 + 15) / 120) and share["high_share"] == pytest.approx(45 / 120)
    asked = spark.createDataFrame([(1, ts(t.format("09:20"))), (2, ts(t.format("09:15"))), (3, ts(t.format("07:00")))], "id int, c timestamp")
    flags = {x["id"]: x["saturated"] for x in iv.created_while_saturated(asked, "c", conc, 2).collect()}
    assert flags == {1: True, 2: False, 3: False}


def test_idle_time(spark):
    day = "2015-01-01 {}"
    data = [("m1", day.format("08:00"), day.format("09:00")), ("m1", day.format("11:30"), day.format("12:00")), ("m1", "2015-01-02 03:00", "2015-01-02 04:00")]
    df = spark.createDataFrame([(u, ts(x), ts(y)) for u, x, y in data], "u string, s timestamp, e timestamp")
    idle = iv.idle_time(df, "u", "s", "e", "2015-01-01 07:00:00")
    assert rows(idle) == [("m1", 1, 1.0 + 2.5 + 15.0)]
    early = df.withColumn("s", F.col("s") - F.expr("interval 5 hours"))
    assert iv.idle_time(early.limit(1), "u", "s", "e", "2015-01-01 07:00:00").count() == 0
    assert rows(iv.median_idle(idle)) == [("m1", 18.5)]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1), (None, 0.5), (1, None)], "y int, s double")
    got = {x["k"]: x for x in sc.metrics_at_k(df, "y", "s", [0.0, 0.5], (3, -5, -1, 1)).collect()}
    assert (got[0.0]["precision"], got[0.0]["recall"], got[0.0]["auc"]) == (1.0, 0.5, 0.75)
    assert got[0.5]["threshold"] == 0.7 and got[0.5]["precision"] == pytest.approx(2 / 3)
    assert got[0.0]["score"] == (3 * 1 - 5 * 1 - 0 + 1 * 2) / 4
    single = sc.metrics_at_k(df.where("y = 1"), "y", "s", [0.0]).first()
    assert single["auc"] is None and single["recall"] == 0.5
    assert sc.metrics_at_k(df.limit(0), "y", "s", keys=["y"]).count() == 0


def test_pr_curve_stops_at_full_recall(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "y int, s double")
    assert [x["threshold"] for x in sc.pr_curve(df, "y", "s").orderBy(F.desc("threshold")).collect()] == [0.9, 0.8, 0.7]


def test_cut_stats_on_and_between_values(spark):
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate([1, 1, 2, 3, 3])], "y int, s double")
    got = {x["k"]: x for x in sc.cut_stats(df, "y", "s", [0.5, 0.6, 0.0, 1.0]).collect()}
    assert (got[0.5]["level"], got[0.5]["n_ge"], got[0.5]["n_gt"]) == (2.0, 3, 2)
    assert (got[0.6]["level"], got[0.6]["n_ge"], got[0.6]["n_gt"]) == (pytest.approx(1.6), 3, 3)
    assert (got[0.0]["n_ge"], got[0.0]["n_gt"], got[1.0]["n_ge"], got[1.0]["n_gt"]) == (2, 0, 5, 3)


def test_reg_metrics_skip_zero(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 10.0, 12.0), (3, 10.0, 8.0)], "i int, y double, p double")
    got = sc.reg_metrics(df, "y", "p", ["i"], 0.25, "exp", (1, 3)).first()
    assert got["mape"] == pytest.approx(0.2) and got["mae"] == pytest.approx(3.0)
    assert got["twscore"] == pytest.approx((1 * 0.2 * 0.5 + 3 * 0.2 * 0.25) / 2)
    assert sc.reg_metrics(df.limit(1), "y", "p", ["i"]).first()["mape"] is None


def test_suggest(spark):
    df = spark.createDataFrame([("high", 0.0), ("medium", 0.2), ("medium", 0.3), ("low", 0.6), ("low", None)], "b string, f double")
    assert [x["mt_suggested"] for x in sc.suggest(df, "f", "b").collect()] == [True, False, True, True, False]


def test_series_edges(spark):
    df = spark.createDataFrame([(ts("2015-01-01 05:00"), "a"), (ts("2015-01-04 05:00"), "a"), (None, "a")], "t timestamp, g string")
    assert [x["n"] for x in s.regular_series(df, "t", "day", "g").orderBy("t").collect()] == [1, 0, 0, 1]
    assert s.regular_series(df.limit(0), "t", "day", "g").count() == 0
    flat = spark.createDataFrame([(i, 1.0) for i in range(5)], "t int, v double")
    assert [x["acf"] for x in s.acf(flat, "t", "v", 2).collect()] == [None, None, None]


def test_granger_finds_a_driver(spark):
    import random

    rnd = random.Random(1)
    x = [rnd.gauss(0, 1) for _ in range(300)]
    y = [0.0] + [0.8 * x[i] + rnd.gauss(0, 0.3) for i in range(299)]
    df = spark.createDataFrame([(i, y[i], x[i]) for i in range(300)], "t int, y double, x double")
    forward = {r_["lag"]: r_["f_stat"] for r_ in s.granger_f(df, "t", "y", "x", 3).collect()}
    backward = {r_["lag"]: r_["f_stat"] for r_ in s.granger_f(df, "t", "x", "y", 3).collect()}
    assert forward[1] > 100 > 5 > backward[1]


def test_histogram_ends(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    got = [(x["bin"], x["n"]) for x in a.histogram(df, "v", 4).orderBy("bin").collect()]
    assert got == [(0, 1), (1, 0), (2, 1), (3, 1)]
    same = a.histogram(df.where("v = 5"), "v", 2).orderBy("bin").collect()
    assert [(x["from"], x["n"]) for x in same] == [(4.5, 0), (5.0, 1)]
    assert a.histogram(df.limit(0), "v", 4).count() == 0


def test_kth_largest_and_ties(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (1.0,), (None,)], "v double")
    assert r.kth_largest(df, "v", 0.34).first()[0] == 3.0 and r.kth_largest(df, "v", 0.67).first()[0] == 1.0


def test_late_events_and_first(spark):
    data = [("e", "2015-01-01 10:00:00", 1), ("e", "2015-01-01 10:01:00", 2), ("e", "2015-01-01 10:01:01", 3), ("f", None, 1)]
    df = spark.createDataFrame([(k, ts(t) if t else None, i) for k, t, i in data], "k string, t timestamp, i int")
    assert rows(j.late_events(df, "k", "t", 60)) == [("e", 1)]
    assert rows(c.delete_duplicates(df, "k", ["i"]), "k", "i") == [("e", 1), ("f", 1)]


def test_itinerary(spark):
    data = [("m", 1, ts("2015-01-01 08:00"), ts("2015-01-01 08:30"), ts("2015-01-01 09:00"), "home", "north"), ("m", 2, ts("2015-01-01 10:00"), None, ts("2015-01-01 11:00"), "park", "south"), ("m", 3, ts("2015-01-01 12:00"), None, ts("2015-01-01 13:00"), "mall", None)]
    df = spark.createDataFrame(data, "u string, k int, d timestamp, h timestamp, c timestamp, place string, hosp string")
    got = [(x["purpose"], x["location"], x["at"].hour) for x in iv.itinerary(df, "u", "k", "d", "h", "c", "place", "hosp").orderBy("at").collect()]
    assert got == [("p", "home", 8), ("h", "north", 8), ("p", "park", 10), ("h_notime", "south", 11), ("p", "mall", 12)]
