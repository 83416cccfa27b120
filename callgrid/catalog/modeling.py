"""Preparation, training and scoring of models."""

from pyspark.sql import functions as F

from ..operators import modeling as m
from ..operators.filters import split_by_year, split_last_days
from .base import INCIDENTS, query


@query(
    "one_hot",
    """
    SELECT o_orderkey, (o_orderstatus = 'O')::int AS o_orderstatus_is_O, (o_orderstatus = 'P')::int AS o_orderstatus_is_P,
           (o_custkey % 3 = 0)::int AS code_type_is_0, (o_custkey % 3 = 1)::int AS code_type_is_1, (o_custkey % 3 = 2)::int AS code_type_is_2
    FROM orders
    """,
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 3).cast("string").alias("code_type"))
    return m.one_hot(rows, ["o_orderstatus", "code_type"], keep_all=["code_type"])


_HOLES = """
    h AS (SELECT o_orderkey, year(o_orderdate) AS y, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
                 CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 50 END::double AS c, (o_orderstatus = 'F')::int AS f FROM orders),
    tr AS (SELECT * FROM h WHERE y IN (1997, 1998)), te AS (SELECT * FROM h WHERE y = 1999)
"""


def _holes(t):
    rows = t.orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("y"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_custkey") % 5 > 0, (F.col("o_custkey") % 50).cast("double")).alias("c"),
        (F.col("o_orderstatus") == "F").cast("int").alias("f"),
    )
    return split_by_year(rows, "y", 1997, 2, 1999, 1)


@query(
    "impute_median",
    f"""
    WITH {_HOLES}
    SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM tr)), 4) AS price, round(coalesce(c, (SELECT median(c) FROM tr)), 4) AS c
    FROM (SELECT * FROM tr UNION ALL SELECT * FROM te)
    """,
    digits=4,
)
def _(t):
    train, test = m.impute_median(*_holes(t), ["price", "c"])
    return train.unionByName(test).select("o_orderkey", "price", "c")


@query(
    "standardise",
    f"""
    WITH {_HOLES}, s AS (SELECT avg(price) AS pm, stddev_pop(price) AS pd, avg(c) AS cm, stddev_pop(c) AS cd FROM tr)
    SELECT o_orderkey, round((price - pm) / pd, 5) AS price, round((c - cm) / cd, 5) AS c, f FROM (SELECT * FROM tr UNION ALL SELECT * FROM te), s
    """,
    digits=5,
)
def _(t):
    train, test = m.standardise(*_holes(t), ["price", "c", "f", "y"], "y")
    return train.unionByName(test).select("o_orderkey", "price", "c", "f")


@query(
    "linear_model_per_group",
    """
    SELECT event_type, round(regr_intercept(value, x) + regr_slope(value, x) * avg(x), 5) AS intercept,
           round(regr_slope(value, x) * stddev_pop(x), 5) AS weight, count(*) AS rows
    FROM (SELECT *, hour(ts)::double AS x FROM events) GROUP BY 1
    """,
    digits=5,
)
def _(t):
    fitted = m.fit_per_group(t.events.withColumn("x", F.hour("ts")), "event_type", "value", ["x"])
    return fitted.select("event_type", "intercept", F.col("coefficients")[0].alias("weight"), "rows")


@query(
    "lasso_per_group",
    """
    WITH s AS (SELECT event_type, avg(value) AS intercept, covar_pop(value, x) / stddev_pop(x) AS r, count(*) AS n
               FROM (SELECT *, hour(ts)::double AS x FROM events) GROUP BY 1)
    SELECT event_type, round(intercept, 5) AS intercept, round(sign(r) * greatest(abs(r) - 0.1, 0), 5) + 0.0 AS weight FROM s
    """,
    digits=5,
)
def _(t):
    fitted = m.fit_per_group(t.events.withColumn("x", F.hour("ts")), "event_type", "value", ["x"], "LASSO", 0.1)
    return fitted.select("event_type", "intercept", F.col("coefficients")[0].alias("weight"))


@query(
    "ridge_per_group",
    """
    WITH s AS (SELECT event_type, covar_pop(value, x) / stddev_pop(x) AS r, count(*) AS n
               FROM (SELECT *, hour(ts)::double AS x FROM events) GROUP BY 1)
    SELECT event_type, round(r / (1 + 10.0::double / n), 5) AS weight FROM s
    """,
    digits=5,
)
def _(t):
    fitted = m.fit_per_group(t.events.withColumn("x", F.hour("ts")), "event_type", "value", ["x"], "RIDGE", 10.0)
    return fitted.select("event_type", F.col("coefficients")[0].alias("weight"))


@query(
    "predictions_per_group",
    """
    SELECT event_id, round(b + a * hour(ts), 5) AS pred FROM events JOIN
      (SELECT event_type, regr_intercept(value, hour(ts)::double) AS b, regr_slope(value, hour(ts)::double) AS a FROM events GROUP BY 1) USING (event_type)
    """,
    digits=5,
)
def _(t):
    rows = t.events.withColumn("x", F.hour("ts"))
    models = m.fit_per_group(rows, "event_type", "value", ["x"])
    return m.predict_per_group(rows, models, "event_type", ["x"]).select("event_id", "pred")


@query("elastic_net_per_station")
def _(t):
    rows = t.incidents.select("station_name", "value", F.hour("time_created").alias("hour"), F.col("k").alias("k"), F.weekday("time_created").alias("wd"))
    fitted = m.fit_per_group(rows, "station_name", "value", ["hour", "k", "wd"], "ELNET", 0.1, 0.5)
    return fitted.select("station_name", "rows", "intercept", *[F.col("coefficients")[i].alias(f"w{i}") for i in range(3)])


@query(
    "logistic_gain_base_rates",
    f"""
    WITH {INCIDENTS}, tr AS (SELECT code_type, avg(trns_to_hosp::int) AS p FROM incidents WHERE day(time_created) <= 20 GROUP BY 1),
    ok AS (SELECT code_type FROM incidents GROUP BY 1 HAVING count(*) >= 50)
    SELECT code_type AS inc_type_id, round(p * p + (1 - p) * (1 - p), 6) AS base_acc FROM tr JOIN ok USING (code_type) WHERE p > 0 AND p < 1
    """,
)
def _(t):
    return _gain(t).select("inc_type_id", "base_acc")


def _gain(t):
    rows = t.incidents.withColumn("hour", F.hour("time_created"))
    train, test = rows.where("day(time_created) <= 20"), rows.where("day(time_created) > 20")
    return m.logistic_gain_by_type(train, test, "code_type", "hour", "trns_to_hosp")


@query("logistic_gain_by_type")
def _(t):
    return _gain(t)


_LABELLED = """
    r AS (SELECT o_orderkey, (o_totalprice > 250000)::int AS y, o_totalprice / 1e5 + o_custkey % 7 AS x1, (o_custkey % 11)::double AS x2,
                 dayofyear(o_orderdate)::double AS x3, CASE WHEN year(o_orderdate) < 1999 THEN 'train' ELSE 'test' END AS split
          FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000),
    u AS (SELECT avg(x1) AS a1, stddev_pop(x1) AS s1, avg(x2) AS a2, stddev_pop(x2) AS s2, avg(x3) AS a3, stddev_pop(x3) AS s3 FROM r WHERE split = 'train'),
    z AS (SELECT o_orderkey, y, split, (x1 - a1) / s1 AS z1, (x2 - a2) / s2 AS z2, (x3 - a3) / s3 AS z3 FROM r, u)
"""


def _labelled(t):
    rows = t.orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("y"),
        (F.col("o_totalprice") > 250000).alias("label"),
        (F.col("o_totalprice") / 1e5 + F.col("o_custkey") % 7).alias("x1"),
        (F.col("o_custkey") % 11).cast("double").alias("x2"),
        F.dayofyear("o_orderdate").cast("double").alias("x3"),
    )
    return split_by_year(rows, "y", 1996, 3, 1999, 2)


def _scores(t, model, **params):
    train, test = m.standardise(*_labelled(t), ["x1", "x2", "x3"])
    return m.fit_score(train, test, "label", "o_orderkey", ["x1", "x2", "x3"], model, **params)


@query("classifier_logistic", digits=3)
def _(t):
    return _scores(t, "LR", penalty="l2", C=1.0)


@query("classifier_logistic_l1", digits=3)
def _(t):
    return _scores(t, "LR", penalty="l1", C=0.1)


@query("classifier_random_forest", digits=3)
def _(t):
    return _scores(t, "RF", n_estimators=10, max_depth=5)


@query("classifier_gradient_boosting", digits=3)
def _(t):
    return _scores(t, "GB", n_estimators=5, max_depth=3)


@query("classifier_decision_tree", digits=3)
def _(t):
    return _scores(t, "DT", criterion="entropy", max_depth=5)


@query(
    "classifier_logistic_conditions",
    f"WITH {_LABELLED} SELECT split, count(*) AS rows, 1 AS holds FROM z GROUP BY 1",
)
def _(t):
    """What single out the minimum, from scores alone: the weights are C times the sums of features times errors, so log odds
    less those are the same for every row; and errors of the train rows add up to 0."""
    train, test = m.standardise(*_labelled(t), ["x1", "x2", "x3"])
    names, scores = ["x1", "x2", "x3"], m.fit_score(train, test, "label", "o_orderkey", ["x1", "x2", "x3"], "LR", penalty="l2", C=1.0)
    rows = train.unionByName(test).join(scores, "o_orderkey")
    error = F.when(F.col("split") == "train", F.col("label").cast("double") - F.col("score"))
    sums = rows.agg(F.sum(error).alias("e"), *[F.sum(error * F.col(x)).alias(f"w_{x}") for x in names])
    odds = F.ln(F.col("score") / (1 - F.col("score")))
    found = sums.first()
    rest = rows.withColumn("rest", odds - sum((F.lit(found[f"w_{x}"]) * F.col(x) for x in names), F.lit(0.0)))
    ends = rest.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("rest").alias("a"), F.max("rest").alias("b"))
    return ends.select("split", "rows", ((F.col("b") - F.col("a") < 0.01) & F.lit(abs(found["e"]) < 0.01)).cast("int").alias("holds"))


@query(
    "classifier_naive_bayes",
    f"""
    WITH {_LABELLED},
    c AS (SELECT y, count(*) AS n, avg(z1) AS m1, var_pop(z1) AS v1, avg(z2) AS m2, var_pop(z2) AS v2, avg(z3) AS m3, var_pop(z3) AS v3 FROM z WHERE split = 'train' GROUP BY 1),
    l AS (SELECT o_orderkey, split, c.y, ln(n) - (ln(v1) + ln(v2) + ln(v3)) / 2 - (z1 - m1) ^ 2 / (2 * v1) - (z2 - m2) ^ 2 / (2 * v2) - (z3 - m3) ^ 2 / (2 * v3) AS l FROM z, c)
    SELECT o_orderkey, round(1 / (1 + exp(max(l) FILTER (y = 0) - max(l) FILTER (y = 1))), 3) AS score, split FROM l GROUP BY ALL
    """,
    digits=3,
)
def _(t):
    return _scores(t, "NB")


@query("classifier_linear_svm", digits=3)
def _(t):
    return _scores(t, "SVM")


@query("classifier_adaboost", digits=3)
def _(t):
    return _scores(t, "AB", n_estimators=5)


def _boosted_sql(rounds: int) -> str:
    """Boosting by leaf probabilities on three flags: each round weighs the 16 kinds of rows, cuts at the flag that leaves the
    least impurity, and adds the log odds of its two sides to the margins."""
    parts = [
        """g0 AS (SELECT y, b1, b2, b3, count(*)::double AS n, 0.0::double AS m FROM r WHERE split = 'train' GROUP BY ALL),
           a0 AS (SELECT DISTINCT b1, b2, b3, 0.0::double AS m FROM r)"""
    ]
    for i in range(rounds):
        parts.append(f"""
    w{i} AS (SELECT *, n * exp(-(y - 0.5) * m) AS w FROM g{i}),
    s{i} AS (SELECT f, v, sum(w) FILTER (y = 1) AS one, sum(w) FILTER (y = 0) AS zero
             FROM (SELECT y, w, unnest([1, 2, 3]) AS f, unnest([b1, b2, b3]) AS v FROM w{i}) GROUP BY ALL),
    c{i} AS (SELECT f FROM s{i} GROUP BY 1 ORDER BY sum(one * zero / (one + zero)), f LIMIT 1),
    l{i} AS (SELECT f, v, ln(one / zero) AS odds FROM s{i} JOIN c{i} USING (f)),
    g{i + 1} AS (SELECT y, b1, b2, b3, n, m + odds AS m FROM g{i} JOIN l{i} ON v = CASE f WHEN 1 THEN b1 WHEN 2 THEN b2 ELSE b3 END),
    a{i + 1} AS (SELECT b1, b2, b3, m + odds AS m FROM a{i} JOIN l{i} ON v = CASE f WHEN 1 THEN b1 WHEN 2 THEN b2 ELSE b3 END)""")
    return f"""
    WITH r AS (SELECT o_orderkey, (o_totalprice > 200000 + o_custkey % 3 * 60000 + (o_orderstatus = 'F')::int * 25000)::int AS y, (o_custkey % 3 = 0)::int AS b1,
                      (o_orderstatus = 'F')::int AS b2, (month(o_orderdate) > 6)::int AS b3, CASE WHEN year(o_orderdate) < 1999 THEN 'train' ELSE 'test' END AS split FROM orders),
    {", ".join(parts)}
    SELECT o_orderkey, round(1 / (1 + exp(-m / {rounds})), 6) AS score, split FROM r JOIN a{rounds} USING (b1, b2, b3)
    """


@query("classifier_adaboost_r", _boosted_sql(3))
def _(t):
    limit = 200000 + F.col("o_custkey") % 3 * 60000 + (F.col("o_orderstatus") == "F").cast("int") * 25000
    rows = t.orders.select(
        "o_orderkey",
        (F.col("o_totalprice") > limit).alias("y"),
        (F.col("o_custkey") % 3 == 0).cast("double").alias("b1"),
        (F.col("o_orderstatus") == "F").cast("double").alias("b2"),
        (F.month("o_orderdate") > 6).cast("double").alias("b3"),
        F.year("o_orderdate").alias("year"),
    )
    return m.fit_score(rows.where("year < 1999"), rows.where("year >= 1999"), "y", "o_orderkey", ["b1", "b2", "b3"], "AB", algorithm="SAMME.R", n_estimators=3)


@query(
    "classifier_knn",
    """
    WITH e AS (SELECT event_id, (event_type = 'purchase')::int AS y, hour(ts)::double AS a, (isodow(ts) - 1)::double AS b, floor(value / 20)::double AS c,
                      CASE WHEN day(ts) <= 20 THEN 'train' ELSE 'test' END AS split FROM events),
    q AS (SELECT DISTINCT a, b, c FROM e),
    n AS (SELECT q.*, t.y, (q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b) + (q.c - t.c) * (q.c - t.c) AS d2,
                 row_number() OVER (PARTITION BY q.a, q.b, q.c ORDER BY (q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b) + (q.c - t.c) * (q.c - t.c),
                                    t.a, t.b, t.c, t.event_id) AS r FROM q, e t WHERE t.split = 'train' QUALIFY r <= 25),
    s AS (SELECT a, b, c, avg(y) FILTER (r = 1) AS one, avg(y) FILTER (r <= 5) AS five,
                 CASE WHEN min(d2) = 0 THEN avg(y) FILTER (d2 = 0) ELSE sum(y / sqrt(d2)) / sum(1 / sqrt(d2)) END AS weighted FROM n GROUP BY ALL)
    SELECT event_id, split, round(one, 6) AS one, round(five, 6) AS five, round(weighted, 6) AS weighted FROM e JOIN s USING (a, b, c)
    """,
)
def _(t):
    rows = t.events.select(
        "event_id",
        (F.col("event_type") == "purchase").alias("y"),
        F.hour("ts").alias("a"),
        F.weekday("ts").alias("b"),
        F.floor(F.col("value") / 20).alias("c"),
        F.dayofmonth("ts").alias("day"),
    )
    train, test = rows.where("day <= 20"), rows.where("day > 20")
    kinds = {"one": (1, "uniform"), "five": (5, "uniform"), "weighted": (25, "distance")}
    found = [
        m.fit_score(train, test, "y", "event_id", ["a", "b", "c"], "KNN", n_neighbors=k, weights=w).withColumnRenamed("score", name)
        for name, (k, w) in kinds.items()
    ]
    return found[0].join(found[1], ["event_id", "split"]).join(found[2], ["event_id", "split"])


@query("classifier_grid_metrics", digits=4)
def _(t):
    from ..plans.training import run_grid

    rows = t.incidents.select(
        "incident", "trns_to_hosp", "code_type", F.hour("time_created").alias("hour"), "value", F.weekday("time_created").alias("wd"),
        F.dayofmonth("time_created").alias("day"),
    )
    train, test = rows.where("day <= 20"), rows.where("day > 20")
    buckets = {"high": ["9", "19", "28", "10", "27", "14"], "medium": ["12", "31", "13", "6", "8", "23"]}
    grid = {"LR": {"penalty": ["l2"], "C": [0.1, 1.0]}}
    return run_grid(train, test, "trns_to_hosp", "incident", ["hour", "value", "wd"], ["LR"], buckets, grid=grid)


@query("regressor_grid_metrics", digits=4)
def _(t):
    from ..plans.demand import daily_samples, demand_table, observed_hours
    from ..plans.training import run_regressors

    demand = demand_table(t.incidents, t.incidents, *observed_hours(t.incidents))
    days = daily_samples(demand)
    grid = {"LASSO": {"alpha": [0.01, 0.1]}, "LINEAR": {}}
    return run_regressors(days, "trns_to_hosp", ["trns_to_hosp_lag1", "trns_to_hosp_lag7"], first_year=2013, grid=grid)


@query(
    "train_test_days",
    f"""
    WITH {INCIDENTS}, d AS (SELECT cast(time_created AS date) AS day, station_name, cast(sum(m_required::int) AS bigint) AS r FROM incidents GROUP BY ALL)
    SELECT strftime(day, '%Y-%m-%d') AS day, station_name, r FROM d WHERE day > (SELECT max(day) FROM d) - 7
    """,
)
def _(t):
    rows = t.incidents.withColumn("r", F.col("m_required").cast("int"))
    days = rows.groupBy(F.to_date("time_created").alias("day"), "station_name").agg(F.sum("r").alias("r"))
    return split_last_days(days, "day", 2013, 7)[1]


@query(
    "prepared_bucket",
    """
    WITH r AS (SELECT o_orderkey AS id, year(o_orderdate) AS y, cast(o_custkey % 35 AS varchar) AS code_type,
                      CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS x, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 2)::double END AS c,
                      (o_orderkey % 3 = 0)::int::double AS d FROM orders),
    b AS (SELECT * FROM r WHERE code_type IN ('3', '5', '7', '11')),
    m AS (SELECT median(x) AS mx, median(c) AS mc FROM b WHERE y < 1999),
    f AS (SELECT id, y, code_type, coalesce(x, mx) AS x, coalesce(c, mc) AS c, d FROM b, m),
    s AS (SELECT avg(x) AS ax, stddev_pop(x) AS sx, avg(c) AS ac, stddev_pop(c) AS sc FROM f WHERE y < 1999)
    SELECT id, CASE WHEN y < 1999 THEN 'train' ELSE 'test' END AS split, round((x - ax) / sx, 6) AS x, round((c - ac) / sc, 6) AS c, d,
           (code_type = '3')::int::bigint AS code_type_is_3, (code_type = '5')::int::bigint AS code_type_is_5, (code_type = '7')::int::bigint AS code_type_is_7
    FROM f, s
    """,
)
def _(t):
    """A column of 0, 1 and NULL is scaled, one of 0 and 1 is not; the first code in order has no column."""
    from ..plans.training import bucket_features, prepare_bucket

    rows = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").alias("y"),
        (F.col("o_custkey") % 35).cast("string").alias("code_type"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("x"),
        F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_orderkey") % 2).cast("double")).alias("c"),
        (F.col("o_orderkey") % 3 == 0).cast("double").alias("d"),
        F.lit(0).alias("label"),
    )
    codes = ["3", "5", "7", "11"]
    train, test = prepare_bucket(rows.where("y < 1999"), rows.where("y >= 1999"), ["x", "c", "d"], "label", codes)
    names = bucket_features(["x", "c", "d"], codes)
    return train.select("id", F.lit("train").alias("split"), *names).union(test.select("id", F.lit("test"), *names))


_TWO = """
    r AS (SELECT l_suppkey AS g, l_quantity AS a, l_discount * 100 + l_quantity / 10 AS b, l_extendedprice AS y FROM lineitem),
    c AS (SELECT g, count(*) AS n, avg(y) AS my, var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) / sqrt(var_pop(a) * var_pop(b)) AS q,
                 covar_pop(a, y) / sqrt(var_pop(a)) AS ra, covar_pop(b, y) / sqrt(var_pop(b)) AS rb FROM r GROUP BY g)
"""


def _two(t):
    return t.lineitem.select(
        F.col("l_suppkey").alias("g"), F.col("l_quantity").alias("a"), (F.col("l_discount") * 100 + F.col("l_quantity") / 10).alias("b"),
        F.col("l_extendedprice").alias("y"),
    )


def _two_sql(penalty: str) -> str:
    """Normal equations of two correlated, scaled features, by Cramer's rule."""
    d = f"((1 + {penalty}) * (1 + {penalty}) - q * q)"
    return f"""
    WITH {_TWO} SELECT g, n AS rows, round(my, 3) AS intercept, round(((1 + {penalty}) * ra - q * rb) / {d}, 3) AS w_a,
           round(((1 + {penalty}) * rb - q * ra) / {d}, 3) AS w_b FROM c
    """


def _weights(fitted):
    return fitted.select("g", "rows", "intercept", F.col("coefficients")[0].alias("w_a"), F.col("coefficients")[1].alias("w_b"))


@query("linear_two_features", _two_sql("0"), digits=3)
def _(t):
    return _weights(m.fit_per_group(_two(t), "g", "y", ["a", "b"]))


@query("ridge_two_features", _two_sql("10.0 / n"), digits=3)
def _(t):
    return _weights(m.fit_per_group(_two(t), "g", "y", ["a", "b"], "RIDGE", 10.0))


@query("least_angle_two_features", _two_sql("0"), digits=3)
def _(t):
    return _weights(m.fit_per_group(_two(t), "g", "y", ["a", "b"], "LARS"))


@query(
    "elastic_net_conditions",
    "SELECT l_suppkey AS g, 1 AS holds FROM lineitem GROUP BY 1",
)
def _(t):
    return _penalty_conditions(t, "ELNET", 50.0, 0.5)


@query(
    "lasso_path_conditions",
    "SELECT l_suppkey AS g, 1 AS holds FROM lineitem GROUP BY 1",
)
def _(t):
    return _penalty_conditions(t, "LLARS", 900.0, 1.0)


def _penalty_conditions(t, model, alpha, share):
    """The fit of every group meets the conditions that single out the minimum: the gradient of the squares plus the ridge
    part equals minus the penalty's sign where a weight is not 0, and is no larger than the penalty where it is."""
    fitted = _weights(m.fit_per_group(_two(t), "g", "y", ["a", "b"], model, alpha, share))
    sums = _two(t).groupBy("g").agg(
        F.var_pop("a").alias("saa"), F.var_pop("b").alias("sbb"), F.covar_pop("a", "b").alias("sab"),
        F.covar_pop("a", "y").alias("say"), F.covar_pop("b", "y").alias("sby"),
    )
    q = F.col("sab") / F.sqrt(F.col("saa") * F.col("sbb"))
    holds = F.lit(True)
    for own, other, s, r in (("w_a", "w_b", "saa", "say"), ("w_b", "w_a", "sbb", "sby")):
        slope = F.col(r) / F.sqrt(s) - F.col(own) - q * F.col(other) - alpha * (1 - share) * F.col(own)
        inside = F.abs(slope) <= alpha * share + 1e-4
        holds = holds & F.when(F.abs(own) > 1e-9, F.abs(slope - F.signum(own) * alpha * share) < 1e-4).otherwise(inside)
    return fitted.join(sums, "g").select("g", holds.cast("int").alias("holds"))


@query(
    "bayesian_ridge_conditions",
    "SELECT l_suppkey AS g, 1 AS holds FROM lineitem GROUP BY 1",
    digits=3,
)
def _(t):
    """The weights are those of a ridge whose penalty is the ratio of the two precisions, and the precisions those that the
    weights make most likely: as many squares per free row, and per weight that the data determine, priors included."""
    fitted = _weights(m.fit_per_group(_two(t), "g", "y", ["a", "b"], "BRIDGE"))
    sums = _two(t).groupBy("g").agg(
        F.var_pop("a").alias("saa"), F.var_pop("b").alias("sbb"), F.covar_pop("a", "b").alias("sab"),
        F.covar_pop("a", "y").alias("say"), F.covar_pop("b", "y").alias("sby"), F.var_pop("y").alias("syy"),
    )
    q, n = F.col("sab") / F.sqrt(F.col("saa") * F.col("sbb")), F.col("rows")
    ra, rb, wa, wb = F.col("say") / F.sqrt("saa"), F.col("sby") / F.sqrt("sbb"), F.col("w_a"), F.col("w_b")
    ratio = n * (ra - wa - q * wb) / wa
    other = n * (rb - wb - q * wa) / wb
    known = n * (1 + q) / (n * (1 + q) + ratio) + n * (1 - q) / (n * (1 - q) + ratio)
    left = n * (F.col("syy") - 2 * (ra * wa + rb * wb) + wa * wa + wb * wb + 2 * q * wa * wb)
    prior, unit = 2e-6, F.col("syy")
    likely = (known + prior) / ((wa * wa + wb * wb) / unit + prior) / ((n - known + prior) / (left / unit + prior))
    close = lambda x, y: F.abs(x - y) <= 1e-4 * F.abs(y)
    return fitted.join(sums, "g").select("g", (close(ratio, likely) & close(other, likely)).cast("int").alias("holds"))
