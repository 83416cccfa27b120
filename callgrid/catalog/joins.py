"""Joins."""

from pyspark.sql import functions as F

from ..operators import joins as j
from ..operators.aggregates import hourly_demand
from .base import INCIDENTS, query


@query(
    "lookup_left",
    """
    SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey + 7 = c_custkey
    """,
)
def _(t):
    # the last keys have no customer
    orders = t.orders.withColumn("o_custkey", F.col("o_custkey") + 7)
    return j.lookup_left(orders, t.customer, "o_custkey", "c_custkey").select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "star_enrich",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, s_name, p_brand, o_orderstatus
    FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey + 1
    LEFT JOIN part ON p_partkey = l_partkey + 9 LEFT JOIN orders ON o_orderkey = l_orderkey
    """,
)
def _(t):
    named = lambda df, key, to, *cols: df.select(F.col(key).alias(to), *cols)
    dims = [
        (named(t.supplier.withColumn("s_suppkey", F.col("s_suppkey") - 1), "s_suppkey", "l_suppkey", "s_name"), "l_suppkey"),
        (named(t.part.withColumn("p_partkey", F.col("p_partkey") - 9), "p_partkey", "l_partkey", "p_brand"), "l_partkey"),
        (named(t.orders, "o_orderkey", "l_orderkey", "o_orderstatus"), "l_orderkey"),
    ]
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return j.star_enrich(lines, dims).drop("l_suppkey")


@query(
    "event_comment_chain",
    """
    SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def _(t):
    joined = j.event_comments(
        t.orders, t.customer, t.nation, t.region, ("o_custkey", "c_custkey"), ("c_nationkey", "n_nationkey"), ("n_regionkey", "r_regionkey")
    )
    return joined.select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "event_patient_chain",
    """
    SELECT l_suppkey, max(r_name) AS r_name, max(n_name) AS n_name, count(*) AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1
    """,
)
def _(t):
    joined = j.event_patients(
        t.lineitem, t.supplier, t.nation, t.region, ("l_suppkey", "s_suppkey"), ("s_nationkey", "n_nationkey"), ("n_regionkey", "r_regionkey")
    )
    return joined.groupBy("l_suppkey").agg(F.max("r_name").alias("r_name"), F.max("n_name").alias("n_name"), F.count("*").alias("n"))


_DEMAND = """
    agg AS (SELECT date_trunc('hour', time_created) AS h, station_name, count(*) AS n, cast(sum(trns_to_hosp::int) AS bigint) AS trns
            FROM incidents GROUP BY ALL),
    spine AS (SELECT station_name, unnest(generate_series((SELECT min(h) FROM agg), (SELECT max(h) FROM agg), INTERVAL 1 HOUR)) AS h
              FROM (SELECT DISTINCT station_name FROM incidents))
"""


@query(
    "spine_zero_fill",
    f"""
    WITH {INCIDENTS}, {_DEMAND}
    SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS time_created, station_name, coalesce(n, 0) AS total_incidents,
           coalesce(trns, 0) AS trns_to_hosp
    FROM spine LEFT JOIN agg USING (station_name, h)
    """,
)
def _(t):
    counts = hourly_demand(t.incidents, "time_created", "station_name", ["trns_to_hosp"])
    hour = F.date_trunc("hour", "ts")
    ends = t.events.agg(F.min(hour).alias("a"), F.max(hour).alias("b"))
    stations = t.incidents.select("station_name").distinct()
    hours = j.spine(stations, ends.select("a").scalar(), ends.select("b").scalar())
    return j.zero_fill(hours, counts, ["time_created", "station_name"], ["total_incidents", "trns_to_hosp"])


@query(
    "left_join_prefixed",
    """
    SELECT o_orderkey, o_custkey, c_custkey AS customer__c_custkey, c_name AS customer__c_name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderdate BETWEEN '1996-01-01' AND '1999-12-31'
    """,
)
def _(t):
    right = t.customer.select("c_custkey", "c_name")
    left = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    cond = ("o_orderdate", ("1996-01-01", "1999-12-31"))
    return j.left_join_prefixed(left, right, "o_custkey", "c_custkey", "customer", cond).drop("o_orderdate")


@query(
    "join_chain",
    """
    SELECT o_orderkey, c_nationkey AS customer__c_nationkey, n_name AS nation__n_name, r_name AS region__r_name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def _(t):
    tables = {n: getattr(t, n) for n in ("orders", "customer", "nation", "region")}
    edges = [
        (("orders", "customer"), ("o_custkey", "c_custkey")),
        (("customer", "nation"), ("c_nationkey", "n_nationkey")),
        (("nation", "region"), ("n_regionkey", "r_regionkey")),
    ]
    return j.join_chain(tables, edges).select("o_orderkey", "customer__c_nationkey", "nation__n_name", "region__r_name")


@query(
    "join_two_systems",
    """
    SELECT o_orderkey, c_name AS customer__c_name, l_linenumber AS lineitem__l_linenumber, l_partkey AS lineitem__l_partkey,
           s_name AS lineitem__supplier__s_name, p_brand AS dictionary__p_brand
    FROM (SELECT * FROM orders WHERE o_orderdate BETWEEN '1997-01-01' AND '1997-12-31')
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN part ON p_partkey = l_partkey
    """,
)
def _(t):
    joined = j.join_two_systems(
        {"orders": t.orders, "customer": t.customer},
        [(("orders", "customer"), ("o_custkey", "c_custkey"))],
        {"lineitem": t.lineitem, "supplier": t.supplier},
        [(("lineitem", "supplier"), ("l_suppkey", "s_suppkey"))],
        ("o_orderkey", "l_orderkey"),
        "1997-01-01",
        "1997-12-31",
        "o_orderdate",
        dictionary=(t.part, "dictionary", "lineitem__l_partkey", "p_partkey"),
    )
    return joined.select(
        "o_orderkey", "customer__c_name", "lineitem__l_linenumber", "lineitem__l_partkey", "lineitem__supplier__s_name", "dictionary__p_brand"
    )


@query(
    "lookup_by_year",
    """
    WITH ref AS (SELECT year(o_orderdate) AS y, c_nationkey AS nation, round(avg(o_totalprice), 4) AS mean_price
                 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT o_orderkey, mean_price FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN ref ON nation = c_nationkey AND y = greatest(year(o_orderdate) - 2, 1997)
    """,
    digits=4,
)
def _(t):
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.year("o_orderdate").alias("time_year"), F.col("c_nationkey").alias("geoid"), "o_totalprice"
    )
    ref = facts.groupBy(F.col("time_year").alias("year"), "geoid").agg(F.avg("o_totalprice").alias("mean_price"))
    return j.lookup_by_year(facts, ref, "time_year", "geoid", "year", 2, 1997).select("o_orderkey", "mean_price")


@query(
    "join_daily",
    """
    WITH d AS (SELECT cast(o_orderdate AS date) AS day, count(*) AS orders_that_day FROM orders GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, orders_that_day FROM lineitem LEFT JOIN d ON day = cast(l_shipdate AS date)
    """,
)
def _(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("orders_that_day"))
    return j.join_daily(t.lineitem, daily, "l_shipdate").select("l_orderkey", "l_linenumber", "l_partkey", "orders_that_day")


@query(
    "near_date_flag",
    """
    WITH big AS (SELECT DISTINCT cast(o_orderdate AS date) AS d FROM orders WHERE o_totalprice > 499000)
    SELECT o_orderkey, cast(EXISTS (SELECT 1 FROM big WHERE d BETWEEN cast(o_orderdate AS date) - 1 AND cast(o_orderdate AS date) + 1) AS int) AS near
    FROM orders
    """,
)
def _(t):
    big = t.orders.where("o_totalprice > 499000").select("o_orderdate")
    return j.near_date_flag(t.orders, big, "o_orderdate", "o_orderdate").select("o_orderkey", "near")


@query(
    "late_events",
    """
    SELECT l_orderkey, count(*) AS n_late
    FROM (SELECT l_orderkey, l_shipdate, min(l_shipdate) OVER (PARTITION BY l_orderkey) AS first FROM lineitem)
    WHERE l_shipdate > first + INTERVAL 30 DAY GROUP BY 1
    """,
)
def _(t):
    return j.late_events(t.lineitem, "l_orderkey", "l_shipdate", 30 * 86400)


@query(
    "lag_by_key",
    f"""
    WITH {INCIDENTS}, d AS (SELECT cast(time_created AS date) AS day, operator_name, count(*) AS n FROM incidents GROUP BY ALL)
    SELECT strftime(a.day, '%Y-%m-%d') AS day, a.operator_name, a.n, coalesce(b.n, 0) AS n_lag1, coalesce(c.n, 0) AS n_lag7
    FROM d a LEFT JOIN d b ON b.operator_name = a.operator_name AND b.day = a.day - 1
    LEFT JOIN d c ON c.operator_name = a.operator_name AND c.day = a.day - 7
    """,
)
def _(t):
    daily = t.incidents.groupBy(F.to_date("time_created").alias("day"), "operator_name").agg(F.count("*").alias("n"))
    return j.lag_by_key(daily, "day", "n", [1, 7], "operator_name")


@query(
    "merge_on_key",
    "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)",
)
def _(t):
    return j.merge(t.documents, t.labels, "doc_id").select("doc_id", "lang", "quality")


@query(
    "align_scores",
    """
    SELECT doc_id, round(max(length), 6) AS length, round(max(quality), 6) AS quality
    FROM (SELECT doc_id, n_chars / 100.0::double AS length, NULL::double AS quality FROM documents
          UNION ALL SELECT doc_id, NULL, quality::double FROM labels) GROUP BY 1
    """,
)
def _(t):
    length = t.documents.select("doc_id", (F.col("n_chars") / 100.0).alias("score"))
    quality = t.labels.select("doc_id", F.col("quality").cast("double").alias("score"))
    return j.align_scores({"length": length, "quality": quality}, "doc_id")


@query(
    "attach_scores",
    """
    SELECT doc_id, a.quality AS quality_left, b.n_chars AS quality, b.lang
    FROM labels a LEFT JOIN documents b USING (doc_id)
    """,
)
def _(t):
    feats = t.documents.select("doc_id", F.col("n_chars").alias("quality"), "lang")
    return j.attach_scores(t.labels.select("doc_id", "quality"), feats, "doc_id")


@query(
    "transfer_by_key",
    f"""
    WITH {INCIDENTS},
    a AS (SELECT dispatch_code, avg(trns_to_hosp::int) > 0.2 AS suggested FROM incidents WHERE day(time_created) <= 20 GROUP BY 1),
    b AS (SELECT dispatch_code, count(*) AS n FROM incidents WHERE day(time_created) > 20 GROUP BY 1)
    SELECT dispatch_code, n, cast(suggested AS int) AS suggested FROM a JOIN b USING (dispatch_code)
    """,
)
def _(t):
    early, late = t.incidents.where("day(time_created) <= 20"), t.incidents.where("day(time_created) > 20")
    train = early.groupBy("dispatch_code").agg((F.avg(F.col("trns_to_hosp").cast("int")) > 0.2).alias("suggested"))
    return j.transfer_by_key(train, late.groupBy("dispatch_code").agg(F.count("*").alias("n")), "dispatch_code", "suggested")


@query(
    "join_on_expression",
    """
    SELECT c_custkey, s_suppkey FROM customer LEFT JOIN supplier ON substr(c_name, 10) = substr(s_name, 10)
    """,
)
def _(t):
    left, right = F.substring("c_name", 10, 100), F.substring("s_name", 10, 100)
    return j.join_on_expr(t.customer, t.supplier, left, right).select("c_custkey", "s_suppkey")


@query(
    "align_overlap",
    """
    WITH a AS (SELECT cast(o_orderdate AS date) AS day, count(*) AS n FROM orders GROUP BY 1),
    b AS (SELECT cast(l_shipdate AS date) AS day, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT strftime(day, '%Y-%m-%d') AS day, a.n AS n_1, b.n AS n_2 FROM a JOIN b USING (day)
    WHERE day > greatest((SELECT min(day) FROM a), (SELECT min(day) FROM b))
      AND day < least((SELECT max(day) FROM a), (SELECT max(day) FROM b))
    """,
)
def _(t):
    a = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    b = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n"))
    return j.align_overlap(a, b, "day", "n")
