"""Sorts, top-k and set operations."""

from pyspark.sql import functions as F

from ..operators import ranking as r, sets as st
from .base import query

_COUNTS = "c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)"


def _counts(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"))


@query("order_by_count", f"WITH {_COUNTS} SELECT user_id, n FROM c ORDER BY n DESC, user_id")
def _(t):
    return r.order_desc(_counts(t), "n", "user_id")


@query("top_ten", f"WITH {_COUNTS} SELECT user_id, n FROM c ORDER BY n DESC, user_id LIMIT 10")
def _(t):
    return r.top_n(_counts(t), "n", 10, "user_id")


@query(
    "top_with_other",
    f"""
    WITH {_COUNTS}, s AS (SELECT user_id, n / sum(n) OVER () AS share FROM c), top AS (SELECT * FROM s ORDER BY share DESC, cast(user_id AS varchar) LIMIT 5)
    SELECT cast(user_id AS varchar) AS user_id, round(share, 6) AS share FROM top
    UNION ALL SELECT 'other', round(1 - sum(share), 6) FROM top
    """,
)
def _(t):
    from ..operators.aggregates import pct_distribution

    return r.top_n_with_other(pct_distribution(t.events, "user_id"), "user_id", "share", 5)


@query("first_rows_in_order", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 100")
def _(t):
    return r.order_limit(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"], 100)


@query(
    "best_per_group",
    """
    SELECT o_custkey, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1
    """,
)
def _(t):
    return r.best_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_totalprice", "o_orderkey")


@query(
    "kth_largest",
    """
    SELECT round(value, 6) AS threshold FROM (SELECT value, row_number() OVER (ORDER BY value DESC) - 1 AS i, count(*) OVER () AS n FROM events)
    WHERE i = floor(0.3 * n)
    """,
)
def _(t):
    return r.kth_largest(t.events, "value", 0.3)


@query(
    "kth_largest_in_buckets",
    """
    SELECT round(value, 6) AS threshold FROM (SELECT value, row_number() OVER (ORDER BY value DESC) - 1 AS i, count(*) OVER () AS n FROM events)
    WHERE i = floor(0.05 * n)
    """,
)
def _(t):
    return r.kth_largest(t.events, "value", 0.05, n=8)


@query(
    "random_pick",
    "SELECT event_id, user_id FROM events ORDER BY md5(concat_ws('|', '7', event_id::varchar, user_id::varchar)) LIMIT 10",
)
def _(t):
    return r.random_pick(t.events.select("event_id", "user_id"), 10, 7)


@query(
    "union_of_tables",
    """
    SELECT c_custkey AS id, 'customer' AS kind, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, 'supplier', s_nationkey FROM supplier
    """,
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))
    return st.union_all(a, b)


@query(
    "union_of_dates",
    "SELECT strftime(d, '%Y-%m-%d') AS day FROM (SELECT cast(o_orderdate AS date) AS d FROM orders UNION SELECT cast(l_shipdate AS date) FROM lineitem)",
)
def _(t):
    return st.union_distinct(t.orders.select(F.to_date("o_orderdate").alias("day")), t.lineitem.select(F.to_date("l_shipdate").alias("day")))


@query(
    "common_and_missing_keys",
    """
    SELECT 'common' AS kind, count(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
    UNION ALL SELECT 'missing', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
    """,
)
def _(t):
    common = st.common_keys(t.documents, t.labels, "doc_id").agg(F.count("*").alias("n"))
    missing = st.complement(t.documents, t.labels, "doc_id").agg(F.count("*").alias("n"))
    return common.select(F.lit("common").alias("kind"), "n").unionByName(missing.select(F.lit("missing").alias("kind"), "n"))
