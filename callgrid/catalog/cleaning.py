"""Cleaning and checks."""

from pyspark.sql import functions as F

from ..operators import cleaning as c
from .base import query


@query(
    "clean_table",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
    FROM orders
    """,
)
def _(t):
    raw = t.orders.select(
        F.col("o_orderkey").alias("O_ORDERKEY"),
        F.col("o_custkey").alias("O_Custkey"),
        "o_orderstatus",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("O_ORDERDATE"),
        "o_orderpriority",
        F.lit("same").alias("CONSTANT"),
        F.lit(None).cast("string").alias("Empty"),
    )
    return c.clean_table(raw, ["O_ORDERDATE"])[0]


@query(
    "drop_columns_with_at_most_two_values",
    "SELECT doc_id, quality, toxic FROM labels WHERE false UNION ALL SELECT doc_id, quality, toxic FROM labels",
)
def _(t):
    flagged = t.labels.select("*", (F.col("quality") + F.col("toxic") > 0).alias("any_flag"), F.lit(1).alias("one"))
    return c.drop_empty_columns(flagged, 2, keep=["quality", "toxic"])[0]


@query(
    "prettify_date_time_of_day",
    """
    SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + cast(floor(second(ts)) AS bigint) AS at,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts
    FROM events
    """,
)
def _(t):
    raw = t.events.select(
        "event_id",
        F.date_format("ts", "HHmmss").cast("int").alias("at"),
        F.date_format("ts", "yyyyMMddHHmmss").cast("double").cast("string").alias("ts"),
    )
    return c.prettify_date(c.prettify_date(raw, "at", "time"), "ts")


@query("cast_column", "SELECT event_id, cast(floor(value) AS bigint) AS value FROM events")
def _(t):
    return c.cast_column(t.events.select("event_id", F.floor("value").cast("string").alias("value")), "value", "bigint", strict=False)


@query(
    "fix_indices",
    "SELECT o_orderkey, 'FCF' || lpad(cast(o_orderkey AS varchar), 12, '0') AS key FROM orders",
)
def _(t):
    typed = F.concat(F.lit(" "), F.replace(F.col("o_orderkey").cast("string"), F.lit("0"), F.lit("O")), F.lit(" "))
    return c.fix_indices(t.orders.select("o_orderkey", typed.alias("key")), "key")


@query(
    "delete_duplicates",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 6) AS l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1
    """,
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return c.delete_duplicates(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


@query(
    "column_checks",
    """
    SELECT (SELECT cast(bool_and(value > 0) AS int) FROM events) AS value_ok,
           (SELECT cast(count(props) > 0 AS int) FROM events) AS not_null_ok,
           (SELECT cast(count(*) >= 100 AS int) FROM events) AS rows_ok,
           (SELECT cast(bool_and(quality IN (0, 1)) AND min(quality) = 0 AND max(quality) = 1 AS int) FROM labels) AS binary_ok,
           (SELECT cast(bool_and(label IN (0, 1)) AS int) FROM embeddings) AS not_binary
    """,
)
def _(t):
    named = lambda df, name: df.select(F.col("ok").alias(name))
    checks = {
        "value_ok": c.check_column_value(t.events, F.col("value") > 0),
        "not_null_ok": c.check_column_is_not_null(t.events, "props"),
        "rows_ok": c.check_table_has_nrows(t.events, 100),
        "binary_ok": c.check_binary_domain(t.labels, "quality"),
    }
    first = named(c.check_binary_domain(t.embeddings, "label"), "not_binary")
    return first.select("*", *[named(df, name).scalar().alias(name) for name, df in checks.items()])


@query(
    "unique_key_check",
    """
    SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct,
           cast(count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS int) AS ok
    FROM lineitem
    """,
)
def _(t):
    return c.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "misaligned_rows",
    """
    SELECT doc_id, cast(sum(l) AS bigint) AS n_left, cast(sum(r) AS bigint) AS n_right
    FROM (SELECT doc_id, 1 AS l, 0 AS r FROM documents UNION ALL SELECT doc_id, 0, 1 FROM labels)
    GROUP BY doc_id HAVING sum(l) <> sum(r)
    """,
)
def _(t):
    return c.misaligned_rows(t.documents, t.labels, "doc_id")


@query(
    "drop_null_rows_and_columns",
    """
    SELECT o_orderkey, o_orderstatus AS known_status FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def _(t):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    holes = t.orders.select("o_orderkey", known.alias("known_status"), F.lit(None).cast("int").alias("nothing"))
    return c.drop_null_rows(c.drop_null_columns(holes), ["known_status"])


@query(
    "drop_exact_duplicates",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, cast(l_quantity AS bigint) AS q FROM lineitem",
)
def _(t):
    return c.drop_exact_duplicates(
        t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q"))
    )
