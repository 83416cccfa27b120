"""Projections, predicates and flags."""

from pyspark.sql import functions as F

from ..operators import filters as f
from .base import INCIDENTS, query


@query(
    "flag_by_code_text",
    """
    SELECT o_orderkey, cast(
             (code LIKE '%T' AND text NOT LIKE '%NO%' AND code NOT IN ('TEST', 'AST', 'CIT', 'EXT', 'NOT'))
             OR (text LIKE '%TRANSPORT%' AND text NOT LIKE '%NO%') OR code LIKE 'TRAN%' OR code = 'NCT' AS int) AS transported
    FROM (SELECT o_orderkey,
            ['AST', 'NCT', 'TRANX', 'MT', 'F', 'TEST', 'HT'][o_orderkey % 7 + 1] AS code,
            CASE WHEN o_orderstatus = 'O' THEN 'NO ' ELSE '' END || CASE WHEN o_custkey % 3 = 0 THEN 'TRANSPORT' ELSE 'DONE' END AS text
          FROM orders)
    """,
)
def _(t):
    codes = F.array(*[F.lit(c) for c in ("AST", "NCT", "TRANX", "MT", "F", "TEST", "HT")])
    text = F.concat(
        F.when(F.col("o_orderstatus") == "O", "NO ").otherwise(""),
        F.when(F.col("o_custkey") % 3 == 0, "TRANSPORT").otherwise("DONE"),
    )
    rows = t.orders.select("o_orderkey", F.get(codes, F.col("o_orderkey") % 7).alias("code"), text.alias("text"))
    return f.flag_by_code_text(rows, "code", "text").select("o_orderkey", "transported")


@query(
    "flags_default_false",
    """
    SELECT doc_id, cast(coalesce(quality = 1, false) AS int) AS good FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def _(t):
    good = t.labels.select("doc_id", (F.col("quality") == 1).alias("good"))
    return f.default_false(t.documents.select("doc_id").join(good, "doc_id", "left"), "good")


@query(
    "units_by_wildcard",
    """
    SELECT u AS unit, count(*) AS n
    FROM (SELECT substr('AMRX', cast(l_suppkey % 4 + 1 AS int), 1) || cast(l_suppkey AS varchar) AS u FROM lineitem)
    WHERE u LIKE 'M__' OR u LIKE 'A__' OR u LIKE 'R__' GROUP BY u
    """,
)
def _(t):
    unit = F.concat(F.substr(F.lit("AMRX"), (F.col("l_suppkey") % 4 + 1).cast("int"), F.lit(1)), F.col("l_suppkey").cast("string"))
    return f.filter_like_any(t.lineitem.select(unit.alias("unit")), "unit").groupBy("unit").agg(F.count("*").alias("n"))


@query(
    "exclude_codes",
    f"WITH {INCIDENTS} SELECT code_type, count(*) AS n FROM incidents WHERE code_type NOT IN ('0', '33', '34') GROUP BY 1",
)
def _(t):
    return f.exclude_codes(t.incidents, "code_type", ["0", "33", "34"]).groupBy("code_type").agg(F.count("*").alias("n"))


@query(
    "time_filters",
    """
    SELECT 'since' AS kind, count(*) AS n FROM orders WHERE o_orderdate >= '1999-01-01'
    UNION ALL SELECT 'between', count(*) FROM orders WHERE o_orderdate BETWEEN '1997-01-01' AND '1998-06-30'
    UNION ALL SELECT 'in_year', count(*) FROM orders WHERE year(o_orderdate) = 1998
    """,
)
def _(t):
    o, d = t.orders.select("o_orderdate"), "o_orderdate"
    parts = {
        "since": f.since(o, d, "1999-01-01"),
        "between": f.between_ts(o, d, "1997-01-01", "1998-06-30"),
        "in_year": f.in_year(o, d, 1998),
    }
    out = None
    for kind, df in parts.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "categorize_text",
    """
    SELECT doc_id, CASE WHEN text LIKE '%tion%' THEN 'CP' WHEN text LIKE '%eau%' THEN 'CF' ELSE 'NA' END AS category,
           cast(text LIKE '%@%' AS int) AS flag, cast(text LIKE '%ther%' OR text LIKE '%sher%' AS int) AS refused
    FROM documents
    """,
)
def _(t):
    docs = f.categorize_text(t.documents, "text", [("tion", "CP"), ("eau", "CF")])
    docs = f.refused(f.flag_contains(docs, "text", "@"), "text", needles=("ther", "sher"))
    return docs.select("doc_id", "category", "flag", "refused")


@query(
    "split_by_year",
    """
    SELECT CASE WHEN year(o_orderdate) IN (1997, 1998) THEN 'train' ELSE 'test' END AS split, count(*) AS n,
           round(sum(o_totalprice), 2) AS price
    FROM orders WHERE year(o_orderdate) IN (1997, 1998, 1999) GROUP BY 1
    """,
    digits=2,
)
def _(t):
    train, test = f.split_by_year(t.orders, F.year("o_orderdate"), 1997, 2, 1999, 1)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("price"))


@query(
    "split_last_days",
    """
    SELECT CASE WHEN d >= last - 6 THEN 'test' ELSE 'train' END AS split, count(*) AS n
    FROM (SELECT cast(ts AS date) AS d, (SELECT max(cast(ts AS date)) FROM events) AS last FROM events) GROUP BY 1
    """,
)
def _(t):
    train, test = f.split_last_days(t.events, "ts", 2013, 7)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count("*").alias("n"))


@query(
    "subset_bucket",
    f"WITH {INCIDENTS} SELECT incident, code_type FROM incidents WHERE code_type IN ('9', '19', '28', '10', '27', '14')",
)
def _(t):
    return f.subset_bucket(t.incidents, "code_type", ["9", "19", "28", "10", "27", "14"]).select("incident", "code_type")


@query(
    "select_family",
    "SELECT l_orderkey, round(l_extendedprice, 6) AS l_extendedprice, l_linestatus, l_linenumber FROM lineitem",
)
def _(t):
    return f.select_family(t.lineitem, ["l_line", "l_ext"], always=["l_orderkey"])


@query(
    "trim_iqr",
    """
    WITH d AS (SELECT l_orderkey AS event, l_partkey, l_extendedprice / l_quantity AS value FROM lineitem),
    q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM d)
    SELECT event, l_partkey, round(value, 8) AS value FROM d, q WHERE value >= 0 AND value <= b + (b - a)
    """,
    digits=8,
)
def _(t):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("event"), "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("value")
    )
    return f.trim_iqr(lines, "value")


@query(
    "keep_above_share_of_max",
    """
    WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
    SELECT user_id, n FROM c WHERE n > 0.8 * (SELECT max(n) FROM c)
    """,
)
def _(t):
    return f.keep_above_share_of_max(t.events.groupBy("user_id").agg(F.count("*").alias("n")), "n", 0.8)


@query(
    "keep_in_and_flag_absent",
    """
    SELECT o_orderkey, cast(o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) AS int) AS absent
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
    """,
)
def _(t):
    kept = t.customer.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    rich = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return f.flag_not_in(f.keep_in(t.orders, kept, "o_custkey"), rich, "o_custkey").select("o_orderkey", "absent")


@query(
    "rename_drop_prune",
    "SELECT event_id AS id, event_type AS kind, round(value, 6) AS value FROM events",
)
def _(t):
    renamed = f.rename_drop(t.events, {"event_id": "id", "event_type": "kind"}, ["props"])
    return f.prune(renamed, "id", ["kind"], ["value"])


@query(
    "skip_until_hour",
    """
    SELECT event_id FROM events WHERE ts >= (SELECT min(ts) FROM events WHERE hour(ts) >= 7) AND ts >= '2024-01-01 12:00:00'
    """,
)
def _(t):
    return f.skip_until(f.skip_until(t.events, "ts", hour=7), "ts", start="2024-01-01 12:00:00").select("event_id")


@query(
    "changed_rows",
    "SELECT doc_id, quality, toxic FROM labels WHERE quality <> toxic",
)
def _(t):
    return f.changed_rows(t.labels, "quality", "toxic")
