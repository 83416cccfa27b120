"""Text and code expressions."""

from pyspark.sql import functions as F

from ..functions import model_json as mj, text as tx
from .base import INCIDENTS, query


@query(
    "split_code",
    f"""
    WITH {INCIDENTS}
    SELECT incident, dispatch_code,
           cast(cast(regexp_extract(dispatch_code, '^(\\d+)([A-Z]+)(.*)', 1) AS int) AS varchar) AS code_type,
           regexp_extract(dispatch_code, '^(\\d+)([A-Z]+)(.*)', 2) AS code_level,
           regexp_extract(dispatch_code, '^(\\d+)([A-Z]+)(.*)', 3) AS code_rest
    FROM incidents
    """,
)
def _(t):
    return t.incidents.select("incident", "dispatch_code", tx.split_code("dispatch_code").alias("c")).select(
        "incident", "dispatch_code", "c.*"
    )


@query(
    "split_code_without_number",
    """
    SELECT p_partkey, upper(p_type) AS code_type, NULL::varchar AS code_level, NULL::varchar AS code_rest FROM part
    """,
)
def _(t):
    return t.part.select("p_partkey", tx.split_code(F.upper("p_type")).alias("c")).select("p_partkey", "c.*")


@query(
    "strip_leading_zero",
    f"WITH {INCIDENTS} SELECT incident, regexp_replace(dispatch_code, '^0', '') AS code FROM incidents",
)
def _(t):
    return t.incidents.select("incident", tx.strip_leading_zero("dispatch_code").alias("code"))


@query(
    "like_any",
    f"""
    WITH {INCIDENTS} SELECT incident, cast(dispatch_code LIKE '06__' OR dispatch_code LIKE '%B1' AS int) AS hit FROM incidents
    """,
)
def _(t):
    return t.incidents.select("incident", tx.like_any("dispatch_code", ["06__", "%B1"]).alias("hit"))


@query(
    "geoid_and_trimmed_digits",
    """
    SELECT c_custkey, substr(c_name, 8) AS geoid, regexp_replace(c_name, '^\\d+|\\d+$', '', 'g') AS stripped,
           replace('1O' || c_custkey, 'O', '0') AS fixed, 'FCF' || lpad(cast(c_custkey AS varchar), 12, '0') AS key
    FROM customer
    """,
)
def _(t):
    return t.customer.select(
        "c_custkey",
        tx.geoid("c_name").alias("geoid"),
        tx.strip_digits("c_name").alias("stripped"),
        tx.fix_letter_o(F.concat(F.lit("1O"), F.col("c_custkey").cast("string"))).alias("fixed"),
        tx.format_key("c_custkey").alias("key"),
    )


@query(
    "is_nln",
    f"""
    WITH {INCIDENTS}
    SELECT cast(regexp_matches(c, '^\\d{{1,2}}[A-Z](\\d{{1,2}}|O)') AS int) AS is_nln, count(*) AS n
    FROM (SELECT dispatch_code AS c FROM incidents UNION ALL SELECT event_type FROM incidents) GROUP BY 1
    """,
)
def _(t):
    codes = t.incidents.select(F.col("dispatch_code").alias("c")).unionByName(t.incidents.select(F.col("event_type").alias("c")))
    return codes.groupBy(tx.is_nln("c").alias("is_nln")).agg(F.count("*").alias("n"))


@query(
    "code_number_and_severity",
    f"""
    WITH {INCIDENTS}
    SELECT incident, regexp_replace(dispatch_code, '[A-Z]+[0-9]+.*', '') AS code_number,
           substr(regexp_replace(dispatch_code, '[0-9]+', '', 'g'), 1, 1) AS severity, 'NONE' AS severity_of_text
    FROM incidents
    """,
)
def _(t):
    return t.incidents.select(
        "incident",
        tx.code_number("dispatch_code").alias("code_number"),
        tx.severity("dispatch_code").alias("severity"),
        tx.severity(F.upper("event_type")).alias("severity_of_text"),
    )


@query(
    "unit_to_m",
    f"""
    SELECT s_suppkey, CASE WHEN length(u) = 3 AND u[1] IN ('A', 'R') THEN 'M' || substr(u, 2) ELSE u END AS unit
    FROM (SELECT s_suppkey, substr('AMRX', cast(s_suppkey % 4 + 1 AS int), 1)
            || CASE WHEN s_suppkey % 120 < 10 THEN '0' ELSE '' END || cast(s_suppkey % 120 AS varchar) AS u FROM supplier)
    """,
)
def _(t):
    unit = F.concat(
        F.substr(F.lit("AMRX"), (F.col("s_suppkey") % 4 + 1).cast("int"), F.lit(1)),
        F.when(F.col("s_suppkey") % 120 < 10, "0").otherwise(""),
        (F.col("s_suppkey") % 120).cast("string"),
    )
    return t.supplier.select("s_suppkey", tx.unit_to_m(unit).alias("unit"))


def _label_sql(labels: dict) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in labels.items())
    return f"CASE code_type {cases} ELSE code_type END"


@query(
    "code_labels",
    f"""
    WITH {INCIDENTS}
    SELECT code_type, {_label_sql(tx.CODE_LABELS)} AS label, {_label_sql(tx.CODE_LABELS_LONG)} AS long_label, count(*) AS n
    FROM incidents GROUP BY code_type
    """,
)
def _(t):
    counts = t.incidents.groupBy("code_type").agg(F.count("*").alias("n"))
    return counts.select("code_type", tx.code_label("code_type").alias("label"), tx.code_label("code_type", long=True).alias("long_label"), "n")


@query(
    "code_synonym",
    """
    SELECT p_type, CASE p_type WHEN 'SMALL' THEN '25' WHEN 'LARGE' THEN '14' WHEN 'PROMO' THEN '29' ELSE p_type END AS code,
           count(*) AS n
    FROM part GROUP BY p_type
    """,
)
def _(t):
    words = F.create_map(*[F.lit(x) for x in ("SMALL", "SUICF", "LARGE", "DROWNF", "PROMO", "ACCIF")])
    counts = t.part.groupBy("p_type").agg(F.count("*").alias("n"))
    code = tx.code_synonym(F.coalesce(F.try_element_at(words, F.col("p_type")), F.col("p_type")))
    return counts.select("p_type", code.alias("code"), "n")


_HIGH = "('9','19','28','10','27','14','30','22')"
_MEDIUM = "('12','31','13','6','8','23','15','7','24','25')"
_LOW = "('11','2','21','3','18','16','1','20','17','26','4','29','32','5')"
URGENCY_SQL = (
    f"CASE WHEN code_type IN {_HIGH} THEN 'high' WHEN code_type IN {_MEDIUM} THEN 'medium' "
    f"WHEN code_type IN {_LOW} THEN 'low' ELSE 'other' END"
)


@query(
    "urgency_buckets",
    f"WITH {INCIDENTS} SELECT {URGENCY_SQL} AS urgency, count(*) AS n FROM incidents GROUP BY 1",
)
def _(t):
    return t.incidents.groupBy(tx.urgency("code_type").alias("urgency")).agg(F.count("*").alias("n"))


@query(
    "spec_hash",
    "SELECT p_partkey, md5(p_brand || ' ' || p_type || ' ' || cast(p_size AS varchar)) AS hash FROM part",
)
def _(t):
    return t.part.select("p_partkey", tx.spec_hash(["p_brand", "p_type", "p_size"], " ").alias("hash"))


@query(
    "shorten_names",
    """
    SELECT p_partkey, 'RF(' || p_name || ', LR)' AS model FROM part
    """,
)
def _(t):
    text = F.concat(F.lit("RandomForestClassifier(bootstrap=False, "), F.col("p_name"), F.lit(", class_weight=None, LogisticRegression)"))
    return t.part.select("p_partkey", F.replace(tx.shorten_names(text), F.lit(", , "), F.lit(", ")).alias("model"))


@query(
    "name_families",
    """
    SELECT CASE WHEN p_name LIKE '%red%' THEN 'red' WHEN p_name LIKE '%ring%' THEN 'ring' ELSE 'other' END AS family, count(*) AS n
    FROM part GROUP BY 1
    """,
)
def _(t):
    return t.part.groupBy(tx.family("p_name", ["red", "ring"]).alias("family")).agg(F.count("*").alias("n"))


@query(
    "key_date",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n
    FROM (SELECT o_orderdate + INTERVAL 10 YEAR AS o_orderdate FROM orders) GROUP BY 1
    """,
)
def _(t):
    # keys have years of two digits from 2000 on
    day = F.add_months("o_orderdate", 120)
    key = F.concat(F.lit("FCF"), F.date_format(day, "yyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0"))
    return t.orders.groupBy(tx.key_date(key).alias("day")).agg(F.count("*").alias("n"))


@query(
    "importances_sorted_by_size",
    """
    SELECT p_brand, string_agg(p_type, ',' ORDER BY abs(w) DESC, p_type) AS sorted_features,
           string_agg(CASE WHEN rk <= floor(n * 50 / 100) THEN p_type END, ',' ORDER BY abs(w) DESC, p_type) AS top_half
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY abs(w) DESC, p_type) AS rk,
                 count(*) OVER (PARTITION BY p_brand) AS n
          FROM (SELECT p_brand, p_type, cast(sum(CASE WHEN p_size % 2 = 0 THEN p_size ELSE -p_size END) AS bigint) AS w
                FROM part GROUP BY ALL))
    GROUP BY p_brand
    """,
)
def _(t):
    signed = F.when(F.col("p_size") % 2 == 0, F.col("p_size")).otherwise(-F.col("p_size"))
    weights = t.part.groupBy("p_brand", "p_type").agg(F.sum(signed).alias("w"))
    pairs = weights.groupBy("p_brand").agg(
        F.collect_list(F.struct(F.col("p_type").alias("feature"), F.col("w").cast("double").alias("importance"))).alias("p")
    )
    by_size = mj.sort_by_abs("p")
    names = lambda a: F.array_join(F.transform(a, lambda x: x["feature"]), ",")
    return pairs.select(
        "p_brand",
        names(by_size).alias("sorted_features"),
        F.nullif(names(mj.top_share(by_size, 50)), F.lit("")).alias("top_half"),
    )


@query(
    "importance_pairs_from_json",
    """
    SELECT p_partkey, p_type AS feature, round(p_retailprice, 6) AS importance, round(p_size / 100.0::double, 6) AS precision_at_cut
    FROM part
    """,
)
def _(t):
    entry = F.to_json(
        F.struct(
            F.array(F.array(F.lit("0.05"), F.to_json(F.array(F.col("p_size") / F.lit(100.0), F.lit(1.0))))).alias("MODEL METRICS"),
            F.array(F.array(F.col("p_type"), F.col("p_retailprice").cast("string"))).alias("MODEL FEATS & IMPS"),
        )
    )
    parsed = t.part.select("p_partkey", mj.parse_model_json(entry).alias("m")).select("p_partkey", "m.*")
    pairs = mj.feature_importances("model_feats_imps")
    return parsed.select(
        "p_partkey",
        pairs[0]["feature"].alias("feature"),
        pairs[0]["importance"].alias("importance"),
        mj.metric_at("model_metrics", 0, "p").alias("precision_at_cut"),
    )
