"""Registration, input views and a uniform result form.

Results carry only whole numbers, doubles (rounded) and text, so that two engines can be compared: times and dates
are written as text and flags as 0 and 1.
"""

from __future__ import annotations

import functools
import textwrap

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.BooleanType, T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("int").cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


class Tables:
    """The shared tables and views of them that look like dispatch data."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def incidents(self) -> DataFrame:
        """Events as incidents with a station, an operator, a code and flags."""
        k = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
        number = (k % 35).cast("string")
        level = F.substring(F.lit("ABCDE"), 1, 5)
        code = F.concat(
            F.lpad(number, 2, "0"),
            F.substr(level, (k % 5 + 1).cast("int"), F.lit(1)),
            (F.col("user_id") % 3).cast("string"),
        )
        return self.events.select(
            F.col("event_id").alias("incident"),
            F.col("ts").alias("time_created"),
            F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("station_name"),
            F.col("user_id").alias("operator_name"),
            "event_type",
            "value",
            k.alias("k"),
            code.alias("dispatch_code"),
            number.alias("code_type"),
            (F.col("event_type") == "purchase").alias("trns_to_hosp"),
            F.col("event_type").isin("purchase", "click").alias("m_required"),
            F.col("event_type").isin("purchase", "signup").alias("m_sent"),
        )

    @property
    def dispatches(self) -> DataFrame:
        """Order lines as units sent to an event for some hours."""
        late = F.expr("make_dt_interval(0, cast(l_partkey % 24 as int), cast(l_orderkey % 60 as int), l_linenumber)")
        stay = F.expr("make_dt_interval(0, cast(l_quantity as int), 0, 0)")
        return self.lineitem.select(
            F.col("l_orderkey").alias("event"),
            F.col("l_suppkey").alias("unit"),
            F.col("l_linenumber").alias("line"),
            "l_partkey",
            "l_quantity",
            "l_returnflag",
            (F.col("l_shipdate") + late).alias("sent"),
            (F.col("l_shipdate") + late + stay).alias("clear"),
        )

    @property
    def points(self) -> DataFrame:
        """Order lines at places computed from their keys."""
        return self.lineitem.select(
            "l_orderkey",
            "l_linenumber",
            "l_quantity",
            (((F.col("l_orderkey") * 7919 + F.col("l_partkey")) % 10007) / F.lit(1000.0)).alias("x"),
            (((F.col("l_partkey") * 104729 + F.col("l_suppkey")) % 10009) / F.lit(1000.0)).alias("y"),
        )

    @property
    def areas(self) -> DataFrame:
        """Nations as the 2 x 2 squares of a 5 x 5 board."""
        x, y = (F.col("n_nationkey") % 5) * 2, F.floor(F.col("n_nationkey") / 5) * 2
        return self.nation.select(F.col("n_nationkey").alias("area"), _ring([(x, y), (x + 2, y), (x + 2, y + 2), (x, y + 2)]))

    @property
    def diamonds(self) -> DataFrame:
        """Regions as diamonds side by side."""
        x, r = F.col("r_regionkey") * 2 + 1, F.lit(1.50005)
        corners = [(x, 5 - r), (x + r, F.lit(5.0)), (x, 5 + r), (x - r, F.lit(5.0))]
        return self.region.select(F.col("r_regionkey").alias("region"), _ring(corners))

    @property
    def strips(self) -> DataFrame:
        """Regions as upright strips that do not follow the board."""
        x = F.col("r_regionkey") * 2 + 0.5
        corners = [(x, F.lit(0.5)), (x + 2, F.lit(0.5)), (x + 2, F.lit(6.5)), (x, F.lit(6.5))]
        return self.region.select(F.col("r_regionkey").alias("strip"), _ring(corners))

    @property
    def scored(self) -> DataFrame:
        """Labelled documents with a score from their length."""
        return self.labels.join(self.documents.select("doc_id", "n_chars", "lang", "source"), "doc_id").select(
            "doc_id", "quality", "toxic", "lang", "source", (F.col("n_chars") % 97 / F.lit(97.0)).alias("score")
        )


def _ring(corners):
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners]).alias("ring")


# The same views as SQL, to be put behind WITH.
INCIDENTS = r"""
incidents AS (
  SELECT event_id AS incident, ts AS time_created, 'S' || cast(user_id % 10 AS varchar) AS station_name,
         user_id AS operator_name, event_type, value, k,
         lpad(cast(k % 35 AS varchar), 2, '0') || substr('ABCDE', cast(k % 5 + 1 AS int), 1) || cast(user_id % 3 AS varchar) AS dispatch_code,
         cast(k % 35 AS varchar) AS code_type,
         event_type = 'purchase' AS trns_to_hosp,
         event_type IN ('purchase', 'click') AS m_required,
         event_type IN ('purchase', 'signup') AS m_sent
  FROM (SELECT *, cast(regexp_extract(props, '(\d+)', 1) AS bigint) AS k FROM events)
)"""
DISPATCHES = """
dispatches AS (
  SELECT l_orderkey AS event, l_suppkey AS unit, l_linenumber AS line, l_partkey, l_quantity, l_returnflag,
         l_shipdate + to_hours(l_partkey % 24) + to_minutes(l_orderkey % 60) + to_seconds(l_linenumber) AS sent,
         l_shipdate + to_hours(l_partkey % 24) + to_minutes(l_orderkey % 60) + to_seconds(l_linenumber)
           + to_hours(cast(l_quantity AS bigint)) AS clear
  FROM lineitem
)"""
POINTS = """
points AS (
  SELECT l_orderkey, l_linenumber, l_quantity, ((l_orderkey * 7919 + l_partkey) % 10007) / 1000.0::double AS x,
         ((l_partkey * 104729 + l_suppkey) % 10009) / 1000.0::double AS y
  FROM lineitem
)"""
SCORED = """
scored AS (
  SELECT doc_id, quality, toxic, lang, source, (n_chars % 97) / 97.0::double AS score
  FROM labels JOIN documents USING (doc_id)
)"""


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register `f(tables) -> DataFrame` and, if given, the SQL that states the same result."""

    def register(f):
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(f(Tables(spark, sf_dir)), digits)

        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return f

    return register
