"""Sources, sinks and the model registry. Files go to the session's checkpoint folder."""

from pyspark.sql import functions as F

from ..functions.text import spec_hash
from ..sources import readers as rd, writers as wr
from ..sources.scratch import scratch_path
from .base import query


@query(
    "csv_round_trip",
    """
    SELECT o_orderkey AS order_key, o_orderstatus AS order_status, round(o_totalprice, 6) AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    """,
)
def _(t):
    path = scratch_path(t.spark, "orders-csv")
    named = t.orders.select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_orderstatus").alias("Order STATUS"), F.col("o_totalprice").alias("price"), F.to_date("o_orderdate").alias("day")
    )
    wr.export_csv(named, path)
    return rd.read_csv(t.spark, path, "`Order Key` bigint, `Order STATUS` string, price double, day date", sep="|")


@query(
    "csv_without_footer",
    "SELECT c_nationkey % 4 AS part, count(*) AS n, cast(sum(c_custkey) AS bigint) AS keys FROM customer GROUP BY 1",
)
def _(t):
    """Four files, each with a header line and a footer that counts its rows."""
    path = scratch_path(t.spark, "customer-csv")
    part = (F.col("c_nationkey") % 4).alias("part")
    rows = t.customer.select(part, F.col("c_custkey").alias("seq"), F.concat_ws(",", "c_custkey", "c_nationkey").alias("line"))
    count = F.format_string("(%d rows affected),", F.count("*"))
    edges = rows.groupBy("part").agg(F.array(F.struct(F.lit(-1), F.lit("Cust Key,Nation")), F.struct(F.lit(1 << 40), count)).alias("e"))
    edges = edges.select("part", F.inline("e").alias("seq", "line"))
    lines = rows.union(edges).repartition("part").sortWithinPartitions("part", "seq")
    lines.select("part", "line").write.partitionBy("part").text(path)
    read = rd.read_csv_trimmed(t.spark, path, "c_custkey bigint, nation int", header=1, footer=1)
    return read.groupBy((F.col("nation") % 4).alias("part")).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query(
    "csv_late_type",
    """
    SELECT CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'x' ELSE '' END || o_orderkey AS code, o_orderstatus AS status FROM orders
    """,
)
def _(t):
    """One value of a column is no number: it is not lost, and the column is text."""
    path = scratch_path(t.spark, "late-csv")
    last = t.orders.agg(F.max("o_orderkey").alias("k")).scalar()
    code = F.concat(F.when(F.col("o_orderkey") == last, "x").otherwise(""), F.col("o_orderkey").cast("string"))
    wr.export_csv(t.orders.select(code.alias("Code"), F.col("o_orderstatus").alias("Status")), path, ",")
    return rd.read_csv(t.spark, path)


@query("tables_of_a_folder", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    read = rd.read_tables(t.spark, t.folder, ["nation.parquet", "region.parquet"])
    joined = read["nation.parquet"].join(read["region.parquet"], F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_name", "r_name")


@query("dictionary_sheet", "SELECT cast(p_partkey AS varchar) AS part_key, p_type, cast(p_size AS varchar) AS p_size FROM part")
def _(t):
    path = scratch_path(t.spark, "sheet")
    wr.export_csv(t.part.select(F.col("p_partkey").alias("Part Key"), "p_type", "p_size"), path, ",")
    return rd.read_dictionary(t.spark, path)


@query(
    "moon_files",
    "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN value > 100 THEN 'Full Moon' ELSE 'New Moon' END AS phase FROM events",
)
def _(t):
    """Files that overlap: both hold every day."""
    path = scratch_path(t.spark, "moon")
    phase = F.when(F.col("value") > 100, "Full Moon").otherwise("New Moon").alias("phase")
    days = t.events.select(F.to_date("ts").alias("date"), phase).distinct()
    wr.export_csv(days, path, ",")
    wr.export_csv(days, path, ",", if_exists="append")
    return rd.read_moon(t.spark, path).select(F.col("date").cast("string"), "phase")


@query("view_of_a_table", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def _(t):
    view = wr.create_view(t.nation, "nations_view")
    return rd.read_table(t.spark, "nations_view").union(view.limit(0)).groupBy("n_regionkey").agg(F.count("*").alias("n"))


@query("catalog_tables", "SELECT s_suppkey, s_name, (s_acctbal < 0)::int::bigint AS owes FROM supplier")
def _(t):
    """Saved in buckets under one schema, copied to another; the copy of one that exists is skipped."""
    names = [f"s_{scratch_path(t.spark, 'x')[-12:]}" for _ in range(2)]
    for n in names:
        t.spark.sql(f"CREATE DATABASE {n} LOCATION '{scratch_path(t.spark, n)}'")
    flagged = t.supplier.select("s_suppkey", "s_name", (F.col("s_acctbal") < 0).alias("owes"))
    wr.save_table(flagged, f"{names[0]}.Suppliers", pk="s_suppkey", bucket_by=(4, "s_suppkey"))
    copied = wr.copy_table(t.spark, "Suppliers", *names)
    if wr.copy_table(t.spark, "Suppliers", *names) is not None:
        raise ValueError("a table was copied twice")
    return rd.read_table(t.spark, copied)


@query(
    "measurement_files",
    """
    SELECT event_type AS datatype, count(*) AS n, round(sum(value), 3) AS value FROM events GROUP BY 1
    """,
    digits=3,
)
def _(t):
    path = scratch_path(t.spark, "weather")
    measured = t.events.select(
        F.col("user_id").cast("string").alias("station"), F.to_date("ts").alias("date"), F.col("event_type").alias("datatype"), "value", F.lit("x").alias("attributes")
    )
    wr.export_csv(measured, path, ",")
    read = rd.read_measurements(t.spark, path)
    return read.groupBy("datatype").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


@query(
    "table_by_year",
    "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1997, 1999) GROUP BY 1",
)
def _(t):
    path = scratch_path(t.spark, "by-year")
    wr.write_table(t.orders.withColumn("year", F.year("o_orderdate")), path, partition_by="year")
    return rd.read_by_year(t.spark, path, [1997, 1999]).groupBy("year").agg(F.count("*").alias("n"))


@query(
    "write_modes_with_key",
    "SELECT doc_id, quality, toxic FROM labels UNION ALL SELECT doc_id + 1000000, quality, toxic FROM labels",
)
def _(t):
    path = scratch_path(t.spark, "labels")
    wr.write_table(t.labels, path, "replace", pk="doc_id")
    wr.write_table(t.labels.withColumn("doc_id", F.col("doc_id") + 1000000), path, "append", pk="doc_id")
    return t.spark.read.parquet(path)


@query("view_and_sql", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    return rd.read_sql(
        t.spark, "SELECT n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey", nation=t.nation, region=t.region
    )


@query(
    "model_registry",
    """
    SELECT md5(p_brand) AS model_hash, p_partkey AS id, p_type AS bucket_name, round(p_size / 50.0::double, 6) AS p_5, round(p_retailprice, 6) AS wsc_90,
           'RF(' || p_name || ')' AS model_str, p_name || ', ' || p_type AS features, '[3.0, -5.0]' AS weights_str
    FROM part WHERE p_partkey % 365 >= 31
    """.replace("md5(p_brand)", "md5('RandomForestClassifier(' || p_name || ')')"),
)
def _(t):
    path = scratch_path(t.spark, "registry")
    numbers = F.array(F.col("p_size") / 50.0, F.lit(0.5), F.lit(0.5), F.col("p_retailprice"))
    metrics = F.array(*[F.struct(F.lit(k).alias("k"), numbers.alias("values")) for k in (0.05, 0.3, 0.6, 0.9)])
    pair = lambda c, w: F.struct(F.col(c).alias("feature"), F.lit(w).alias("importance"))
    runs = t.part.select(
        F.expr("timestamp'2016-01-01 00:00:00' + make_dt_interval(cast(p_partkey % 365 as int))").alias("timestamp"),
        F.col("p_partkey").cast("string").alias("label"),
        F.concat(F.lit("RandomForestClassifier("), "p_name", F.lit(")")).alias("model_spec"),
        metrics.alias("model_metrics"),
        F.array(pair("p_name", 0.1), pair("p_type", -0.4)).alias("model_feats_imps"),
        F.lit("2016").alias("model_time"),
        F.col("p_type").alias("bucket_name"),
        F.array(F.lit("9")).alias("bucket_codes"),
        spec_hash(["p_brand", "p_type"]).alias("hash"),
        F.array(F.lit(3.0), F.lit(-5.0)).alias("weights"),
        F.lit("scores").alias("path"),
    )
    wr.append_registry(runs, path)
    wide = wr.load_registry(t.spark, path, subset="2016-02-01")
    return wide.select(
        "model_hash", F.col("label").cast("bigint").alias("id"), "bucket_name", "p_5", "wsc_90", "model_str",
        F.array_join("features_list_alpha", ", ").alias("features"), "weights_str",
    )


@query(
    "score_files",
    "SELECT CASE WHEN doc_id % 2 = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM labels GROUP BY 1",
)
def _(t):
    path = scratch_path(t.spark, "scores")
    split = F.when(F.col("doc_id") % 2 == 0, "test").otherwise("train")
    scores = t.scored.select("doc_id", "score", F.lit("abc").alias("model_hash"), split.alias("split"))
    wr.write_scores(scores, path)
    return t.spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"))


@query(
    "dictionary_export",
    """
    SELECT 'full_data' AS part, doc_id, quality, toxic FROM labels UNION ALL SELECT 'new_dictionary', doc_id, quality, NULL FROM labels
    UNION ALL SELECT 'all_changes', doc_id, quality, toxic FROM labels WHERE quality <> toxic
    """,
)
def _(t):
    path = scratch_path(t.spark, "dictionary")
    wr.export_dictionary(t.labels, path, "doc_id", "quality", "toxic")
    parts = [t.spark.read.parquet(f"{path}/{p}").withColumn("part", F.lit(p)) for p in ("full_data", "new_dictionary", "all_changes")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2])


@query(
    "polygons_from_vertices",
    "SELECT n_nationkey AS area, 4 AS vertices, 4.0::double AS size FROM nation",
)
def _(t):
    from ..functions.geometry import ring_area

    vertices = t.areas.select("area", F.posexplode("ring").alias("seq", "v")).select("area", "seq", "v.x", "v.y")
    path = scratch_path(t.spark, "vertices")
    wr.write_table(vertices, path)
    return rd.read_polygons(t.spark, path, "area").select("area", F.size("ring").alias("vertices"), ring_area("ring").alias("size"))
