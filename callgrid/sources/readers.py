"""Tables from files and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from ..functions.base import as_list
from ..functions.geometry import reprojected

# The columns of a daily weather measurement.
WEATHER_SCHEMA = "station string, date date, datatype string, value double, attributes string"


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with blanks as underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def read_csv(
    spark: SparkSession, path, schema: str | T.StructType | None = None, sampling: float = 1.0, sep: str = ",", **options
) -> DataFrame:
    """CSV files with a header; types come from the schema, or are inferred. Names are normalised.

    All rows are looked at, so that every value fits. With `sampling` below 1 values that do not fit the types of the sample
    are read as NULL, and with a schema those that do not fit the schema; mode="FAILFAST" refuses them.
    """
    reader = spark.read.option("header", True).option("sep", sep).options(**options)
    if schema is not None:
        return normalise_names(reader.schema(schema).csv(path))
    return normalise_names(reader.option("inferSchema", True).option("samplingRatio", sampling).csv(path))


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Text lines with their place: (file, start, seq, line). Lines of a file sort by (start, seq)."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def _edge(lines: DataFrame, n: int, last: bool) -> DataFrame:
    """The first or last n lines of each file; every task sends at most n lines per file on."""
    order = [F.desc("start"), F.desc("seq")] if last else ["start", "seq"]
    w = W.partitionBy("file").orderBy(*order)
    return lines.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def keep_head(lines: DataFrame, n: int) -> DataFrame:
    return _edge(lines, n, last=False)


def drop_lines(lines: DataFrame, head: int = 0, tail: int = 0) -> DataFrame:
    """Without the first `head` and the last `tail` lines of each file.

    The places of the dropped lines, a few per file, are joined: Spark broadcasts them while they are few.
    """
    for n, last in ((head, False), (tail, True)):
        if n:
            gone = _edge(lines, n, last).select("file", "start", "seq")
            lines = lines.join(gone, ["file", "start", "seq"], "left_anti")
    return lines


def parse_lines(lines: DataFrame, schema: str, sep: str = ",") -> DataFrame:
    return lines.select(F.from_csv("line", schema, {"sep": sep}).alias("r")).select("r.*")


def read_csv_trimmed(
    spark: SparkSession, path, schema: str, header: int = 1, footer: int = 1, first: int | None = None, sep: str = ","
) -> DataFrame:
    """CSV files with a fixed schema, without header and footer lines, or only the first lines after the header."""
    lines = read_lines(spark, path)
    if first is not None:
        lines, footer = keep_head(lines, header + first), 0
    return parse_lines(drop_lines(lines, header, footer), schema, sep)


def read_tables(spark: SparkSession, folder: str, names, fmt: str = "parquet", **options) -> dict[str, DataFrame]:
    """One table per name from `folder/name`."""
    return {n: spark.read.format(fmt).options(**options).load(f"{folder.rstrip('/')}/{n}") for n in as_list(names)}


def read_dictionary(spark: SparkSession, path, **options) -> DataFrame:
    """A lookup sheet exported as CSV; every column is text."""
    return normalise_names(spark.read.option("header", True).options(**options).csv(path))


def read_measurements(spark: SparkSession, path, schema: str = WEATHER_SCHEMA) -> DataFrame:
    """All measurement files of a folder under one fixed schema."""
    return read_csv(spark, path, schema)


def read_moon(spark: SparkSession, path) -> DataFrame:
    """All moon phase files of a folder; exact duplicate rows, from overlapping files, are dropped."""
    return read_csv(spark, path).dropDuplicates()


def read_polygons(
    spark: SparkSession, path, key: str, vertex_order: str = "seq", fmt: str = "parquet", part: str | None = None, plane: dict | None = None
) -> DataFrame:
    """Polygons from one row per vertex (key, seq, x, y): `ring array<struct<x, y>>` in vertex order.

    With a `part` column, which numbers parts and holes, `rings array<array<struct<x, y>>>`. `plane` has the parameters of the
    projection the layer is in, for one that is not in degrees; its corners are put into degrees.
    """
    vertices = spark.read.format(fmt).load(path)
    polygons = rings_from_vertices(vertices, key, vertex_order, part)
    ring = "ring" if part is None else "rings"
    return polygons if plane is None else polygons.withColumn(ring, reprojected(ring, part is not None, plane))


def rings_from_vertices(vertices: DataFrame, key: str, vertex_order: str = "seq", part: str | None = None) -> DataFrame:
    """One `ring` per key, or with a column that numbers parts and holes `rings`, one list of rings per key."""
    ordered = F.array_sort(
        F.collect_list(
            F.struct(
                F.col(vertex_order).alias("s"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")
            )
        )
    )
    ring = F.transform(ordered, lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    if part is None:
        return vertices.groupBy(key).agg(ring.alias("ring"))
    parts = vertices.groupBy(key, part).agg(ring.alias("ring"))
    listed = F.array_sort(F.collect_list(F.struct(F.col(part).alias("p"), "ring")))
    return parts.groupBy(key).agg(F.transform(listed, lambda r: r["ring"]).alias("rings"))


def rings_from_wkt(df: DataFrame, wkt: str, out: str = "rings") -> DataFrame:
    """`POLYGON ((x y, ...), (...))` or `MULTIPOLYGON (((...)), ((...)))` text to `array<array<struct<x, y>>>`.

    Parts and holes become rings of one list: a point is inside where it is inside an odd number of them.
    """
    body = F.regexp_replace(F.col(wkt), r"(?i)^\s*(MULTI)?POLYGON\s*Z?\s*\(\s*\(+\s*\(*|[\s)]+$", "")
    rings = F.transform(
        F.split(body, r"\)[\s)]*,\s*\([\s(]*"),
        lambda r: F.transform(
            F.split(F.trim(r), r"\s*,\s*"),
            lambda p: F.struct(
                F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"),
                F.split(F.trim(p), r"\s+")[1].cast("double").alias("y"),
            ),
        ),
    )
    return df.withColumn(out, rings).drop(wkt)


def read_by_year(spark: SparkSession, path: str, years, year: str = "year", fmt: str = "parquet") -> DataFrame:
    """A table partitioned by year, restricted to the given years (only their folders are read)."""
    return spark.read.format(fmt).load(path).where(F.col(year).isin(*as_list(years)))


def read_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    return spark.table(f"{schema}.{name}" if schema else name)


def read_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """A query over the catalog; keyword arguments are frames used in it as `{name}`."""
    return spark.sql(query, **frames)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower, upper, parts: int, **options) -> DataFrame:
    """A database table read in parallel ranges of a numeric or time column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
        .options(**options)
        .load()
    )
