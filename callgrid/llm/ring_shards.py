"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (Mirrokni, Thorup, Zadimoghaddam, 2018).

Every shard owns arcs of the ring, one per virtual node. A row's hash falls into an arc; rows beyond what the arc's shard
can hold continue clockwise to the next shard with room. Since rows of an arc share their way around the ring, counts
per arc decide everything: the walk is over `shards * virtual` numbers, and rows learn their shard from their rank in the arc.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

PREFIX_BITS = 12


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows as a table made by Spark from one literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def ring(spark: SparkSession, shards: int, virtual: int) -> list[tuple[int, int]]:
    """(last position, shard) of each arc in clockwise order; `shards * virtual` rows. More shards only add arcs."""
    ids = spark.range(shards * virtual).select((F.col("id") % shards).alias("shard"), F.floor(F.col("id") / shards).alias("node"))
    places = ids.select(F.xxhash64("shard", "node").alias("place"), "shard").distinct().collect()
    return sorted((r["place"], r["shard"]) for r in places)


def walk(arcs: list[tuple[int, int]], counts: dict[int, int], shards: int, load: float) -> list[dict]:
    """Which ranks of which arc go to which shard, from which slot on.

    A shard holds load * rows / shards, rounded up; with load 1 the first `rows % shards` shards hold one more than the rest.
    First each arc fills its own shard, then what is left of it walks on.
    """
    total = sum(counts.values())
    if load == 1:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    else:
        room = [-(-int(total * load * 1000) // (1000 * shards)) for s in range(shards)]
    filled, out, left = [0] * shards, [], []

    def put(arc: int, low: int, high: int, shard: int) -> int:
        n = min(high - low, room[shard] - filled[shard])
        if n:
            out.append({"arc": arc, "low": low, "high": low + n, "shard": shard, "base": filled[shard] - low})
            filled[shard] += n
        return low + n

    for arc, (_, shard) in enumerate(arcs):
        n = counts.get(arc, 0)
        low = put(arc, 0, n, shard)
        if low < n:
            left.append((arc, low, n))
    for arc, low, n in left:
        step = arc
        while low < n:
            step = (step + 1) % len(arcs)
            low = put(arc, low, n, arcs[step][1])
    return out


def ring_shards(docs: DataFrame, shards: int = 8, virtual: int = 128, load: float = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of `docs` (doc_id, text, any other columns).

    size is the text's UTF-8 bytes plus 1 (null: 1, checksum of nothing). No shard holds more than load * rows / shards rows;
    with load 1 counts are at most one apart. Slots are 0, 1, ... within a shard. Rows equal in doc_id and text are
    interchangeable and get a place each; null doc_ids are told apart by their text. Nothing passes the driver but counts
    of `shards * virtual` arcs.
    """
    spark = docs.sparkSession
    arcs = ring(spark, shards, virtual)
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    keys = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    ).withColumn("place", F.xxhash64("doc_id", "text_crc32"))

    low, most, cells = -(1 << 63), (1 << 63) - 1, []
    for arc, (last, _) in enumerate([*arcs, (most, 0)]):
        number = arc % len(arcs)  # beyond the last virtual node the ring starts anew
        for prefix in range(low >> (64 - PREFIX_BITS), (last >> (64 - PREFIX_BITS)) + 1):
            cells.append({"prefix": prefix, "first": low, "last": last, "arc": number})
        low = min(last + 1, most)
    cells = F.broadcast(small_table(spark, cells, "prefix: bigint, first: bigint, last: bigint, arc: int"))
    keys = keys.withColumn("prefix", F.shiftright("place", 64 - PREFIX_BITS))
    keys = keys.join(cells, "prefix").where("place between first and last").drop("prefix", "first", "last")

    counts = {r["arc"]: r["count"] for r in keys.groupBy("arc").count().collect()}
    schema = "arc: int, low: bigint, high: bigint, shard: int, base: bigint"
    runs = F.broadcast(small_table(spark, walk(arcs, counts, shards, load), schema))
    order = Window.partitionBy("arc").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = keys.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    placed = ranked.join(runs, "arc").where("rank >= low and rank < high")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank")).alias("slot"))
