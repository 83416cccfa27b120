"""Token ids as files: frequency ranks in byte-aligned variable length, lengths apart in control bytes (Stream VByte).

Ids are replaced by their rank in the corpus, the most frequent being 0. A rank takes one to four bytes, low byte first. Four
ranks share a control byte with two bits each, for the length less one, the first rank in the lowest bits. Every document
starts a control byte. Decoding is a table lookup of four lengths per control byte and a gather.

A folder holds `ranks` (rank, id) and `blocks`: Parquet rows of whole documents in ascending doc_id order with part, seq,
start (ids before it in its part), doc_ids and lengths (64-bit), control and data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .tables import new_path
from .tokens import from_planes, release, token_table

BLOCK_IDS = 1 << 17
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
BLOCK_SCHEMA = "part int, seq int, start long, doc_ids binary, lengths binary, control binary, data binary"


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of one document."""
    ranks = ranks.astype(np.uint32)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4)[None, :] < size[:, None]
    return control.tobytes(), ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ranks of consecutive documents with so many ranks each."""
    groups = -(-lengths // 4)
    size = LENGTHS[control].reshape(-1)
    # the last control byte of a document may have unused places
    first = np.cumsum(groups) * 4 - groups * 4
    place = np.arange(lengths.sum()) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
    size = size[place]
    start = np.cumsum(size) - size
    data = np.concatenate([data, np.zeros(3, np.uint8)])
    out = data[start].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= data[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Encode every row of `docs` (doc_id, text, other columns) into a folder.

    Null texts and empty ones have the end id alone. Null doc_ids come first; rows with one doc_id are ordered by a
    hash of their ids. An empty table makes a folder without blocks. The driver holds one count for each id of the vocabulary.
    """
    spark = docs.sparkSession
    table = token_table(docs, vocabulary, end_id, "tokens")
    counts = sum((np.frombuffer(r[0], np.int64) for r in _sums(table).collect()), np.zeros(1, np.int64))
    ids = np.argsort(-counts, kind="stable").astype(np.uint32)
    rank = np.empty_like(ids)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    spark.createDataFrame(list(enumerate(ids.tolist())), "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")

    def blocks(batches: Iterator[pa.RecordBatch]):
        part, seq, start, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        release()

        def block():
            doc_ids, lengths, control, data = zip(*held, strict=True)
            missing = np.iinfo(np.int64).min
            doc_ids = np.array([missing if d is None else d for d in doc_ids], np.int64)
            row = [part, seq, start, doc_ids.tobytes(), np.array(lengths, np.int64).tobytes(), b"".join(control), b"".join(data)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
            names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, n, data in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "ids")), strict=True):
                held.append((doc_id, n, *encode_ranks(rank[from_planes(data, n)])))
                size += n
                if size >= block_ids:
                    yield block()
                    seq, start, held, size = seq + 1, start + size, [], 0
        if held:
            yield block()

    # ids move as the table has them: looking for range bounds reads it once more, and nothing is coded twice
    rows, first = table.where("counts is null").select("doc_id", "n", "ids"), F.col("doc_id").asc_nulls_first()
    ordered = rows.repartitionByRange(first).sortWithinPartitions(first, F.xxhash64("ids"))
    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(f"{path}/blocks")


def _sums(table: DataFrame) -> DataFrame:
    """The tasks' counts added up in a few groups, so that few vectors of vocabulary size reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            for data in batch["counts"].to_pylist():
                counts = np.frombuffer(data, np.int64)
                total = counts.copy() if total is None else total + counts
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    return table.where("counts is not null").select("counts").coalesce(8).mapInArrow(add, "counts binary")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in a folder; ids are little-endian unsigned 32-bit numbers."""
    listed = spark.read.parquet(f"{path}/ranks").collect()
    ids = np.zeros(len(listed), "<u4")
    for r in listed:
        ids[r["rank"]] = r["id"]
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")

    def decoded(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("part", "start", "doc_ids", "lengths", "control", "data"))
            for part, start, doc_ids, lengths, control, data in zip(*columns, strict=True):
                doc_ids, lengths = np.frombuffer(doc_ids, np.int64), np.frombuffer(lengths, np.int64)
                found = ids[decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), lengths)].tobytes()
                ends = np.cumsum(lengths)
                parts = [found[4 * a : 4 * b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                missing = doc_ids == np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), part, np.int32)),
                        pa.array(doc_ids, mask=missing),
                        pa.array(start + ends - lengths),
                        pa.array(lengths),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids"],
                )

    rows = blocks.drop("seq").mapInArrow(decoded, "part int, doc_id long, start long, n_tokens long, ids binary")
    # ids of the parts before, from one row a part
    sizes = blocks.select("part", "lengths").mapInArrow(_block_sizes, "part int, size long")
    sizes = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = sizes.select("part", before.alias("before"))
    # a part is a partition of the writer: a few bytes for each
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids")


def _block_sizes(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        sizes = [int(np.frombuffer(x, np.int64).sum()) for x in batch["lengths"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["part"], pa.array(sizes, pa.int64())], names=["part", "size"])


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write the documents' ids to a new folder and read them back."""
    path = new_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, vocabulary, end_id)
    return read_tokens(docs.sparkSession, path)
