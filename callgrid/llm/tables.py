"""Tables between the steps of an operator, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Only where it is unset (tests, local sessions) a new folder is taken."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Rows handed to Python at once while a table is written: documents of some kilobytes make batches of some megabytes.
ROWS_A_BATCH = 2000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = ROWS_A_BATCH):
    """Smaller Arrow batches for the jobs run inside; the session's setting comes back afterwards."""
    before = spark.conf.get(_BATCH_KEY)
    spark.conf.set(_BATCH_KEY, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_KEY, before)


def written(df: DataFrame, name: str, codec: str = "zstd", rows: int = ROWS_A_BATCH) -> DataFrame:
    """The frame computed once into a shared table and read back: its lineage ends there."""
    path = new_path(df.sparkSession, name)
    with small_batches(df.sparkSession, rows):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class KeyFilter:
    """A table of bits, one of them set for each key: few words to broadcast, whatever the number of keys.

    It rules out most rows whose key is not there, so that only the others need to move for an exact join. Beyond 64
    million bits it rules out less. Keys are longs, and null is one like the others.
    """

    BITS_A_KEY = 32
    MOST_WORDS = 1 << 20

    def __init__(self, keys: DataFrame):
        words = min(self.MOST_WORDS, max(64, keys.count() * self.BITS_A_KEY // 64))
        self.shift = 64 - (words - 1).bit_length()
        word, bit = self._place(F.col(keys.columns[0]))
        self.word, self.bits = (f"{x}_{uuid.uuid4().hex}" for x in ("word", "bits"))  # no column of other tables
        bits = keys.select(word.alias(self.word), bit.alias("bit")).groupBy(self.word).agg(F.bit_or("bit").alias(self.bits))
        self.words = written(bits, "filter")

    def _place(self, key: Column) -> tuple[Column, Column]:
        h = F.xxhash64(key.cast("long"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
        return F.shiftrightunsigned(h, self.shift), bit

    def split(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(rows whose key may be there, rows whose key is not)."""
        word, bit = self._place(F.col(key))
        there = (F.col(self.word) == word) & (F.col(self.bits).bitwiseAND(bit) != 0)
        near, far = (rows.join(F.broadcast(self.words), there, how) for how in ("left_semi", "left_anti"))
        return near, far
