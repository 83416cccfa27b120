"""Trailing counts and units busy at once, kept up to date as rows arrive.

Rows may come out of order, as late as the watermark allows; what is later is dropped by Spark. A row is answered
once the watermark has passed its time, so that nothing before it can still arrive, and every answer is final.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.base import as_list, micros
from ..operators.intervals import busy_after
from ..operators.ordered import plan_cuts, running_sum, with_buckets
from ..sources.scratch import scratch_path

#: Rows of this time or later only say that nothing earlier will come.
END_OF_TIME = "9999-01-01 00:00:00"
#: Changes of units' states that one task puts in order.
BUCKET_ROWS = 1 << 20


def with_end(stream: DataFrame, ts) -> DataFrame:
    """A stream of files that are all read at once, and end: a row of a far time lets the watermark pass all others.

    A stream that comes in several batches has such a row in its last file instead.
    """
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, "end")
    last = [F.lit(END_OF_TIME if f.name in as_list(ts) else None).cast(f.dataType).alias(f.name) for f in stream.schema]
    spark.range(1).select(*last).write.parquet(path)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(path))


def watermarked(df: DataFrame, ts: str, lateness: str) -> DataFrame:
    """With a watermark, without the rows that only move it; that filter names `ts`, so it stays above the watermark."""
    return df.withWatermark(ts, lateness).where(F.col(ts) < F.lit(END_OF_TIME).cast("timestamp"))


def count_last_stream(
    df: DataFrame, key: str, ts: str, row_id: str, seconds: int = 86400, lateness: str = "1 hour", out: str = "trailing"
) -> DataFrame:
    """(row_id, key, at, out) as `operators.windows.count_last` on a stream: rows of the key in the `seconds` before a row's instant.

    `at` is in microseconds since 1970. State per key: rows not answered yet, and the instants of the last `seconds` with
    their counts; a key without rows for so long has none. A row without a time counts 0 and is answered at once.
    """
    span = seconds * 1_000_000
    dated = df.select(F.col(row_id).alias("id"), F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("ts"), micros(ts).alias("at"))
    kinds = {c: dated.schema[c].dataType.simpleString() for c in ("id", "key")}

    def answered(of: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        wait_at, wait_id, seen_at, seen_n = state.get if state.exists else ([], [], [], [])
        wait_at, wait_id = list(wait_at), list(wait_id)
        if not state.hasTimedOut:
            for frame in frames:
                wait_at += frame["at"].tolist()
                wait_id += frame["id"].tolist()
        passed = state.getCurrentWatermarkMs() * 1000
        at = np.array(wait_at, np.int64)
        ready = at <= passed
        instants, n = np.unique(at[ready], return_counts=True)
        if len(instants):
            instants, n = np.concatenate([np.array(seen_at, np.int64), instants]), np.concatenate([np.array(seen_n, np.int64), n])
            before = np.concatenate([[0], np.cumsum(n)])
            found = before[np.searchsorted(instants, at[ready])] - before[np.searchsorted(instants, at[ready] - span)]
            ids = [i for i, now in zip(wait_id, ready.tolist(), strict=True) if now]
            yield pd.DataFrame({"id": ids, "key": [of[0]] * len(ids), "at": at[ready], "n": found})
        else:
            instants, n = np.array(seen_at, np.int64), np.array(seen_n, np.int64)
        keep = instants >= passed - span  # what rows to come can look back on
        wait_at, wait_id = at[~ready].tolist(), [i for i, now in zip(wait_id, ready.tolist(), strict=True) if not now]
        if not wait_at and not keep.any():
            state.remove()
            return
        state.update((wait_at, wait_id, instants[keep].tolist(), n[keep].tolist()))
        wake = min(wait_at) if wait_at else int(instants[-1]) + span
        state.setTimeoutTimestamp(max(wake // 1000, passed // 1000) + 1)

    held = f"wait_at array<bigint>, wait_id array<{kinds['id']}>, seen_at array<bigint>, seen_n array<bigint>"
    result = f"id {kinds['id']}, key {kinds['key']}, at bigint, n bigint"
    with_time = watermarked(dated, "ts", lateness)
    found = with_time.groupBy("key").applyInPandasWithState(answered, result, held, "append", GroupStateTimeout.EventTimeTimeout)
    without = dated.where("ts is null").select("id", "key", "at", F.lit(0).cast("bigint").alias("n"))
    return found.unionByName(without).select(F.col("id").alias(row_id), F.col("key").alias(key), "at", F.col("n").alias(out))


def unit_changes_stream(df: DataFrame, unit: str, start: str, end: str, lateness: str = "1 hour") -> DataFrame:
    """(at, unit, delta): changes of the units' states as in `operators.intervals.concurrency`, each once it is certain.

    Rows arrive when a unit is sent and name the time it will be clear, so the watermark follows the earlier of the two. State
    per unit: whether it is busy, and the times to come that are known already.
    """
    begun = F.least(start, end).cast("timestamp")
    timed = watermarked(df.select(F.col(unit).alias("unit"), begun.alias("ts"), micros(start).alias("sent"), micros(end).alias("clear")), "ts", lateness)
    kind = timed.schema["unit"].dataType.simpleString()

    def changes(of: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        busy, at, to = state.get if state.exists else (0, [], [])
        known = set(zip(at, to, strict=True))
        if not state.hasTimedOut:
            for frame in frames:
                for column, value in (("sent", 1), ("clear", 0)):
                    known.update((int(t), value) for t in frame[column].dropna().tolist())
        passed = state.getCurrentWatermarkMs() * 1000
        out = []
        for t, value in sorted(k for k in known if k[0] <= passed):
            if value != busy:
                out.append((t, of[0], value - busy))
            busy = value
        if out:
            yield pd.DataFrame(out, columns=["at", "unit", "delta"])
        ahead = sorted(k for k in known if k[0] > passed)
        state.update((busy, [t for t, _ in ahead], [v for _, v in ahead]))
        if ahead:
            state.setTimeoutTimestamp(max(ahead[0][0] // 1000, passed // 1000) + 1)

    return timed.groupBy("unit").applyInPandasWithState(
        changes, f"at bigint, unit {kind}, delta int", "busy int, at array<bigint>, to array<int>", "append", GroupStateTimeout.EventTimeTimeout
    )


def write_busy_units(changes: DataFrame, path: str):
    """A stream writer that adds the number of busy units after each change, in a folder per batch: (at, unit, delta, busy).

    A batch has the changes between two watermarks, so all of them come after those of earlier batches: within a
    batch it is a running sum over all tasks, in buckets of so many changes that each fits into one, and one number goes from batch to batch. It is kept with the batch's rows,
    so a batch that is run again gives the same.
    """
    spark = changes.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        before = 0
        try:
            before = _left_by(spark, path, number)
            # the size of a batch is known by its rows alone
            cuts = plan_cuts(rows, ["at", "unit"], math.ceil(rows.count() / BUCKET_ROWS))
            if cuts.first:
                placed = with_buckets(rows, ["at", "unit"], cuts, "__bucket")
                summed = busy_after(placed.repartition(max(tasks, cuts.buckets), "__bucket"), cuts)
            else:
                summed = running_sum(rows, F.col("delta").cast("bigint"), ["at", "delta", "unit"], out="busy", cuts=cuts)
            summed = summed.withColumn("busy", F.col("busy") + F.lit(before)).select("at", "unit", "delta", "busy")
            summed.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
            after = rows.agg((F.coalesce(F.sum("delta"), F.lit(0)) + F.lit(before)).cast("bigint").alias("busy"))
            after.write.mode("overwrite").parquet(f"{path}/left/batch={number}")
        finally:
            rows.unpersist()

    return changes.writeStream.foreachBatch(write).outputMode("append")


def _left_by(spark, path: str, number: int) -> int:
    """Units busy after the batch before this one."""
    if number == 0:
        return 0
    return spark.read.parquet(f"{path}/left/batch={number - 1}").first()["busy"]


def run_to_end(writer, path: str) -> None:
    """Start a writer on all files there are, and wait until they are done."""
    query = writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def collected(stream: DataFrame) -> DataFrame:
    """What an appending stream gives for all files there are, as a table in the scratch folder."""
    spark = stream.sparkSession
    path = scratch_path(spark, "stream")
    run_to_end(stream.writeStream.format("parquet").option("path", f"{path}/rows").outputMode("append"), path)
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
