"""Streams in several batches, with late and out-of-order rows, against the batch operators."""

import datetime as dt
import os
import random

from conftest import rows
from pyspark.sql import functions as F

from callgrid.operators import intervals as iv, windows as w
from callgrid.streaming import trailing as tr

START, END = dt.datetime(2024, 1, 1), dt.datetime(9999, 1, 1)


def files(spark, folder, schema, parts):
    """A stream that reads one part after the other."""
    os.makedirs(folder, exist_ok=True)
    for i, part in enumerate(parts):
        at = f"{folder}/{i:03}.json"
        with open(at, "w") as f:
            for row in spark.createDataFrame(part, schema).toJSON().collect():
                f.write(row + "\n")
        os.utime(at, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def test_trailing_counts_of_late_rows(spark, tmp_path):
    r = random.Random(1)
    schema = "id long, place string, ts timestamp, n int"
    given = []
    for i in range(300):
        at = START + dt.timedelta(minutes=15 * i, seconds=r.randint(-3000, 0), microseconds=r.choice([0, 1, 999]))
        given.append((i, r.choice(["a", "a", "b", None]), r.choice([at, at.replace(second=0, microsecond=0)]), 1))
    given += [(900, "a", None, 1), (901, None, None, 1)]
    parts = [given[i : i + 40] for i in range(0, len(given), 40)]
    # far too late: what it would have changed is answered already
    parts[5] = [*parts[5], (999, "a", START, 1)]
    stream = files(spark, str(tmp_path / "in"), schema, [*parts, [(None, None, END, None)]])
    got = tr.collected(tr.count_last_stream(stream, "place", "ts", "id", lateness="1 hour"))
    want = w.count_last(spark.createDataFrame(given, schema), "place", "ts").select("id", "place", "trailing")
    assert rows(got, "id", "place", "trailing") == rows(want)


def test_rows_wait_for_the_watermark(spark, tmp_path):
    schema = "id long, place string, ts timestamp"
    parts = [[(1, "a", START)], [(2, "a", START + dt.timedelta(hours=2))], [(3, "a", START - dt.timedelta(minutes=30)), (4, "a", START + dt.timedelta(hours=2))]]
    stream = files(spark, str(tmp_path / "in"), schema, parts)
    got = tr.collected(tr.count_last_stream(stream, "place", "ts", "id", lateness="2 hours"))
    assert rows(got, "id", "trailing") == [(1, 1), (3, 0)]  # 2 and 4 may still get company


def dispatched(seed, n=200):
    r = random.Random(seed)
    out = []
    for i in range(n):
        sent = START + dt.timedelta(minutes=10 * i + r.randint(-25, 0), seconds=r.choice([0, 0, 30]))
        clear = None if r.random() < 0.05 else sent + dt.timedelta(minutes=r.choice([-5, 0, 20, 60, 300]))
        out.append((r.randint(1, 6), sent, clear))
    return [*out, (None, START, START + dt.timedelta(minutes=7)), (2, None, START + dt.timedelta(hours=3)), *out[:5]]


def test_busy_units_in_batches_and_after_a_restart(spark, tmp_path):
    given, schema = dispatched(3), "unit int, sent timestamp, clear timestamp"
    given.sort(key=lambda x: (x[1] or x[2]) + dt.timedelta(minutes=random.Random(str(x)).randint(0, 30)))
    parts = [given[i : i + 30] for i in range(0, len(given), 30)]
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")

    def run(stream):
        tr.run_to_end(tr.write_busy_units(tr.unit_changes_stream(stream, "unit", "sent", "clear", "1 hour"), path), path)
        return spark.read.parquet(f"{path}/changes").select("at", "unit", "delta", "busy")

    part = rows(run(files(spark, folder, schema, parts[:4])))
    files(spark, folder, schema, parts[:4])
    last = [(None, END, END)]
    got = run(files(spark, folder, schema, [*parts, last]))
    want = iv.concurrency(spark.createDataFrame(given, schema), "unit", "sent", "clear").select("at", "unit", "delta", "busy")
    assert rows(got) == rows(want)
    assert 0 < len(part) < got.count() and set(part) <= set(rows(got)), "what was written first stands"


def test_busy_units_of_a_batch_in_buckets(spark, tmp_path, monkeypatch):
    """A batch is cut by the number of its changes, so that no task has all of them; the sums are the same."""
    given, schema = dispatched(4), "unit int, sent timestamp, clear timestamp"
    stream = files(spark, str(tmp_path / "in"), schema, [given, [(None, END, END)]])
    monkeypatch.setattr(tr, "BUCKET_ROWS", 40)
    used = []
    plain = tr.busy_after
    monkeypatch.setattr(tr, "busy_after", lambda *a: used.append(1) or plain(*a))
    path = str(tmp_path / "out")
    tr.run_to_end(tr.write_busy_units(tr.unit_changes_stream(stream, "unit", "sent", "clear", "9000 days"), path), path)
    got = spark.read.parquet(f"{path}/changes").select("at", "unit", "delta", "busy")
    want = iv.concurrency(spark.createDataFrame(given, schema), "unit", "sent", "clear", 1).select("at", "unit", "delta", "busy")
    assert rows(got) == rows(want) and used
