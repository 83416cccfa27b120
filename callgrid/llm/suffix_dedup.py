"""Removing passages that occur earlier in the corpus, exact to the byte, by deep-shallow sorting of suffixes.

A byte goes if a string of `length` bytes that covers it also starts earlier. So the suffixes that matter are those with an
equal among the others in their first `length` bytes, and few suffixes have one:

1. Anchors. Every string of `length` bytes has an anchor: the k bytes in it with the lowest hash, the leftmost of equals. It
   depends on the string alone, so equal strings have equal anchors at equal places. Hashes of anchors that occur
   once (nearly all) rule out every string they stand for.
2. Segments. The strings of one anchor start at consecutive bytes and form a segment of at most 2 * length - k bytes. Only
   segments with a repeated anchor hash are read from the texts. Equal segments collapse to the earliest; the rest is repeats.
3. Deep-shallow sort (Manzini and Ferragina). Suffixes of the distinct segments of an anchor are ordered by multikey
   quicksort, eight bytes a step, to a shallow depth. Groups that are still tied are ordered with blind tries: one member
   stands for the trie's path, every other is compared with it once and branches off at (depth of the first other
   byte, that byte), and each branch is a trie of its own.

Documents whose whole text occurs under a smaller doc_id are repeats as they are. Sorting runs twice: within the tasks that read the texts, so that a passage in a third of all documents leaves each task at
most once, and by anchor for what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import KeyFilter, written
from .textbytes import BYTE_HASH, PIECE_BYTES, U, mixed, pieces, powers
from .tokens import release

K = 32
SHALLOW_WORDS = 4
DOCS_A_BUCKET = 2000
SUFFIXES_AT_ONCE = 1 << 20
SEGMENT_BYTES_AT_ONCE = 48 << 20
POSITION_BITS = U(22)
PART_SCHEMA = "doc long, e long, low long, high long, h long, off int, segment binary"
PART = pa.schema([("doc", pa.int64()), ("e", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("h", pa.int64()), ("off", pa.int32()), ("segment", pa.binary())])


def anchors(buf: np.ndarray, bounds: np.ndarray, length: int):
    """(row, first start, last start, anchor position, anchor hash) for each run of strings with one anchor.

    Positions are those in `buf`. Rows of more than the usual piece are cut into overlapping parts.
    """
    if len(buf) > 2 * PIECE_BYTES:  # one long row
        found, step = [], PIECE_BYTES
        for at in range(0, max(1, len(buf) - length + 1), step):
            part = buf[at : at + step + length - 1]
            row, low, high, place, h = anchors(part, np.array([0, len(part)]), length)
            found.append((row, low + at, high + at, place + at, h))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
    n = len(buf) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, np.zeros(0, U)
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum(BYTE_HASH[buf] * powers(len(buf)), out=sums[1:])
    h = mixed((sums[K:] - sums[:-K]) * powers(len(buf) - K + 1, True))
    low = (h & ~((U(1) << POSITION_BITS) - U(1))) | np.arange(len(h), dtype=U)
    span, width = 1, length - K + 1
    while span < width:  # low[i] becomes the lowest of i .. i + span - 1
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    place = (low & ((U(1) << POSITION_BITS) - U(1))).astype(np.int64)[:n]
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    inside = np.arange(n) + length <= bounds[1:][row]
    start = np.flatnonzero(inside)
    if not len(start):
        return none, none, none, none, np.zeros(0, U)
    place, row = place[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return row[first], start[first], start[last], place[first], h[place[first]]


def _big_endian_words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number that orders like them."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    out = np.zeros(len(buf), U)
    for j in range(8):
        out |= padded[j : j + len(buf)].astype(U) << U(56 - 8 * j)
    return out


def equal_groups(words: np.ndarray, at: np.ndarray, key: np.ndarray, length: int) -> np.ndarray:
    """A label for each suffix: two have the same one only if key and the first `length` bytes agree. -1: alone."""
    label = np.full(len(at), -1, np.int64)
    depths = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]

    def regrouped(active, group, *columns):
        """Sort by group and columns; only groups of two and more stay."""
        order = np.lexsort((*columns[::-1], group))
        changed = np.zeros(len(order), bool)
        for column in (group, *columns):
            c = column[order]
            changed[1:] |= c[1:] != c[:-1]
        group = np.cumsum(changed)
        shared = np.bincount(group)[group] > 1
        return active[order][shared], group[shared]

    active, group = regrouped(np.arange(len(at)), key)
    for depth in depths[:SHALLOW_WORDS]:  # multikey quicksort: ties go on to the next eight bytes
        if len(active):
            active, group = regrouped(active, group, words[at[active] + depth])
    while len(active):  # blind tries
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        stands = active[np.flatnonzero(first)[np.cumsum(first) - 1]]
        depth = np.full(len(active), -1, np.int64)
        byte = np.zeros(len(active), np.int64)
        open_ = np.arange(len(active))
        for d in depths[SHALLOW_WORDS:]:
            word = words[at[active[open_]] + d]
            other = word ^ words[at[stands[open_]] + d]
            differ = other != 0
            if differ.any():
                where, bits = open_[differ], other[differ]
                zero = np.zeros(len(bits), np.int64)
                for s in (32, 16, 8):  # bytes in common
                    high = (bits >> U(64 - s)) == 0
                    zero[high] += s // 8
                    bits[high] <<= U(s)
                depth[where] = d + zero
                byte[where] = ((word[differ] >> (U(56) - (zero * 8).astype(U))) & U(255)).astype(np.int64)
                open_ = open_[~differ]
        same = depth < 0
        label[active[same]] = stands[same]
        active, group, depth, byte = active[~same], group[~same], depth[~same], byte[~same]
        if len(active):
            active, group = regrouped(active, group, depth, byte)
    alone = np.bincount(label[label >= 0], minlength=len(label)) == 1
    label[(label >= 0) & alone[label]] = -1
    return label


class Segments:
    """Segments gathered by a task, and what sorting them shows."""

    def __init__(self, length: int):
        self.length, self.rows, self.bytes = length, [], 0

    def add(self, h: int, off: int, segment: bytes, doc: int, e: int, low: int) -> None:
        self.rows.append((h, segment, doc, low, e, off))
        self.bytes += len(segment) + 200

    def sorted_out(self) -> tuple[list[tuple], list[tuple]]:
        """(repeats, rest): runs of starts with an earlier equal here, and runs without, as segments. Empties it."""
        # order: anchor, content, then place
        rows, self.rows, self.bytes = sorted(self.rows), [], 0
        repeats, groups, last = [], [], None
        for row in rows:
            h, segment, doc, low, e, _ = row
            if last and last[1] == segment and last[0] == h:
                if (doc, low, e) != (last[2], last[3], last[4]):
                    repeats.append((doc, e, low, low + len(segment) - self.length))
                continue
            if last and last[0] == h:
                groups[-1].append(row)
            else:
                groups.append([row])
            last = row
        rest, held, suffixes = [g[0] for g in groups if len(g) == 1], [], 0
        for g in groups:
            if len(g) > 1:
                held += g
                suffixes += sum(len(x[1]) - self.length + 1 for x in g)
                if suffixes >= SUFFIXES_AT_ONCE:
                    self._suffixes(held, repeats, rest)
                    held, suffixes = [], 0
        if held:
            self._suffixes(held, repeats, rest)
        return repeats, rest

    def _suffixes(self, rows: list[tuple], repeats: list, rest: list) -> None:
        buf = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
        size = np.array([len(r[1]) for r in rows])
        count = size - self.length + 1
        begin = np.cumsum(size) - size
        base = np.cumsum(count) - count
        seg = np.repeat(np.arange(len(rows)), count)
        offset = np.arange(count.sum()) - base[seg]
        at = begin[seg] + offset
        ahead = np.array([r[5] for r in rows], np.int64)[seg] - offset
        key = np.array([r[0] for r in rows], np.int64).view(U)[seg] ^ mixed(ahead.astype(U))
        label = equal_groups(_big_endian_words(buf), at, key, self.length)
        doc = np.array([r[2] for r in rows], np.int64)[seg]
        place = np.array([r[3] for r in rows], np.int64)[seg] + offset
        tied = np.flatnonzero(label >= 0)
        tied = tied[np.lexsort((place[tied], doc[tied], label[tied]))]
        later = np.zeros(len(tied), bool)
        same = label[tied][1:] == label[tied][:-1]
        later[1:] = same
        # rows equal in place are one document given twice: neither is earlier
        equal_place = np.zeros(len(tied), bool)
        equal_place[1:] = same & (doc[tied][1:] == doc[tied][:-1]) & (place[tied][1:] == place[tied][:-1])
        repeat = np.zeros(len(at), bool)
        repeat[tied] = later
        for i in np.flatnonzero(equal_place):
            repeat[tied[i]] = repeat[tied[i - 1]]
        new = np.ones(len(at), bool)
        new[1:] = (repeat[1:] != repeat[:-1]) | (seg[1:] != seg[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            h, segment, d, low, e, off = rows[seg[a]]
            i, j = int(offset[a]), int(offset[b])
            if repeat[a]:
                repeats.append((d, e, low + i, low + j))
            else:
                rest.append((h, segment[i : j + self.length], d, low + i, e, off - i))


def _batch(repeats: list[tuple], rest: list[tuple] = ()) -> pa.RecordBatch:
    rows = [(d, e, a, b, e, None, None) for d, e, a, b in _merged(repeats)]
    rows += [(d, e, low, low, h, off, segment) for h, segment, d, low, e, off in rest]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PART, strict=True)], schema=PART)


def _merged(runs: list[tuple]) -> list[tuple]:
    """Runs of starts that touch become one."""
    out = []
    for d, e, a, b in sorted(runs):
        if out and out[-1][0] == d and out[-1][1] == e and a <= out[-1][3] + 1:
            out[-1][3] = max(out[-1][3], b)
        else:
            out.append([d, e, a, b])
    return out


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int):
    """Per text 48 bits of the hashes of its anchors; one that occurs again in the text is there twice."""
    release()
    for rows, buf, bounds in pieces(batches, "text"):
        row, _, _, _, h = anchors(buf, bounds, length)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        keep = np.ones(len(row), bool)
        keep[2:] = (row[2:] != row[:-2]) | (h[2:] != h[:-2])
        row, h = row[keep], h[keep]
        at = np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(at, pa.array((h >> U(16)).view(np.int64)))
        yield pa.RecordBatch.from_arrays([rows.column("e"), lists], names=["e", "hs"])


def _bucketed(batches: Iterator[pa.RecordBatch], buckets: int):
    """The 48 bits of each anchor hash, six bytes apiece, by bucket. What a batch has more than once is there twice."""
    for batch in batches:
        h, count = np.unique(batch.column("hs").flatten().to_numpy().view(U), return_counts=True)
        h = np.repeat(h, np.minimum(count, 2))
        bucket = ((h >> U(16)) * U(buckets) >> U(32)).astype(np.int32)  # ascending, as h is
        entries = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(first[1:], len(h))
        data = [entries[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(data, pa.binary())], names=["bucket", "entries"])


def _repeated(batches: Iterator[pa.RecordBatch]):
    """Rows sorted by bucket: the hashes that are there twice or more."""
    now, held = None, []

    def found():
        entries = np.frombuffer(b"".join(held), np.uint8).reshape(-1, 6)
        wide = np.zeros((len(entries), 8), np.uint8)
        wide[:, :6] = entries
        h, count = np.unique(wide.view("<i8")[:, 0], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h[count > 1])], names=["short"])

    for rows in batches:
        for bucket, entries in zip(rows.column("bucket").to_pylist(), rows.column("entries").to_pylist(), strict=True):
            if bucket != now and held:
                yield found()
                held = []
            now = bucket
            held.append(entries)
    if held:
        yield found()


def _candidate_segments(batches: Iterator[pa.RecordBatch], length: int):
    """Of texts with the anchor hashes to look at, 48 bits of each: repeats within the task, and the segments left."""
    release()
    held = Segments(length)
    for rows, buf, bounds in pieces(batches, "text"):
        row, low, high, place, h = anchors(buf, bounds, length)
        cut = np.searchsorted(row, np.arange(rows.num_rows + 1))
        docs, es, wanted = (rows.column(c).to_pylist() for c in ("doc", "e", "hs"))
        for i in range(rows.num_rows):
            a, b = cut[i], cut[i + 1]
            for j in (a + np.flatnonzero(np.isin((h[a:b] >> U(16)).view(np.int64), np.array(wanted[i], np.int64)))).tolist():
                s = int(low[j])
                segment = buf[s : int(high[j]) + length].tobytes()
                held.add(int(h[j : j + 1].view(np.int64)[0]), int(place[j]) - s, segment, docs[i], es[i], s - int(bounds[i]))
            if held.bytes > SEGMENT_BYTES_AT_ONCE:
                yield _batch(*held.sorted_out())
    yield _batch(*held.sorted_out())


def _final_repeats(batches: Iterator[pa.RecordBatch], length: int):
    """Rows sorted by anchor hash: what the first sort left is sorted again, now with all its equals."""
    held, h0 = Segments(length), None
    for rows in batches:
        out = []
        for doc, e, low, high, h, off, segment in zip(*(rows.column(i).to_pylist() for i in range(7)), strict=True):
            if segment is None:
                out.append((doc, e, low, high))
                continue
            if h != h0 and held.bytes > SEGMENT_BYTES_AT_ONCE:
                out += held.sorted_out()[0]
            h0 = h
            held.add(h, off, segment, doc, e, low)
        yield _batch(out)
    yield _batch(held.sorted_out()[0])


def remove_repeats(docs: DataFrame, length: int = 100, as_text: bool = False) -> DataFrame:
    """Each row of `docs` (doc_id, text, other columns) with what is left of its text.

    Columns: doc_id, the other columns but text, then n_bytes, n_removed, n_spans, kept_sha256 and kept (binary; with `as_text`
    a string, without the bytes of characters that were cut apart). Texts are UTF-8 bytes, null is empty, matches stay within a row. The earlier of two equal strings has the smaller doc_id (null:
    smaller than any), then the earlier start. Rows equal in doc_id and text are one document given twice and get the same
    result. `length` is at least 40. Clashing names among the other columns are replaced.
    """
    if length < K + 8:
        raise ValueError("strings of at least 40 bytes")
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    others = [c for c in docs.columns if c not in ("doc_id", "text", *made)]
    text = F.coalesce("text", F.lit(""))
    plain = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("e"),
        text.alias("text"),
        *[F.col(f"`{c}`").alias(f"other{i}") for i, c in enumerate(others)],
    )
    whole, plain = plain, plain.select("doc", "e", "text")

    # texts that a smaller doc_id has too go as a whole, and need no anchors
    size = F.octet_length(F.encode("text", "UTF-8"))
    texts = plain.select("doc", "e", F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(1)).alias("t2"), size.alias("size"))
    first = texts.groupBy("t1", "t2").agg(F.min("doc").alias("first"))
    copies = written(texts.join(first, ["t1", "t2"]).where("doc > first").select("doc", "e", "size"), "copies")
    # of texts and anchors only those move that a filter of the other side lets through
    near, far = KeyFilter(copies.select("e")).split(plain.select("e", "text"), "e")
    found = far.union(near.join(copies.select("e").hint("merge"), "e", "left_anti"))
    found = written(found.mapInArrow(lambda it: _anchor_rows(it, length), "e long, hs array<long>"), "anchors")
    buckets = max(64, found.count() // DOCS_A_BUCKET)
    counted = found.select("hs").mapInArrow(lambda it: _bucketed(it, buckets), "bucket int, entries binary")
    counted = counted.repartition("bucket").sortWithinPartitions("bucket")
    repeated = written(counted.mapInArrow(_repeated, "short long"), "repeated")
    single, _ = KeyFilter(repeated).split(found.select("e", F.explode("hs").alias("short")), "short")
    wanted = written(single.join(repeated, "short").groupBy("e").agg(F.collect_set("short").alias("hs")), "wanted")
    near, _ = KeyFilter(wanted.select("e")).split(plain, "e")
    parts = near.join(wanted, "e").select("doc", "e", "text", "hs")
    parts = parts.mapInArrow(lambda it: _candidate_segments(it, length), PART_SCHEMA)
    parts = parts.repartition("h").sortWithinPartitions("h", "doc", "low")
    parts = parts.mapInArrow(lambda it: _final_repeats(it, length), PART_SCHEMA)
    whole_texts = copies.where(F.col("size") >= length).select(
        "doc", "e", F.lit(0).cast("long").alias("low"), (F.col("size") - length).cast("long").alias("high")
    )
    runs = parts.select("doc", "e", "low", "high").union(whole_texts).groupBy("e").agg(F.collect_list(F.struct("doc", "low", "high")).alias("runs"))
    runs = written(runs, "runs")

    def cut(batches):
        for batch in batches:
            out = []
            for doc, data, found in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "runs")), strict=True):
                data, spans, kept, at = data.encode(), [], [], 0
                for r in sorted(found or (), key=lambda r: r["low"]):
                    if r["doc"] != doc:
                        continue
                    if spans and r["low"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r["high"] + length)
                    else:
                        spans.append([r["low"], r["high"] + length])
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if as_text else kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if as_text else pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["row", *made]
            )

    doc_id = F.expr("nullif(doc, -9223372036854775807 - 1)").alias("doc_id")
    row = F.struct(doc_id, *[F.col(f"other{i}").alias(c) for i, c in enumerate(others)])
    near, far = KeyFilter(runs.select("e")).split(whole, "e")
    joined = near.join(runs, "e", "left").unionByName(far, allowMissingColumns=True).select(row.alias("row"), "doc", "text", "runs")
    schema = joined.select("row").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    return joined.mapInArrow(cut, schema.add("kept_sha256", "string").add("kept", "string" if as_text else "binary")).select("row.*", *made)
