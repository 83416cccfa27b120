"""Phrase collocations by external streams of counts, kept in prefix and in suffix order.

Phrases that may be frequent are found order by order: a phrase can only be as frequent as the two phrases one word shorter in
it. Per order, hash counts of the tasks are added up in buckets, and what reaches the least count sets a bit of a filter of
bounded size. The filters only spare work: phrases that pass all of them are then counted by their words, exactly.

The counted phrases are one stream of all orders. Sorted by words, a phrase follows the phrases it extends to the
right, so one pass in lockstep hands it the counts of all its beginnings and tells them of their extensions; sorted by words
from the last to the first, the same pass deals with its ends. No lookup table is built; the stream is cut into ranges,
and the few phrases whose extensions lie in later ranges go there as well.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import written
from .textbytes import LOWER, U, mixed, pieces, run_hashes, words
from .tokens import _runs, release

ORDERS = 4
#: Texts are cut into words so many bytes at a time.
TEXT_BYTES = 8 << 20
#: Hashes a task adds up before it hands them on, and those of a bucket, about.
HASHES_AT_ONCE, HASHES_A_BUCKET = 1 << 22, 1 << 20
#: Rows of counted phrases a task adds up before it hands them on.
PHRASES_AT_ONCE = 1 << 21
COUNTED = ["place", "lang", "phrase", "n"]
#: Bits of a filter as a power of two: 8 for each phrase that can be frequent, within these bounds.
LEAST_BITS, MOST_BITS = 16, 30
#: Phrases of a range of the sorted stream, about.
PHRASES_A_RANGE = 20_000
MOST_RANGES = 4096

IS_PIECE_END = np.zeros(256, bool)
IS_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IS_BREAK = IS_PIECE_END.copy()
IS_BREAK[[0x20, 0x09]] = True


def _cut(rows: pa.RecordBatch, buf: np.ndarray, bounds: np.ndarray):
    """(starts, ends, words before each row, hashes, whether a word follows the one before it in one piece)."""
    starts, ends, per_row = words(buf, bounds, IS_BREAK)
    follows = np.zeros(len(starts), bool)
    if len(starts) > 1:
        ended = np.cumsum(IS_PIECE_END[buf], dtype=np.int32)[starts]
        follows[1:] = ended[1:] == ended[:-1]
        first = per_row[:-1]
        follows[first[first < len(starts)]] = False
    return starts, ends, per_row, run_hashes(buf, starts, ends), follows


def _short(h: np.ndarray) -> np.ndarray:
    """32 bits of a word's hash, 0 for none."""
    return np.maximum(h >> U(32), U(1)).astype(np.uint32)


def _streams(batches: Iterator[pa.RecordBatch]):
    """(rows, text, starts, ends, hashes, words before each row, place of each word in the stream, words of the stream, languages).

    A stream has the short hash of each word of some texts, pieces apart by a 0, and at each word its language's hash.
    """
    for rows, buf, bounds in pieces(batches, "text", TEXT_BYTES):
        buf = LOWER[buf]
        starts, ends, per_row, h, follows = _cut(rows, buf, bounds)
        if not len(starts):
            continue
        place = np.arange(len(starts)) + np.cumsum(~follows)
        short, lang = np.zeros(place[-1] + 1, np.uint32), np.zeros(place[-1] + 1, U)
        short[place] = _short(h)
        lang[place] = np.repeat(rows.column("lang_hash").to_numpy().view(U), np.diff(per_row))
        yield rows, buf, starts, ends, h, per_row, place, short, lang


class Filter:
    """Bits of the hashes of phrases of one order that may be frequent."""

    def __init__(self, bits: int):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), U)

    def set(self, word: np.ndarray, bits: np.ndarray) -> None:
        np.bitwise_or.at(self.words, word, bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> U(64 - self.bits)
        return (self.words[at >> U(6)] >> (at & U(63))) & U(1) != 0


def _passed(first: np.ndarray, short: np.ndarray, filters: list[Filter]) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the phrases one word longer than the last filter's, both of whose shorter phrases pass all filters.

    `first` has the language's hash at each word of a stream, `short` the words' hashes.
    """
    at = np.flatnonzero(short)
    h = mixed(first[at] + short[at])
    for order, filter in enumerate(filters, 1):
        fits = filter.has(h)
        at, h = at[fits], h[fits]
        if not len(at):
            break
        goes_on = np.flatnonzero(at[1:] == at[:-1] + 1)  # the phrase one word further on passes as well
        at, h = at[goes_on], h[goes_on]
        h = mixed(h + short[at + order])
    return at, h


def pack_counts(h: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending hashes of up to 48 bits and counts of 16, as the differences of the hashes: first all low bytes, then the second ones and so on."""
    step = np.diff(h, prepend=U(0)) << U(16) | n.astype(U)
    planes = step.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    step = np.ascontiguousarray(planes.T).reshape(-1).view("<u8")
    return np.cumsum(step >> U(16), dtype=U), (step & U(0xFFFF)).astype(np.int64)


def _hash_counts(batches: Iterator[pa.RecordBatch], filters, buckets: int, width: int):
    """(bucket, entries): the first bits of the hash of each phrase of the next order and its count in the task, capped at 16 bits."""
    release()
    held, size = [], 0

    def added():
        h, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
        return h[first], np.add.reduceat(n, first) if len(first) else n

    def packed():
        h, n = added()
        h, n = h >> U(64 - width), np.minimum(n, 0xFFFF)  # hashes that differ in later bits alone are added up later
        bucket = ((h >> U(width - 32)) * U(buckets) >> U(32)).astype(np.int32)  # ascending, as h is
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = [*first[1:].tolist(), len(h)]
        parts = [pack_counts(h[a:b], n[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(parts, pa.binary())], names=["bucket", "entries"])

    for *_, short, lang in _streams(batches):
        _, h = _passed(lang, short, filters)
        h, n = np.unique(h, return_counts=True)
        if len(h):
            held.append((h, n))
            size += len(h)
        if size > HASHES_AT_ONCE:
            held = [added()]
            size = len(held[0][0])
            if size > HASHES_AT_ONCE // 2:
                yield packed()
                held, size = [], 0
    if held:
        yield packed()


def _frequent_bits(batches: Iterator[pa.RecordBatch], least: int, bits: int, width: int):
    """Rows sorted by bucket: (word, bits) of the filter for hashes whose counts add up to the least."""

    def found(held):
        h, n = (np.concatenate(x) for x in zip(*map(unpack_counts, held), strict=True))
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        at = h[first][np.add.reduceat(n, first) >= least] >> U(width - bits)
        word = (at >> U(6)).astype(np.int32)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        value = np.bitwise_or.reduceat(U(1) << (at & U(63)), first) if len(first) else np.zeros(0, U)
        return pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(value.view(np.int64))], names=["word", "bits"])

    for held in _by_bucket(batches, "entries"):
        yield found(held)


def _phrases(batches: Iterator[pa.RecordBatch], filters):
    """(place, lang, phrase, n): the phrases of all orders that pass the filters, told apart by 64 bits within a batch; null for all words.

    The place, 32 bits, depends on the first two words, so that phrases with a common beginning stay together.
    """
    release()
    for rows, buf, starts, ends, h, per_row, place, short, first in _streams(batches):
        langs = rows.column("lang").dictionary_encode()
        code = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(per_row))
        total = np.bincount(code, minlength=len(langs.dictionary))
        yield pa.Table.from_arrays([pa.array(np.zeros(len(total), np.uint32)), langs.dictionary, pa.nulls(len(total), pa.string()), pa.array(total)], names=COUNTED)
        lang = first[place]
        word = np.zeros(len(short), np.int64)
        word[place] = np.arange(len(starts))
        spaced, blank = np.append(buf, np.uint8(0x20)), len(buf)
        for order in range(1, len(filters) + 1):
            at, name = _passed(first, short, filters[: order - 1])
            at = word[at[filters[order - 1].has(name)]]
            if not len(at):
                break
            key = lang[at]
            for j in range(order):
                key = mixed(key + h[at + j])
                beginning = key if j < 2 else beginning
            _, one, n = np.unique(key, return_index=True, return_counts=True)
            at, beginning = at[one], (beginning[one] >> U(32)).astype(np.uint32)
            # the words of each phrase with a space between
            run, size = (np.full((len(at), 2 * order - 1), v, np.int64) for v in (blank, 1))
            for j in range(order):
                run[:, 2 * j], size[:, 2 * j] = starts[at + j], ends[at + j] - starts[at + j]
            data = _runs(spaced, run.reshape(-1), size.reshape(-1))
            offsets = np.concatenate([[0], np.cumsum(size.sum(axis=1))])
            phrase = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data.tobytes())).cast(pa.string())
            yield pa.Table.from_arrays([pa.array(beginning), langs.dictionary.take(pa.array(code[at])), phrase, pa.array(n)], names=COUNTED)


def _added(tables: list[pa.Table]) -> pa.Table:
    """Counts of equal phrases added up."""
    return pa.concat_tables(tables).group_by(COUNTED[:3]).aggregate([("n", "sum")]).rename_columns(COUNTED)


def _phrase_counts(batches: Iterator[pa.RecordBatch], filters, buckets: int):
    """(bucket, counts): the task's phrases with their counts, sorted, so that they compress well."""

    def packed(table):
        table = table.sort_by([(c, "ascending") for c in COUNTED[:3]])
        bucket = (table["place"].to_numpy().astype(np.int64) * buckets) >> 32
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        parts = []
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.slice(a, b - a).combine_chunks())
            parts.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array(parts, pa.binary())], names=["bucket", "counts"])

    held, size = [], 0
    for table in _phrases(batches, filters):
        held.append(table)
        size += len(table)
        if size > PHRASES_AT_ONCE:
            held = [_added(held)]
            size = len(held[0])
            if size > PHRASES_AT_ONCE // 2:
                yield packed(held[0])
                held, size = [], 0
    if held:
        yield packed(_added(held))


def _by_bucket(batches: Iterator[pa.RecordBatch], column: str):
    """Of rows sorted by bucket the values of each bucket."""
    now, held = None, []
    for rows in batches:
        for bucket, value in zip(rows.column("bucket").to_pylist(), rows.column(column).to_pylist(), strict=True):
            if bucket != now and held:
                yield held
                held = []
            now = bucket
            held.append(value)
    if held:
        yield held


def _frequent(batches: Iterator[pa.RecordBatch], least: int):
    """Rows sorted by bucket: (lang, phrase, f) of phrases with f >= least, and of the null phrases."""
    for held in _by_bucket(batches, "counts"):
        found = _added([pa.ipc.open_stream(x).read_all() for x in held])
        found = found.filter((pc.field("n") >= least) | pc.field("phrase").is_null())
        yield from found.drop_columns("place").rename_columns(["lang", "phrase", "f"]).to_batches()


def _ranges(phrases: DataFrame, key: Column, rows: int) -> list[tuple]:
    """Cut points of the sorted stream, from a sample: they steer the load only."""
    ranges = min(MOST_RANGES, -(-rows // PHRASES_A_RANGE))
    if ranges < 2:
        return []
    taken = phrases.sample(min(1.0, 64 * ranges / rows), 1).select("lang", key.alias("key")).collect()
    taken = sorted((r["lang"], *r["key"]) for r in taken)
    return sorted({taken[i * len(taken) // ranges] for i in range(1, ranges)}) if taken else []


STREAM = "part int, home boolean, lang string, key array<string>, f long, chain array<long>, other array<long>, inside boolean"


def _dealt(batches: Iterator[pa.RecordBatch], cuts: list[tuple]):
    """Each phrase in its range, and in later ranges that begin among its extensions."""
    for batch in batches:
        out = []
        for lang, key, f, other, inside in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "f", "other", "inside")), strict=True):
            whole = (lang, *key)
            part = bisect_right(cuts, whole)
            out.append((part, True, lang, key, f, [], other, inside))
            while part < len(cuts) and cuts[part][: len(whole)] == whole:
                part += 1
                out.append((part, False, lang, key, f, [], other, inside))
        yield _stream_batch(out)


_KINDS = [pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_()]


def _stream_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_KINDS)
    names = [c.split()[0] for c in STREAM.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=names)


def _lockstep(batches: Iterator[pa.RecordBatch], percent: int):
    """Ranges sorted by words: every phrase gets the counts of its beginnings, and learns whether an extension holds nearly all of it.

    What is held is one phrase of each order, those the current one extends.
    """
    path: list[list] = []
    for batch in batches:
        out = []
        for row in zip(*batch.to_pydict().values(), strict=True):
            part, _, lang, key, f, _, _, _ = row
            while path and not (path[-1][0] == part and path[-1][2] == lang and key[: len(path[-1][3])] == path[-1][3]):
                out.append(tuple(path.pop()))
            row = list(row)
            if path:
                above = path[-1]
                row[5] = [*above[5], above[4]]
                above[7] = above[7] or 100 * f >= percent * above[4]
            path.append(row)
        yield _stream_batch(out)
    yield _stream_batch([tuple(row) for row in path])


def _extended(phrases: DataFrame, cuts: list[tuple], percent: int) -> DataFrame:
    """(lang, key, f, chain, other, inside) of phrases (lang, key, f, other, inside), after one pass in the order of their keys."""
    dealt = phrases.mapInArrow(lambda it: _dealt(it, cuts), STREAM)
    ordered = dealt.repartition(len(cuts) + 1, "part").sortWithinPartitions("part", "lang", "key")
    found = ordered.mapInArrow(lambda it: _lockstep(it, percent), STREAM)
    once = found.groupBy("lang", "key").agg(*[F.first(c).alias(c) for c in ("f", "chain", "other")], F.max("inside").alias("inside"))
    return once.select("lang", "key", "f", "chain", "other", "inside")


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """((lang, words, f) of all phrases of up to four words with f >= least, (lang, n) with the words of each language)."""
    if not 1 <= least < 1 << 16:
        raise ValueError("least is from 1 to 65535")
    lang = F.coalesce("lang", F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), "text")
    # about six bytes to a word: this sizes filters and buckets only
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 6
    bits = min(MOST_BITS, max(LEAST_BITS, (8 * total // least).bit_length()))
    width = max(36, min(48, bits + 14))  # so that hardly two phrases agree in them
    buckets = max(64, total // HASHES_A_BUCKET)
    context, filters = docs.sparkSession.sparkContext, []
    for _ in range(ORDERS):
        sent = context.broadcast(filters)
        counts = texts.mapInArrow(lambda it, sent=sent: _hash_counts(it, sent.value, buckets, width), "bucket int, entries binary")
        counts = counts.repartition("bucket").sortWithinPartitions("bucket")
        found = counts.mapInArrow(lambda it: _frequent_bits(it, least, bits, width), "word int, bits long").toArrow()  # a row for each 64 bits at most, and a bucket
        filter = Filter(bits)
        filter.set(found["word"].to_numpy(), found["bits"].to_numpy().view(U))
        filters = [*filters, filter]
    sent = context.broadcast(filters)
    counted = texts.mapInArrow(lambda it: _phrase_counts(it, sent.value, buckets), "bucket int, counts binary")
    counted = counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _frequent(it, least), "lang string, phrase string, f long")
    # the words of all texts of a language are counted under a null phrase
    counted = written(counted.select("lang", F.split("phrase", " ").alias("words"), "f"), "phrases")
    return counted.where("words is not null"), counted.where("words is null").select("lang", F.col("f").alias("n"))


def lowest_cuts(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases (lang, key: words from last to first, f, other: counts of beginnings, chain: of ends).

    Counts are added and multiplied as decimals.
    """
    words, left, right = F.size("key").alias("words"), F.col("other").alias("left"), F.col("chain").alias("right")
    several = phrases.select("lang", F.array_join(F.reverse("key"), " ").alias("phrase"), words, F.col("f").alias("a"), left, right)
    cuts = """transform(sequence(1, words - 1), k -> named_struct(
        'score', cast(a as decimal(20, 0)) * 2000000 div (cast(left[k - 1] as decimal(20, 0)) + right[words - k - 1]),
        'k', k, 'l', left[k - 1], 'r', right[words - k - 1]))"""
    return several.withColumn("cut", F.array_min(F.expr(cuts))).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = 30, percent: int = 80, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` collocations of each language of `docs` (text, lang, other columns).

    Null texts are empty, a null language is `und`; rows given twice count twice. Phrases are contiguous words of one piece.
    Equal scores go by count, then by phrase. Languages without a phrase of two words that often have no rows.
    """
    phrases, sizes = frequent_phrases(docs, least)
    rows = phrases.count()
    none = F.array().cast("array<long>")
    forward = phrases.select("lang", F.col("words").alias("key"), "f", none.alias("other"), F.lit(False).alias("inside"))
    left = written(_extended(forward, _ranges(phrases, F.col("words"), rows), percent), "left")
    backward = left.select("lang", F.reverse("key").alias("key"), "f", F.col("chain").alias("other"), "inside")
    both = _extended(backward, _ranges(phrases, F.reverse("words"), rows), percent)
    scored = lowest_cuts(both.where("size(key) > 1 and not inside"))
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
