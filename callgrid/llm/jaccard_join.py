"""Near-duplicate texts by exact set similarity join: universe partition and pigeonhole.

The universe of shingles is cut into m segments. Two sets whose Jaccard similarity reaches the threshold differ in at
most H shingles, H from their sizes. Give each segment a share, 1 or 2, with a sum over H: then in some segment the
sets differ in fewer shingles than its share, so they are equal there (share 1), or differ in one shingle at most (share 2)
and meet in the one-deletion neighbourhood of that segment. All sets are indexed by those segment signatures, per size
band. What meets is verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .graph import components
from .tables import KeyFilter, small_batches, written
from .textbytes import LOWER, U, mixed, pieces, run_hashes, shingles, words
from .tokens import release

SET_SCHEMA = "doc_id long, n long, h1 long, h2 long"
ENTRIES_AT_ONCE = 1 << 18
DOCS_A_BUCKET = 2000


class Scheme:
    """Which size bands a set is indexed under, and with which segments. Equal for all sets, whatever their number.

    Any partition of the universe will do. Here all frequent shingles, those of passages that many documents share, are one
    segment that is not indexed; the others are cut by hash into H + 1 segments and some to spare. A set in which no more
    than the spare ones are empty meets any set linked with it in a segment of rare shingles. Sets with more empty
    segments than that are indexed a second time, by a partition that knows no frequent shingles and with all its
    segments: two such sets meet there.

    `frequent` (sorted hashes) and `expected` documents steer the cost only. In the second partition a row costs 1, a chance
    meeting as well; as those become many, pairs of segments are joined into one of share 2.
    """

    def __init__(self, percent: int, expected: int, frequent: np.ndarray | None = None):
        self.percent, self.expected = percent, expected
        self.frequent = np.zeros(0, U) if frequent is None else frequent
        self.lows = [1]

    def band(self, n: int) -> int:
        while self.lows[-1] <= n:
            low = self.lows[-1]
            self.lows.append(max(low + 1, low * 100 // self.percent))
        return int(np.searchsorted(self.lows, n, "right")) - 1

    def bands(self, n: int) -> range:
        """Bands of the larger set of any pair that a set of n shingles may be in as either side."""
        return range(self.band(n), self.band(n * 100 // self.percent) + 1)

    def differ(self, band: int) -> int:
        """H: shingles in which two linked sets differ at most, the larger being of this band."""
        while len(self.lows) < band + 2:
            self.band(self.lows[-1])
        return (100 - self.percent) * 2 * (self.lows[band + 1] - 1) // (100 + self.percent)

    @lru_cache(maxsize=None)  # noqa: B019
    def rare_segments(self, band: int, rare_share: float = 0.85) -> int:
        """How many segments rare shingles are cut into; 0 if sets of this band are too small for spare ones."""
        differ = self.differ(band)
        least = self.lows[band] * rare_share
        for spare in range(2, differ):
            m = differ + 1 + spare
            empty = m * math.exp(-least / m)
            if spare >= empty + 3 * math.sqrt(empty):
                return m
        return 0

    @lru_cache(maxsize=None)  # noqa: B019
    def allocation(self, band: int) -> tuple[int, int]:
        """Of the second partition (segments, how many of them have share 2) at the lowest cost."""
        differ = self.differ(band)
        high = self.lows[band + 1] - 1

        def cost(double: int) -> float:
            m = differ + 1 - double
            s = high / m
            chance = math.exp(-2 * s) * self.expected * 0.02
            return (m - double) * (1 + chance) + double * (1 + s) * (1 + chance * (1 + s))

        double = min(range((differ + 1) // 2 + 1), key=cost)
        return differ + 1 - double, double

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        """Of a sorted set of hashes: segments are runs of it."""
        rare = tokens
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, tokens), len(self.frequent) - 1)
            rare = tokens[self.frequent[at] != tokens]
        out, sums, all_sums = [], _sums(rare), None
        for band in self.bands(len(tokens)):
            m = self.rare_segments(band)
            if m:
                names, full, _, _ = _segments(rare, sums, m, (band << 32) | (1 << 31))
                out.append(names[full])
                if m - full.sum() <= m - self.differ(band) - 1:
                    continue
            all_sums = _sums(tokens) if all_sums is None else all_sums
            m, double = self.allocation(band)
            names, _, at, salt = _segments(tokens, all_sums, m, band << 32)
            out.append(names)
            for j in range(double):
                less = all_sums[at[j] + 1 : at[j + 1] + 1] - all_sums[at[j] : at[j + 1]]
                with np.errstate(over="ignore"):
                    out.append(mixed((all_sums[at[j + 1]] - all_sums[at[j]] - less) ^ salt[j]))
        return np.unique(np.concatenate(out))


def _sums(tokens: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, U), np.cumsum(mixed(tokens), dtype=U)])


def _segments(tokens: np.ndarray, sums: np.ndarray, m: int, tag: int):
    """(names, whether not empty, bounds, salts) of m segments of a sorted set."""
    at = np.empty(m + 1, np.int64)
    at[0], at[m] = 0, len(tokens)
    at[1:m] = np.searchsorted(tokens, (np.arange(1, m) * ((1 << 64) / m)).astype(U))
    salt = mixed(np.arange(m, dtype=U) + U(tag))
    return mixed((sums[at[1:]] - sums[at[:-1]]) ^ salt), at[1:] > at[:-1], at, salt


def _sets(batches, text: str, k: int):
    """(rows, one sorted array of distinct shingle hashes for each row)."""
    release()
    for rows, buf, bounds in pieces(batches, text):
        buf = LOWER[buf]
        starts, ends, per_row = words(buf, bounds)
        found, cut = shingles(run_hashes(buf, starts, ends), per_row, k)
        yield rows, [np.unique(found[cut[i] : cut[i + 1]]) for i in range(rows.num_rows)]


def _names(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit names of a set."""
    n = U(len(tokens))
    pair = np.array([np.sum(mixed(tokens), dtype=U) + n, np.sum(mixed(tokens ^ U(0x5851F42D4C957F2D)), dtype=U) ^ n])
    return tuple(mixed(pair).view(np.int64).tolist())


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """Per document the size and the name of its set."""

    def run(batches: Iterator[pa.RecordBatch]):
        for rows, sets in _sets(batches, "text", k):
            names = [_names(s) if len(s) else (0, 0) for s in sets]
            values = ([len(s) for s in sets], [x[0] for x in names], [x[1] for x in names])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(v, pa.int64()) for v in values)], names=["doc_id", "n", "h1", "h2"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SET_SCHEMA)


def with_set_names(docs: DataFrame, k: int) -> DataFrame:
    """The rows of `docs` (text, any other columns) with the size and the name of their sets: n_shingles, h1, h2."""

    def run(batches: Iterator[pa.RecordBatch]):
        for rows, sets in _sets(batches, "text", k):
            names = [_names(s) if len(s) else (0, 0) for s in sets]
            values = ([len(s) for s in sets], [x[0] for x in names], [x[1] for x in names])
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *(pa.array(v, pa.int64()) for v in values)], names=[*rows.schema.names, "n_shingles", "h1", "h2"]
            )

    schema = docs.schema
    for name in ("n_shingles", "h1", "h2"):
        schema = StructType([*schema, StructField(name, LongType())])
    return docs.mapInArrow(run, schema)


def _packed(node: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """Twelve bytes for each entry: 48 bits of the signature, 48 of the set's name. Chance meetings are verified away."""
    parts = [(x >> U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6] for x in (sig, node)]
    return np.concatenate(parts, axis=1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    entries = np.frombuffer(data, np.uint8).reshape(-1, 2, 6)
    wide = np.zeros((len(entries), 2, 8), np.uint8)
    wide[:, :, :6] = entries
    wide = wide.view("<u8")[:, :, 0]
    return wide[:, 1], wide[:, 0]


def frequent_shingles(docs: DataFrame, k: int, expected: int, sample: int, least: int = 3, most: int = 1 << 20) -> np.ndarray:
    """Sorted hashes of shingles in at least `least` different sets among about `sample` documents, chosen by doc_id.

    No more than `most`, the most frequent ones, reach the driver. They steer the load of the join, not its result.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for _, sets in _sets(batches, "text", k):
            kept = [s for s in sets if len(s)]
            at = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            tokens = pa.array(np.concatenate(kept).view(np.int64) if kept else np.zeros(0, np.int64))
            names = pa.array([_names(s)[0] for s in kept], pa.int64())
            yield pa.RecordBatch.from_arrays([names, pa.ListArray.from_arrays(at, tokens)], names=["h1", "tokens"])

    share = min(1 << 20, (sample << 20) // max(expected, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < share).select("text")
    sets = chosen.mapInArrow(run, "h1 long, tokens array<long>").dropDuplicates(["h1"])
    counts = sets.select(F.explode("tokens").alias("h")).groupBy("h").count().where(F.col("count") >= least)
    with small_batches(docs.sparkSession):
        rows = counts.orderBy(F.desc("count"), "h").limit(most).select("h").toPandas()
    return np.sort(rows["h"].to_numpy(np.int64).view(U))


def index_entries(docs: DataFrame, k: int, scheme: Scheme, buckets: int) -> DataFrame:
    """(bucket, entries): each set's signatures, packed. A task gives equal sets once."""
    percent, expected, frequent = scheme.percent, scheme.expected, scheme.frequent

    def run(batches: Iterator[pa.RecordBatch]):
        scheme, seen, nodes, sigs, size = Scheme(percent, expected, frequent), set(), [], [], 0

        def flushed():
            sig, node = np.concatenate(sigs), np.repeat(np.array(nodes, np.int64).view(U), [len(s) for s in sigs])
            bucket = ((sig >> U(32)) * U(buckets) >> U(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            entries, found = _packed(node[order], sig[order]), bucket[order]
            first = np.flatnonzero(np.diff(found, prepend=-1))
            ends = np.append(first[1:], len(found))
            data = [entries[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(found[first]), pa.array(data, pa.binary())], names=["bucket", "entries"])

        for _, sets in _sets(batches, "text", k):
            for s in sets:
                name = _names(s)[0] if len(s) else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                nodes.append(name)
                sigs.append(scheme.signatures(s))
                size += len(sigs[-1])
            if size > ENTRIES_AT_ONCE:
                yield flushed()
                nodes, sigs, size = [], [], 0
        if sigs:
            yield flushed()

    return docs.select("text").mapInArrow(run, "bucket int, entries binary")


def _meetings(batches: Iterator[pa.RecordBatch]):
    """Rows sorted by bucket: sets that share a signature, each linked with the lowest of them."""
    now, held = None, []

    def found():
        node, sig = _unpacked(b"".join(held))
        order = np.lexsort((node, sig))
        node, sig = node[order], sig[order]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        low = node[first][np.repeat(np.arange(len(first)), np.diff(np.append(first, len(sig))))]
        links = np.unique(np.stack([node, low], axis=1)[node != low], axis=0).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    for rows in batches:
        for bucket, entries in zip(rows.column("bucket").to_pylist(), rows.column("entries").to_pylist(), strict=True):
            if bucket != now and held:
                yield found()
                held = []
            now = bucket
            held.append(entries)
    if held:
        yield found()


def linked_pairs(sets: list[np.ndarray], percent: int, width: int = 8192) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, for all pairs of a block: shared tokens as a matrix product."""
    n = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), n)
    _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    keep = count[column] > 1
    row, column = row[keep], np.cumsum(count > 1)[column[keep]] - 1
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(sets), width), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        both += part @ part.T
    return 100 * both >= percent * (n[:, None] + n[None, :] - both)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For each row the first row that links reach."""
    roots = np.arange(len(linked))
    while True:
        new = np.where(linked, roots[None, :], len(roots)).min(axis=1)
        new = np.minimum(new, roots)[np.minimum(new, roots)]
        if (new == roots).all():
            return roots
        roots = new


def _parities(sets: list[np.ndarray], width: int) -> np.ndarray:
    """A row of signs for each set: whether the number of its tokens in each of `width` classes is even."""
    row = np.repeat(np.arange(len(sets)) * width, [len(s) for s in sets])
    place = (np.concatenate(sets) & U(width - 1)).astype(np.int64)
    odd = np.bincount(row + place, minlength=len(sets) * width) & 1
    return (1 - 2 * odd).astype(np.float32).reshape(len(sets), width)


def links_across(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Rows (i, j) of links that hold together what links between `a` and `b` hold together; `b` is numbered on from `a`.

    Two sets differ in at least as many tokens as classes in which their parities differ. Few pairs are left by that; sets
    with many of them are compared all with all.
    """
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    width = 1 << min(13, max(7, int(max(na.max(), nb.max()) - 1).bit_length()))
    differ = (width - (_parities(a, width) @ _parities(b, width).T).astype(np.int64)) // 2
    at = np.argwhere(differ * (100 + percent) <= (na[:, None] + nb[None, :]) * (100 - percent))
    i, j = np.unique(at[:, 0]), np.unique(at[:, 1])
    if len(at) <= 4 * (len(i) + len(j)):
        both = np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in at.tolist()], np.int64)
        return at[100 * both >= percent * (na[at[:, 0]] + nb[at[:, 1]] - both)] + [0, len(a)]
    roots = local_roots(linked_pairs([*(a[x] for x in i), *(b[y] for y in j)], percent))
    ids = np.concatenate([i, j + len(a)])
    return np.stack([ids, ids[roots]], axis=1)[roots != np.arange(len(roots))]


def spanning_links(a: list[np.ndarray], b: list[np.ndarray] | None, percent: int, step: int = 512) -> list[tuple[int, int]]:
    """(i, root of i) for what links between `a` and `b`, numbered on from `a`, hold together; b None: links within `a`."""
    sets = a if b is None else a + b
    n = np.array([len(s) for s in sets])
    rows = np.argsort(n[: len(a)], kind="stable")
    columns = rows if b is None else len(a) + np.argsort(n[len(a) :], kind="stable")
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for low in range(0, len(rows), step):
        p = rows[low : low + step]
        for at in range(low if b is None else 0, len(columns), step):
            q = columns[at : at + step]
            if 100 * n[p[-1]] < percent * n[q[0]] or 100 * n[q[-1]] < percent * n[p[0]]:
                continue
            ids = np.concatenate([p, q])
            for x, y in ids[links_across([sets[x] for x in p], [sets[x] for x in q], percent)].tolist():
                x, y = find(x), find(y)
                parent[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in range(len(sets)) if parent[x] != x]


def _verified(batches: Iterator[pa.RecordBatch], percent: int):
    """Rows sorted by (family, b1, b2): for each such block pair the spanning links between its blocks."""
    key, held = None, []

    def flush():
        if len(held) > 1:
            _, b1, b2 = key
            held.sort(key=lambda x: x[0])
            sets = [np.frombuffer(x[3], U) for x in held]
            m = sum(x[0] == b1 for x in held)
            for i, root in spanning_links(sets[:m], None if b1 == b2 else sets[m:], percent):
                yield (*held[i][1:3], *held[root][1:3])

    def batch(links):
        columns = list(zip(*links, strict=True)) if links else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a1", "a2", "b1", "b2"])

    for rows in batches:
        out = []
        for family, b1, b2, block, h1, h2, tokens in zip(*(rows.column(i).to_pylist() for i in range(7)), strict=True):
            if (family, b1, b2) != key:
                out += flush()
                key, held = (family, b1, b2), []
            if not held or held[-1][1:3] != (h1, h2):
                held.append((block, h1, h2, tokens))
        yield batch(out)
    yield batch(list(flush()))


def jaccard_components(
    docs: DataFrame, k: int = 3, percent: int = 90, block_tokens: int = 1 << 20, sample: int = 8000
) -> DataFrame:
    """(doc_id, n_shingles, component_id, h1, h2) for each row of `docs` (doc_id, text, any other columns).

    A set holds the distinct k-word shingles of the text, A-Z lower-cased; fewer words make one shingle. Null and
    blank texts have the empty set, link with nothing and keep their own doc_id. Rows with equal sets are one class,
    whatever their number; repeated doc_ids are rows like others. component_id is the smallest doc_id in reach (null
    only if all are null). Sets are told apart by 128 bits of hashes, shingles by 64.

    Which shingles are frequent is seen from about `sample` documents; that steers the load only.
    Classes that meet in a signature form candidate families. Each family is cut, by size of set, into blocks of
    `block_tokens` shingles, or a sixteenth of the family where that is more (up to eight times as much), so that a set goes
    to few tasks; only block pairs whose sizes can match are compared, each in a task of its own.
    """
    docs = docs.select("doc_id", "text")
    table = written(shingle_sets(docs, k), "sets")
    expected = table.count()
    buckets = max(64, expected // DOCS_A_BUCKET)
    scheme = Scheme(percent, expected, frequent_shingles(docs, k, expected, sample))
    entries = index_entries(docs, k, scheme, buckets).repartition("bucket").sortWithinPartitions("bucket")
    family = components(entries.mapInArrow(_meetings, "a long, b long"))
    family = family.select(F.col("node").alias("short"), F.col("root").alias("family"))

    classes = table.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
    weight = F.greatest("n", F.lit(256))
    before = F.sum(weight).over(Window.partitionBy("family").orderBy("n", "h1", "h2"))
    whole = F.sum(weight).over(Window.partitionBy("family"))
    size = F.greatest(F.lit(block_tokens), F.least(whole / 16, F.lit(8 * block_tokens)))
    members = written(
        classes.withColumn("short", F.shiftrightunsigned("h1", 16)).join(family, "short").withColumn("block", F.floor((before - 1) / size).cast("int")), "members"
    )
    ends = members.groupBy("family", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    other = ends.select("family", F.col("block").alias("b2"), F.col("lo").alias("lo2"))
    pairs = (
        ends.withColumnRenamed("block", "b1")
        .join(other, "family")
        .where(f"b1 <= b2 and 100 * hi >= {percent} * lo2")
        .select("family", "b1", "b2")
    )
    sides = pairs.select("family", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("block"), "b1", "b2")
    sides = sides.groupBy("family", "block").agg(F.collect_list(F.struct("b1", "b2")).alias("pairs"))

    def fetched(batches):
        for rows, sets in _sets(batches, "text", k):
            names = [_names(s) if len(s) else (0, 0) for s in sets]
            at = [i for i, x in enumerate(zip(rows["h1"].to_pylist(), rows["h2"].to_pylist(), strict=True)) if x == names[i]]
            kept = rows.select(["family", "block", "pairs", "h1", "h2"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([sets[i].tobytes() for i in at], pa.binary())],
                names=["family", "block", "pairs", "h1", "h2", "tokens"],
            )

    wanted = members.join(sides, ["family", "block"]).select(F.col("first").alias("first_id"), "family", "block", "pairs", "h1", "h2")
    # texts of no family stay where they are, the others move once: the same plan at every size
    near, _ = KeyFilter(members.select("first")).split(docs, "doc_id")
    texts = near.join(wanted.hint("merge"), near["doc_id"].cast("long").eqNullSafe(F.col("first_id")))
    sets = texts.select("family", "block", "pairs", "h1", "h2", "text").mapInArrow(
        fetched, "family long, block int, pairs array<struct<b1:int,b2:int>>, h1 long, h2 long, tokens binary"
    )
    grouped = (
        sets.select("family", "block", F.explode("pairs").alias("pair"), "h1", "h2", "tokens")
        .select("family", "pair.b1", "pair.b2", "block", "h1", "h2", "tokens")
        .repartition("family", "b1", "b2")
        .sortWithinPartitions("family", "b1", "b2", "h1", "h2")
    )
    links = grouped.mapInArrow(lambda it: _verified(it, percent), "a1 long, a2 long, b1 long, b2 long")
    found = components(links.select(F.struct(F.col("a1").alias("h1"), F.col("a2").alias("h2")).alias("a"), F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2")).alias("b")))
    found = found.select("node.h1", "node.h2", "root")
    rooted = classes.join(found, ["h1", "h2"], "left").withColumn("root", F.coalesce("root", F.struct("h1", "h2")))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = rooted.join(lowest, "root").select("h1", "h2", "component_id")
    linked = table.where("n > 0").select("doc_id", "n", "h1", "h2").join(ids, ["h1", "h2"])
    alone = table.where("n = 0").select("h1", "h2", "doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "h1", "h2")
