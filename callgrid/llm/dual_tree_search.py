"""Ranked lexical search by two trees: exact best documents for every item of a query set.

Texts are counted once into a table of sparse vectors, over the terms that items have. A task builds trees over the
documents it reads: documents with the same strongest term lie side by side, and every node holds the largest
contribution of each term below it. The items have such a tree as well, over their terms' weights. For a pair of nodes the sum
over their common terms of largest weight times largest contribution bounds every score below; a pair whose bound stays
under the weakest of the k best scores of all its items is dropped with all documents and items below it. Pairs of leaves that are
left are scored exactly.

Items come in blocks of bounded size; each block is held against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .tables import written
from .textbytes import LOWER, pieces, run_hashes, words
from .tokens import _runs, release

#: Bytes of item texts in a block, and items.
BLOCK_BYTES, BLOCK_ITEMS = 4 << 20, 4096
#: Documents below a node of each level of the document tree, the root first; items below an item node.
DOC_LEVELS, ITEM_NODE = (8192, 256, 16), 8
#: Postings of a tree, about; its documents are read so many at a time.
TREE_POSTINGS, DOCS_AT_ONCE = 1 << 20, 512
#: Cells of a table of scores or bounds held at once, and products.
CELLS = 1 << 22
#: Sums of doubles are exact up to this; larger ones are added as 64-bit integers.
EXACT = 1 << 53
NO_ID = -(1 << 63)

# Terms are runs of ASCII letters and digits and of everything beyond ASCII.
IS_BREAK = np.ones(256, bool)
IS_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Terms:
    """The distinct terms of a block of items, each with a number."""

    def __init__(self, texts: list[bytes]):
        distinct = sorted(set(texts))
        self.size = np.array([len(t) for t in distinct], np.int64)
        self.bytes = np.frombuffer(b"".join(distinct), np.uint8)
        self.start = np.cumsum(self.size) - self.size
        h = run_hashes(self.bytes, self.start, self.start + self.size)
        self.order = np.argsort(h)
        self.hashes = h[self.order]

    def __len__(self) -> int:
        return len(self.size)

    def numbers(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each run that is a term, -1 for others: found by hash, compared byte by byte."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self) or not len(starts):
            return out
        h = run_hashes(buf, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self) - 1)
        maybe = np.flatnonzero(self.hashes[at] == h)
        term = self.order[at[maybe]]
        size = self.size[term]
        same = size == ends[maybe] - starts[maybe]
        maybe, term, size = maybe[same], term[same], size[same]
        if len(maybe):
            equal = _runs(buf, starts[maybe], size) == _runs(self.bytes, self.start[term], size)
            whole = np.logical_and.reduceat(equal, np.cumsum(size) - size)
            out[maybe[whole]] = term[whole]
        return out


def _term_bytes(text: str | None) -> list[bytes]:
    """The distinct terms of one text."""
    buf = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = words(buf, np.array([0, len(buf)]), IS_BREAK)
    return sorted({buf[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)})


class Postings(NamedTuple):
    """Sorted by node: (node, term, value), and how many nodes there are."""

    node: np.ndarray
    term: np.ndarray
    value: np.ndarray
    nodes: int

    def maxima(self, fan: int) -> Postings:
        """One level up: of every `fan` nodes the largest value of each term."""
        node = self.node // fan
        order = np.lexsort((self.term, node))
        node, term, value = node[order], self.term[order], self.value[order]
        first = np.ones(len(node), bool)
        first[1:] = (node[1:] != node[:-1]) | (term[1:] != term[:-1])
        at = np.flatnonzero(first)
        top = np.maximum.reduceat(value, at) if len(at) else value
        return Postings(node[at], term[at], top, -(-self.nodes // fan))

    def of(self, wanted: np.ndarray) -> Postings:
        """The postings of some nodes (ascending), which are numbered anew."""
        cut = np.searchsorted(self.node, np.arange(self.nodes + 1))
        size = cut[wanted + 1] - cut[wanted]
        at = _runs(np.arange(len(self.node)), cut[wanted], size)
        return Postings(np.repeat(np.arange(len(wanted)), size), self.term[at], self.value[at], len(wanted))


class Side(NamedTuple):
    """A level of the item tree by term: the postings of term t are [cut[t], cut[t + 1])."""

    cut: np.ndarray
    node: np.ndarray
    weight: np.ndarray
    nodes: int
    exact: bool  # no sum of products can leave what doubles hold exactly

    @classmethod
    def by_term(cls, postings: Postings, terms: int, largest: int) -> Side:
        order = np.argsort(postings.term, kind="stable")
        cut = np.searchsorted(postings.term[order], np.arange(terms + 1))
        total = np.bincount(postings.node, weights=postings.value, minlength=max(1, postings.nodes)).max() * largest
        return cls(cut, postings.node[order], postings.value[order], postings.nodes, bool(total < EXACT))

    def sums(self, docs: Postings) -> np.ndarray:
        """For each document node and item node the sum over common terms of value times weight."""
        size = self.cut[docs.term + 1] - self.cut[docs.term]
        after = np.cumsum(size)
        out = np.zeros(docs.nodes * self.nodes, np.int64)
        at = 0
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(after, after[at] + CELLS)))
            begin, many = self.cut[docs.term[at:to]], size[at:to]
            cell = np.repeat(docs.node[at:to] * self.nodes, many) + _runs(self.node, begin, many)
            product = np.repeat(docs.value[at:to], many) * _runs(self.weight, begin, many)
            if self.exact and len(cell):
                low = docs.node[at] * self.nodes
                part = np.bincount(cell - low, weights=product)
                out[low : low + len(part)] += part.astype(np.int64)
            else:
                np.add.at(out, cell, product)
            at = to
        return out.reshape(docs.nodes, self.nodes)


class Items:
    """The items of a block: their terms, and, once the corpus is counted, their tree."""

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        found = [_term_bytes(t) for _, t in rows]
        self.terms = Terms([t for x in found for t in x])
        data = [t for x in found for t in x]
        ends = np.cumsum([len(t) for t in data], dtype=np.int64)
        buf = np.frombuffer(b"".join(data), np.uint8)
        self.term = self.terms.numbers(buf, ends - np.array([len(t) for t in data], np.int64), ends)
        self.item = np.repeat(np.arange(len(rows)), [len(x) for x in found])

    def weigh(self, having: dict[int, int], documents: int, length: int) -> None:
        """Weights of terms, and the tree: items with the same strongest term lie side by side."""
        self.documents, self.length = documents, length
        df = [having.get(t, 0) for t in range(len(self.terms))]
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df], np.int64)
        strongest = np.full(len(self.ids), -1, np.int64)
        order = np.lexsort((self.weight[self.term], self.item))
        strongest[self.item[order]] = self.term[order]  # the last one written has the largest weight
        self.order = np.argsort(strongest, kind="stable")
        place = np.empty(len(self.ids), np.int64)
        place[self.order] = np.arange(len(self.ids))
        node = place[self.item]
        order = np.lexsort((self.term, node))
        leaf = Postings(node[order], self.term[order], self.weight[self.term][order], len(self.ids))
        largest = 1_000_000  # no contribution is larger: 10^9 tf div (1000 tf + 8 m), m being 10 or more
        self.single, self.group = (Side.by_term(p, len(self.terms), largest) for p in (leaf, leaf.maxima(ITEM_NODE)))

    def contributions(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What a term adds for each unit of weight in a document of n terms that has it tf times."""
        m = 100 - 90 + (90 * n * self.documents) // max(1, self.length)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _vectors(batches: Iterator[pa.RecordBatch], terms: Terms):
    """(doc_id, n, terms, tfs) of each document, and a row with the counts of the task."""
    release()
    having, documents, length = np.zeros(len(terms), np.int64), 0, 0
    names = ["doc_id", "n", "terms", "tfs", "having", "documents", "length"]
    for rows, buf, bounds in pieces(batches, "text"):
        buf = LOWER[buf]
        starts, ends, per_row = words(buf, bounds, IS_BREAK)
        n, k = np.diff(per_row), rows.num_rows
        documents, length = documents + int((n > 0).sum()), length + int(n.sum())
        number = terms.numbers(buf, starts, ends)
        known = np.flatnonzero(number >= 0)
        row = np.repeat(np.arange(k), n)[known]
        key, tf = np.unique(row * max(1, len(terms)) + number[known], return_counts=True)
        term, row = key % max(1, len(terms)), key // max(1, len(terms))
        having += np.bincount(term, minlength=len(terms))
        cut = np.searchsorted(row, np.arange(k + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (term, tf)]
        none = [pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n), *lists, *none], names=names)
    empty = [pa.array([[]], pa.list_(pa.int32()))] * 2
    row = [pa.array([None], pa.int64()), pa.array([0], pa.int64()), *empty]
    row += [pa.array([having.tolist()], pa.list_(pa.int64())), pa.array([documents], pa.int64()), pa.array([length], pa.int64())]
    yield pa.RecordBatch.from_arrays(row, names=names)


VECTOR_SCHEMA = "doc_id long, n long, terms array<int>, tfs array<int>, having array<long>, documents long, length long"


class Tree:
    """Trees over the documents of some rows; `levels[0]` are the roots and the last level the documents."""

    def __init__(self, items: Items, doc_id: np.ndarray, n: np.ndarray, cut: np.ndarray, term: np.ndarray, tf: np.ndarray):
        doc = np.repeat(np.arange(len(doc_id)), np.diff(cut))
        value = items.contributions(tf, n[doc])
        # by strongest term, then id
        rank = np.lexsort((value * items.weight[term], doc))
        strongest = np.full(len(doc_id), -1, np.int64)
        strongest[doc[rank]] = term[rank]
        order = np.lexsort((doc_id, strongest))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.doc_id = doc_id[order]
        node = place[doc]
        order = np.lexsort((term, node))
        docs = Postings(node[order], term[order], value[order], len(doc_id))
        fans = [a // b for a, b in zip(DOC_LEVELS, (*DOC_LEVELS[1:], 1), strict=True)]
        self.levels = [docs]
        for fan in reversed(fans):
            self.levels.insert(0, self.levels[0].maxima(fan))
        self.fans = fans


class Best:
    """The k best (score, smaller doc_id first) of every item seen so far, and what a score must reach."""

    def __init__(self, items: int, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            # all that reach the k-th score, ties included
            near = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[near], ids[near]
        own = sorted([*self.found[item], *zip((-scores).tolist(), ids.tolist(), strict=True)])[: self.k]
        self.found[item] = own
        if len(own) == self.k:
            self.floors[item] = max(self.floors[item], -own[-1][0])


def _score(items: Items, tree: Tree, alive: np.ndarray, best: Best) -> None:
    """Exact scores of the documents below leaves (rows of `alive`) with the items alive there."""
    fan, docs = tree.fans[-1], tree.levels[-1]
    leaves = np.flatnonzero(alive.any(axis=1))
    step = max(1, CELLS // max(1, fan * items.single.nodes))
    for at in range(0, len(leaves), step):
        some = leaves[at : at + step]
        wanted = (some[:, None] * fan + np.arange(fan)).reshape(-1)
        live = np.repeat(alive[some], fan, axis=0)[wanted < docs.nodes]
        wanted = wanted[wanted < docs.nodes]
        scores = items.single.sums(docs.of(wanted))
        scores[~live | (scores < best.floors[None, :])] = 0
        doc, item = np.nonzero(scores)
        order = np.argsort(item, kind="stable")
        doc, item = doc[order], item[order]
        cut = np.searchsorted(item, np.arange(items.single.nodes + 1))
        for i in np.unique(item).tolist():
            own = doc[cut[i] : cut[i + 1]]
            best.add(i, scores[own, i], tree.doc_id[wanted[own]])


def _descend(items: Items, tree: Tree, best: Best, most_promising: bool) -> None:
    """Drop pairs of nodes by their bounds, from the roots down; score what is left.

    With `most_promising` each item is scored with the leaf of the largest bound alone.
    """
    group_floor = np.minimum.reduceat(best.floors, np.arange(0, len(best.floors), ITEM_NODE))
    alive = np.ones((tree.levels[0].nodes, items.group.nodes), bool)
    side, floor = items.group, group_floor
    for nodes, fan in zip(tree.levels, [1, *tree.fans[:-1]], strict=False):
        last = nodes is tree.levels[-2]
        if last:
            side, floor = items.single, best.floors
            alive = np.repeat(alive, ITEM_NODE, axis=1)[:, : side.nodes]
        alive = np.repeat(alive, fan, axis=0)[: nodes.nodes]
        wanted = np.flatnonzero(alive.any(axis=1))
        out, bounds = np.zeros_like(alive), None
        step = max(1, CELLS // max(1, side.nodes))
        if last and most_promising:
            bounds = np.zeros(alive.shape, np.int64)
        for at in range(0, len(wanted), step):
            some = wanted[at : at + step]
            bound = side.sums(nodes.of(some))
            out[some] = alive[some] & (bound >= floor[None, :])
            if bounds is not None:
                bounds[some] = bound
        alive = out
        if bounds is not None:
            bounds[~alive] = 0
            alive = np.zeros_like(alive)
            top = bounds.argmax(axis=0)
            alive[top, np.arange(side.nodes)] = bounds[top, np.arange(side.nodes)] > 0
    _score(items, tree, alive, best)


def _search(batches: Iterator[pa.RecordBatch], items: Items, k: int, floors: np.ndarray, most_promising: bool):
    """(item, doc_id, score): the k best of each item among the documents of the task that can be among the k best of all."""
    best = Best(len(items.ids), k, np.maximum(floors, 1))

    def trees():
        held, docs, postings = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                held.append(batch.slice(at, DOCS_AT_ONCE))
                docs += held[-1].num_rows
                postings += len(held[-1].column("terms").flatten())
                if docs > DOC_LEVELS[0] - DOCS_AT_ONCE or postings > TREE_POSTINGS:
                    yield held
                    held, docs, postings = [], 0, 0
        if held:
            yield held

    for held in trees():
        table = pa.Table.from_batches(held).combine_chunks()
        ids, n = (table[c].to_numpy() for c in ("doc_id", "n"))
        lists = [table[c].combine_chunks() for c in ("terms", "tfs")]
        cut = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        term, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
        _descend(items, Tree(items, ids, n, cut, term, tf), best, most_promising)
    out = [(i, d, -s) for i, own in enumerate(best.found) for s, d in own]
    columns = list(zip(*out, strict=True)) if out else [[]] * 3
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["item", "doc_id", "score"]
    )


def _item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The distinct rows (item_id, text) of the query set, a bounded number of them at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    small = count <= BLOCK_ITEMS and size <= BLOCK_BYTES
    blocks = 1 if small else 2 * max(-(-count // BLOCK_ITEMS), -(-size // BLOCK_BYTES))  # so that none is much larger
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        found = (rows if blocks == 1 else rows.where(place == b)).collect()
        for at in range(0, len(found), BLOCK_ITEMS):
            yield sorted(((r[0], r[1]) for r in found[at : at + BLOCK_ITEMS]), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def best_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents (doc_id, text, other columns) with the highest scores for every item.

    Rows of `items` (item_id, text, other columns) equal in both columns count once; of rows that share an item_id alone each
    has its own list. Null and empty texts have no terms: such items have no rows, such documents are never found. Every
    row of `docs` is a document of its own, repeated ones as well; equal scores go by doc_id, null first.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    parts = [_best_of_block(given, Items(rows), k) for rows in _item_blocks(items) if rows]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _best_of_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    spark = docs.sparkSession
    terms = items.terms
    vectors = written(docs.mapInArrow(lambda it: _vectors(it, terms), VECTOR_SCHEMA), "vectors")
    counted = vectors.where("having is not null")
    sums = counted.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    having = counted.select(F.posexplode("having").alias("term", "n")).groupBy("term").agg(F.sum("n").alias("n"))
    items.weigh({r["term"]: r["n"] for r in having.collect()}, sums[0], sums[1])
    sent = spark.sparkContext.broadcast(items)
    rows = vectors.where("having is null and size(terms) > 0").select("doc_id", "n", "terms", "tfs")

    def searched(floors: np.ndarray, most_promising: bool) -> DataFrame:
        found = rows.mapInArrow(lambda it: _search(it, sent.value, k, floors, most_promising), "item int, doc_id long, score long")
        first = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)

    # what is certainly reached by the k best: the k-th score among the most promising leaves
    floors = np.zeros(len(items.ids), np.int64)
    for r in searched(floors, True).where(F.col("rank") == k).collect():
        floors[r["item"]] = r["score"]
    found = written(searched(floors, False), "found")
    names = [(i, items.ids[o]) for i, o in enumerate(items.order.tolist())]
    named = spark.createDataFrame(names, "item int, item_id long")
    out = found.join(F.broadcast(named), "item")  # at most BLOCK_ITEMS rows
    return out.select("item_id", "rank", F.expr(f"nullif(doc_id, {NO_ID + 1} - 1)").alias("doc_id"), "score")
