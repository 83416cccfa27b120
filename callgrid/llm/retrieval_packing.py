"""Packing documents into windows next to documents like them, by BM25 retrieval in shards.

Documents are dealt to shards of bounded size: by cells of documents that use the same words, then by rare tokens in common. The
centres of the cells are fitted on a sample, all documents are dealt by them. Each shard weighs its token ids by how many documents of the whole corpus have them. An unused document seeds a window; all its terms are the
query; unused neighbours that fit, best first, fill the window. What no whole neighbour fits is filled with the start of the best one
left, whose rest stays in the pool. So every window is full but the end of a shard, which is cut into powers of two.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .textbytes import U, mixed
from .token_files import _sums
from .tokens import _runs, from_planes, release, token_table

PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Corpus(NamedTuple):
    """What BM25 weighs terms and lengths by."""

    having: np.ndarray  # for each id the number of documents that have it
    documents: int
    mean_length: float


def _postings(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each term of each document, the document, and how often it has the term; by document, then term."""
    keys = (np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) << 32) | ids.astype(np.int64)
    keys, tf = np.unique(keys, return_counts=True)
    return keys & ((1 << 32) - 1), keys >> 32, tf


def _bm25(term: np.ndarray, tf: np.ndarray, length: np.ndarray, corpus: Corpus, k1: float, b: float) -> np.ndarray:
    df = corpus.having[term]
    idf = np.log1p((corpus.documents - df + 0.5) / (df + 0.5))
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / max(corpus.mean_length, 1e-9)))


#: Cells that documents are dealt to, dimensions that terms are folded into for that, documents that centres are fitted
#: on (as expected of a draw by hash) and the longest of them, in tokens.
CELLS, FOLDED, FITTED_ON, FITTED_LENGTH, FIT_ROUNDS = 64, 1024, 4096, 16384, 12
#: The sum in a dimension that counts half as much as any larger one can.
SATURATION = 2.0
#: Documents that a task deals at a time.
DEALT_AT_ONCE = 512


def _folded(ids: np.ndarray, bounds: np.ndarray, corpus: Corpus) -> np.ndarray:
    """A unit vector for each document: inverse document frequencies added up in few dimensions, with a sign by term, then saturated."""
    n, h = len(bounds) - 1, mixed(np.arange(len(corpus.having), dtype=U) + U(1))
    idf = np.log1p((corpus.documents - corpus.having + 0.5) / (corpus.having + 0.5)) * np.where(h >> U(63), 1, -1)
    place = np.repeat(np.arange(n) * FOLDED, np.diff(bounds)) + (h % U(FOLDED)).astype(np.int64)[ids]
    x = np.bincount(place, idf[ids], n * FOLDED).astype(np.float32).reshape(n, FOLDED)
    return _unit(x / (np.abs(x) + SATURATION))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fitted_centres(ids: np.ndarray, bounds: np.ndarray, corpus: Corpus, cells: int = CELLS) -> np.ndarray:
    """Unit vectors of at most `cells` centres, by spherical k-means; neighbours in the list are alike."""
    if len(bounds) < 2:
        return np.zeros((1, FOLDED), np.float32)
    x = _folded(ids, bounds, corpus)
    centres = x[:cells]
    for _ in range(FIT_ROUNDS):
        sums = np.zeros_like(centres)
        np.add.at(sums, (x @ centres.T).argmax(1), x)
        centres = _unit(np.where(np.any(sums, axis=1, keepdims=True), sums, centres))
    chain, left = [0], list(range(1, len(centres)))
    while left:
        alike = centres[left] @ centres[chain[-1]]
        chain.append(left.pop(int(alike.argmax())))
    return centres[chain]


def nearest_centres(ids: np.ndarray, bounds: np.ndarray, corpus: Corpus, centres: np.ndarray) -> np.ndarray:
    """For each document, the place in the list of the centre with the highest cosine."""
    out = np.zeros(len(bounds) - 1, np.int64)
    for a in range(0, len(out), DEALT_AT_ONCE):
        some = bounds[a : a + DEALT_AT_ONCE + 1]
        out[a : a + DEALT_AT_ONCE] = (_folded(ids[some[0] : some[-1]], some - some[0], corpus) @ centres.T).argmax(1)
    return out


class Index:
    """An inverted BM25 index of the documents of one shard, with the weights of the corpus (without one, of the shard).

    For each term the documents that have it and its weights in them. A seed reads the lists of its own terms alone and adds
    the weights up per document. Every term is kept and every term of a seed is in its query, but for those that one document
    of the shard has, which score no other. `terms` limits the query to a seed's strongest; None is all.
    """

    def __init__(
        self, ids: np.ndarray, bounds: np.ndarray, terms: int | None = None, k1: float = 1.2, b: float = 0.75, corpus: Corpus | None = None
    ):
        n = len(bounds) - 1
        length = np.diff(bounds)
        term, doc, tf = _postings(ids, bounds)
        here = np.bincount(term)
        if corpus is None:
            corpus = Corpus(here, n, length.mean())
        shared = here[term] > 1
        term, doc, tf = term[shared], doc[shared], tf[shared]
        weight = _bm25(term, tf, length[doc], corpus, k1, b)
        self.n, self.cut = n, np.searchsorted(doc, np.arange(n + 1))  # terms of a document: [cut, next cut)
        self.term = term.astype(np.int32)
        if terms is not None:  # strongest first
            self.term = self.term[np.lexsort((-weight, doc))]
        self.terms = terms
        order = np.argsort(term, kind="stable")
        self.docs, self.weight = doc[order].astype(np.int32), weight[order].astype(np.float32)
        self._lists(np.bincount(term, minlength=len(here)))

    def _lists(self, size: np.ndarray) -> None:
        self.size = size
        self.begin = np.cumsum(size) - size

    def scores(self, seed: int) -> np.ndarray:
        query = self.term[self.cut[seed] : self.cut[seed + 1]][: self.terms]
        begin, size = self.begin[query], self.size[query]
        return np.bincount(_runs(self.docs, begin, size), _runs(self.weight, begin, size), minlength=self.n)

    def narrow(self, left: np.ndarray) -> None:
        """Forget the postings of documents with nothing left, once they are a quarter: nobody asks for their scores."""
        keep = left[self.docs] > 0
        if 4 * np.count_nonzero(keep) > 3 * len(keep):
            return
        term = np.repeat(np.arange(len(self.size)), self.size)[keep]
        self.docs, self.weight = self.docs[keep], self.weight[keep]
        self._lists(np.bincount(term, minlength=len(self.size)))


def packed_shard(lengths: np.ndarray, index: Index, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); every token of every document is in one. Uses the index up."""
    at = np.zeros(len(lengths), np.int64)  # tokens used
    out = []
    for d in np.flatnonzero(lengths >= window).tolist():
        while lengths[d] - at[d] >= window:
            out.append([(d, int(at[d]), window)])
            at[d] += window
    left = lengths - at
    seed = 0
    while True:
        while seed < len(left) and not left[seed]:
            seed += 1
        if seed == len(left):
            return out
        room, sequence = window, []

        def take(d: int, size: int) -> int:
            sequence.append((d, int(at[d]), size))  # noqa: B023
            at[d] += size
            left[d] -= size
            return size

        if len(out) % 16 == 0:
            index.narrow(left)
        scores = index.scores(seed)
        room -= take(seed, int(left[seed]))
        if room:
            near = np.flatnonzero((left > 0) & (scores > 0))
            near = near[np.argsort(-scores[near], kind="stable")]
            whole = near
            while len(whole := whole[left[whole] <= room]):
                fit = int(np.searchsorted(np.cumsum(left[whole]), room, "right"))
                for d in whole[:fit].tolist():
                    room -= take(d, int(left[d]))
                whole = whole[fit:]
            if room and len(near := near[left[near] > 0]):  # none fits: the best is cut
                room -= take(int(near[0]), room)
            d = seed  # none has a score: in order
            while room and d < len(left):
                if left[d]:
                    room -= take(d, min(room, int(left[d])))
                d += 1
        out.append(sequence)


def powers_of_two(sequence: list[tuple[int, int, int]], window: int, least: int = 64) -> list[list[tuple[int, int, int]]]:
    """A short sequence as sequences whose lengths are powers of two, but for one below `least`."""
    out, todo = [], sequence
    while todo:
        total = sum(p[2] for p in todo)
        size = min(window, 1 << (total.bit_length() - 1)) if total > least else total
        now, later = [], []
        for d, start, n in todo:
            a = min(n, size)
            if a:
                now.append((d, start, a))
            if a < n:
                later.append((d, start + a, n - a))
            size -= a
        out.append(now)
        todo = later
    return out


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = 4096, shard_tokens: int = 1 << 20, terms: int | None = None
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) for each piece of each row of `docs` (doc_id, text).

    A document is the ids of its whole text (null: none) and the end id; ids are little-endian unsigned 32-bit numbers. A
    document that would fill windows alone is cut, one that overfills the last place of a window too. A sequence is
    meant to be padded to `window`, or to the next power of two if it is shorter. sequence_id is unique, not gapless.
    Rows with one doc_id are documents of their own. A shard is at most `shard_tokens` and a document; neighbours come from the
    shard of the seed, scored with all terms (or the `terms` strongest) and the weights of the whole corpus.
    """
    table = token_table(docs, vocabulary, end_id, "tokens", by_document=True)
    having = sum((np.frombuffer(r[0], np.int64) for r in _sums(table).collect()), np.zeros(1, np.int64))
    table = table.where("counts is null")
    size = table.agg(F.count("*"), F.sum("n")).first()
    corpus = Corpus(having, size[0], (size[1] or 0) / max(size[0], 1))
    tie = F.xxhash64("ids")
    drawn = F.pmod(F.xxhash64("doc_id", "n", "sketch"), F.lit(1 << 32)) < int(FITTED_ON / max(size[0], 1) * (1 << 32))
    sample = table.where(drawn & (F.col("n") <= FITTED_LENGTH)).select("n", "ids").collect()
    centres = fitted_centres(
        np.concatenate([np.zeros(0, np.uint32), *(from_planes(ids, n) for n, ids in sample)]), np.cumsum([0, *(n for n, _ in sample)]), corpus
    )

    def dealt(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            cell = [np.zeros(0, np.int64)]
            for a in range(0, batch.num_rows, DEALT_AT_ONCE):
                part = batch.slice(a, DEALT_AT_ONCE)
                lengths = part.column("n").to_pylist()
                ids = np.concatenate([from_planes(data, n) for data, n in zip(part.column("ids").to_pylist(), lengths, strict=True)])
                cell.append(nearest_centres(ids, np.cumsum([0, *lengths]), corpus, centres))
            columns = [pa.array(np.concatenate(cell)), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", *batch.schema.names])

    cells = table.select("doc_id", "n", "ids", "sketch").mapInArrow(dealt, "cell long, doc_id long, n long, ids binary, sketch long")
    spread = cells.repartitionByRange("cell", "sketch", "doc_id", "n")

    def pack(batches: Iterator[pa.RecordBatch]):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        release()

        def shard():
            nonlocal number
            lengths = np.array([r[1] for r in held], np.int64)
            ids = np.concatenate([from_planes(r[2], r[1]) for r in held])
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            data = memoryview(ids.astype("<u4").tobytes())
            sequences = packed_shard(lengths, Index(ids, bounds, terms, corpus=corpus), window)
            last = sequences.pop()
            out = []
            for sequence in [*sequences, *powers_of_two(last, window)]:
                offset = 0
                for d, start, n in sequence:
                    a = 4 * (int(bounds[d]) + start)
                    out.append((held[d][0], start, n, bytes(data[a : a + 4 * n]), held[d][1], number, offset))
                    offset += n
                number += 1
            for a in range(0, len(out), 1024):
                columns = zip(*out[a : a + 1024], strict=True)
                names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
                kinds = [pa.binary() if x == "ids" else pa.int64() for x in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "ids")), strict=True):
                held.append(row)
                size += row[1]
                if size >= shard_tokens:
                    yield from shard()
                    held, size = [], 0
        if held:
            yield from shard()

    return spread.sortWithinPartitions("cell", "sketch", "doc_id", "n", tie).drop("cell").mapInArrow(pack, PIECE_SCHEMA)
