"""Exact nearest neighbours by pivots, and the classifier that lets them vote.

Train vectors are dealt to cells, each vector to the pivot nearest to it. A query first looks at the cells around it that
hold enough vectors; the distance found there is a bound, and from then on only cells come into question that can
hold something nearer, by the triangle inequality and by the plane half way between two pivots. Equal vectors are one vector
with its first rows, on both sides, so a vector that many rows share costs no more than others. Large cells are cut
into blocks; a pair of blocks is one piece of work of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.base import as_list, flag
from ..sources.scratch import checkpointed

#: Most pivots; there are as many as the root of the number of distinct train vectors.
MOST_PIVOTS = 1024
#: Train vectors and queries of one piece of work, about.
BLOCK_ROWS = 4096
#: Distances held at once.
CELLS_AT_ONCE = 1 << 22
#: Bounds are rounded up by this share, so that rounding never hides a cell.
MARGIN = 1e-9


def vector(features) -> Column:
    """The features as doubles; a missing value is an error, as it has no distance."""
    parts = [F.col(f).cast("double") for f in as_list(features)]
    missing = parts[0].isNull() | F.isnan(parts[0])
    for p in parts[1:]:
        missing = missing | p.isNull() | F.isnan(p)
    wrong = F.raise_error(F.lit("a feature is missing; nearest neighbours need all of them")).cast("array<double>")
    return F.when(missing, wrong).otherwise(F.array(*[p + F.lit(0.0) for p in parts]))


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of every row of a and every row of b, added up feature by feature."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        step = a[:, j, None] - b[None, :, j]
        out += step * step
    return out


class Cells(NamedTuple):
    """Pivots, how many distinct train vectors are nearest to each, and how far the farthest of them is."""

    pivots: np.ndarray
    count: np.ndarray
    radius: np.ndarray

    def nearest(self, v: np.ndarray) -> np.ndarray:
        return squared_distances(v, self.pivots).argmin(axis=1)

    def first(self, v: np.ndarray, k: int) -> np.ndarray:
        """For each vector the nearest cells that hold k vectors between them, as flags."""
        d2 = squared_distances(v, self.pivots)
        order = d2.argsort(axis=1, kind="stable")
        held = self.count[order]
        before = held.cumsum(axis=1) - held
        out = np.zeros(d2.shape, bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out & (self.count > 0)

    def within(self, v: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """For each vector the cells that can hold a vector as near as its bound, as flags."""
        d2 = squared_distances(v, self.pivots)
        d, home = np.sqrt(d2), d2.argmin(axis=1)
        apart = np.sqrt(squared_distances(self.pivots, self.pivots))[home]
        near = d2[np.arange(len(v)), home][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(apart > 0, (d2 - near) / (2 * apart), 0.0)
        least = np.maximum(d - self.radius, plane)
        reach = bound * (1 + MARGIN) + MARGIN * d.max(axis=1)
        return (least <= reach[:, None]) & (self.count > 0)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.reshape(-1)))


def _in_cells(train: DataFrame) -> tuple[DataFrame, Cells]:
    """(v, cell) of distinct train vectors, and the cells."""
    n = train.count()
    # pivots steer the work only; those with the lowest hashes are as good as others
    rows = train.select("v").orderBy(F.xxhash64("v"), "v").limit(max(1, min(MOST_PIVOTS, int(n**0.5)))).collect()
    pivots = np.array([r["v"] for r in rows], float).reshape(len(rows), -1)

    def dealt(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            d2 = squared_distances(_matrix(batch.column("v")), pivots)
            cell = d2.argmin(axis=1)
            far = np.sqrt(d2[np.arange(len(cell)), cell])
            yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array(cell.astype(np.int32)), pa.array(far)], names=["v", "cell", "far"])

    placed = checkpointed(train.select("v").mapInArrow(dealt, "v array<double>, cell int, far double"))
    count, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():
        count[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    return placed.select("v", "cell"), Cells(pivots, count, radius)


def _visits(queries: DataFrame, cells: Cells, k: int, bounded: bool) -> DataFrame:
    """(q, cell): the cells a query looks at first, or those within its `bound` that it has not seen."""

    def looked_up(batches: Iterator[pa.RecordBatch]):
        step = max(1, CELLS_AT_ONCE // len(cells.pivots))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                v = _matrix(part.column("q"))
                seen = cells.first(v, k)
                wanted = seen
                if bounded:
                    wanted = cells.within(v, part.column("bound").to_numpy(zero_copy_only=False)) & ~seen
                row, cell = np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays([part.column("q").take(pa.array(row)), pa.array(cell.astype(np.int32))], names=["q", "cell"])

    return queries.mapInArrow(looked_up, "q array<double>, cell int")


def _block_pairs(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k train vectors nearest to each query among those of a block, equal distances by vector."""
    schema = pa.schema([("q", pa.list_(pa.float64())), ("d2", pa.float64()), ("v", pa.list_(pa.float64()))])
    if not len(left) or not len(right):
        return schema.empty_table()
    q, v = _matrix(left["q"]), _matrix(right["v"])
    v = v[np.lexsort(v.T[::-1])]
    step, out = max(1, CELLS_AT_ONCE // len(v)), []
    for at in range(0, len(q), step):
        part = q[at : at + step]
        d2 = squared_distances(part, v)
        chosen = np.ones(d2.shape, bool)
        if len(v) > k:
            kth = np.partition(d2, k - 1, axis=1)[:, k - 1 : k]
            nearer, equal = d2 < kth, d2 == kth
            chosen = nearer | (equal & (equal.cumsum(axis=1) <= k - nearer.sum(axis=1, keepdims=True)))
        row, col = np.nonzero(chosen)
        out.append(pa.Table.from_arrays([_lists(part[row]), pa.array(d2[row, col]), _lists(v[col])], schema=schema))
    return pa.concat_tables(out)


def _compared(visits: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """(q, d2, v): for each visited block the nearest vectors of it."""
    visits = checkpointed(visits)
    asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = range(max([-1, *asked, *held]) + 1)
    blocks = lambda n: F.element_at(F.lit([-(-n.get(c, 0) // BLOCK_ROWS) or 1 for c in cells] or [1]), F.col("cell") + 1)

    def dealt(df: DataFrame, name: str, own: dict, own_place: str, other: dict, other_place: str) -> DataFrame:
        """A row goes to one block of its own side, and meets every block of the other."""
        mine = F.pmod(F.xxhash64(name), blocks(own)).cast("int").alias(own_place)
        every = F.explode(F.sequence(F.lit(0), (blocks(other) - 1).cast("int"))).alias(other_place)
        return df.select(name, "cell", mine, every)

    left = dealt(visits, "q", asked, "q_block", held, "v_block").groupBy("cell", "v_block", "q_block")
    right = dealt(placed, "v", held, "v_block", asked, "q_block").groupBy("cell", "v_block", "q_block")
    return left.cogroup(right).applyInArrow(lambda a, b: _block_pairs(a, b, k), "q array<double>, d2 double, v array<double>")


def nearest_neighbours(train: DataFrame, queries: DataFrame, k: int, key: str = "key") -> DataFrame:
    """(q, rank, d2, key, other columns): the k rows of `train` (v, key, ...) nearest to every distinct `q` of `queries`.

    Exact, by squared distance; equal distances go by vector, then by key. A row of `train` has the distance 0 to a query equal to
    it. With fewer than k rows there are as many as there are; without any, none.
    """
    others = [c for c in train.columns if c != "v"]
    by_key = W.partitionBy("v").orderBy(key)
    few = train.withColumn("__nth", F.row_number().over(by_key)).where(F.col("__nth") <= k).drop("__nth")
    rows = checkpointed(few)
    distinct = checkpointed(rows.select("v").distinct())
    if distinct.isEmpty():
        kinds = rows.select(*others).schema
        return queries.limit(0).select("q", F.lit(0).alias("rank"), F.lit(0.0).alias("d2"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds])
    placed, cells = _in_cells(distinct)
    asked = checkpointed(queries.select("q").distinct())
    best = W.partitionBy("q").orderBy("d2", "v")

    def kept(df: DataFrame) -> DataFrame:
        return df.withColumn("__nth", F.row_number().over(best)).where(F.col("__nth") <= k).drop("__nth")

    around = checkpointed(kept(_compared(_visits(asked, cells, k, False), placed, k)))
    bound = around.groupBy("q").agg(F.when(F.count(F.lit(1)) >= k, F.sqrt(F.max("d2"))).otherwise(float("inf")).alias("bound"))
    beyond = _compared(_visits(bound, cells, k, True), placed, k)
    found = kept(around.unionByName(beyond)).join(rows, "v")
    rank = F.row_number().over(W.partitionBy("q").orderBy("d2", "v", key))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "rank", "d2", *others)


def neighbour_scores(
    train: DataFrame, rows: DataFrame, label: str, key: str, features, n_neighbors: int = 3, weights: str = "uniform"
) -> DataFrame:
    """(key, score) of `rows`: the share of class 1 among the nearest train rows.

    `weights` is `uniform`, or `distance`: a neighbour counts as one over its distance, and where some are at distance 0 these
    alone count. A row is its own neighbour if it is in `train`. Neighbours are found once for each distinct vector.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError(f"no weights {weights}")
    known = train.select(vector(features).alias("v"), F.col(key).alias("__key"), flag(F.col(label).cast("boolean")).cast("double").alias("__y"))
    asked = rows.select(F.col(key), vector(features).alias("q"))
    found = nearest_neighbours(known, asked, n_neighbors, "__key")
    share = F.avg("__y")
    if weights == "distance":
        near = 1 / F.sqrt("d2")
        share = F.when(F.min("d2") == 0, F.avg(F.when(F.col("d2") == 0, F.col("__y")))).otherwise(
            F.sum(F.when(F.col("d2") > 0, F.col("__y") * near)) / F.sum(F.when(F.col("d2") > 0, near))
        )
    return asked.join(found.groupBy("q").agg(share.alias("score")), "q", "left").select(key, "score")
