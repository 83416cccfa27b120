"""Similar vectors by epsilon grid order join (Boehm et al., 2001).

Unit vectors with cosine c are sqrt(2 - 2 c) apart: epsilon. Vectors are sorted by the grid cells, epsilon wide, that they fall into
on the leading principal dimensions, and the sequence is cut into intervals, leaves of a tree of fan-out 16. Pairs of
intervals are joined from the root down, a level at a time; a pair whose bounding boxes on those dimensions are more than
epsilon apart is skipped with all below it. Pairs of leaves are read where the leaves lie, as a product of the table's
partitions, so no leaf is written again for the pairs it is in. They go on in halves inside a task until blocks are small. Blocks
are compared as matrix products in single precision, first of leading dimensions with a bound for the others, and what comes
near the threshold in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from .graph import components
from .tables import written

FANOUT_BITS = 4
BLOCK = 256
NEAR_BLOCK = 1024
LEADING = 31
#: Vectors of a file of intervals, and pairs of intervals that Spark hands to Python at once.
VECTORS_A_FILE, PAIRS_A_BATCH = 1 << 14, 4
CELL_SCHEMA = "dim int, vector binary, h1 long, h2 long, n long, cell binary"
INTERVAL_SCHEMA = (
    "dim int, part int, seq int, lows array<float>, highs array<float>, vectors binary, h1 binary, h2 binary, n binary"
)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _axes(sample: list, dims: int) -> np.ndarray:
    """The leading principal dimensions of a sample, as columns."""
    x = unit(np.array(sample))
    _, _, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=True)
    return v[: max(dims, LEADING)].T.copy()


def _with_cells(batches, axes: dict[int, np.ndarray], eps: float):
    """Vectors as bytes with their grid cells; equal ones of a batch are one row."""
    for rows in batches:
        if not rows.num_rows:
            continue
        h1, h2 = (rows.column(c).to_numpy() for c in ("h1", "h2"))
        order = np.lexsort((h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(order)))
        rows = rows.take(pa.array(order[first]))
        dims = rows.column("dim").to_numpy()
        values = rows.column("embedding").flatten().to_numpy()
        starts = np.cumsum(dims) - dims
        keys = [b""] * len(dims)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            cells = np.floor(unit(values[starts[at][:, None] + np.arange(dim)]) @ axes[int(dim)] / eps)
            for i, key in zip(at, (cells + 32768).astype(">u2"), strict=True):
                keys[i] = key.tobytes()
        vectors = [values[a : a + d].tobytes() for a, d in zip(starts, dims, strict=True)]
        columns = [rows.column("dim"), pa.array(vectors, pa.binary()), rows.column("h1"), rows.column("h2"), pa.array(n, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.binary())], names=["dim", "vector", "h1", "h2", "n", "cell"])


def _intervals(batches, axes: dict[int, np.ndarray], size: int, kind: str):
    """Consecutive vectors of a sorted partition with their bounding box; equal ones, which come together, are one."""
    part, seq, held, dim0 = TaskContext.get().partitionId(), 0, [], None

    def interval():
        vectors = b"".join(r[0] for r in held)
        y = unit(np.frombuffer(vectors, kind).reshape(-1, dim0)) @ axes[dim0]
        lows, highs = y.min(axis=0) - 1e-6, y.max(axis=0) + 1e-6
        more = [np.array([r[k] for r in held], np.int64).tobytes() for k in (1, 2, 3)]
        values = [dim0, part, seq, lows.tolist(), highs.tolist(), vectors, *more]
        kinds = [pa.int32()] * 3 + [pa.list_(pa.float32())] * 2 + [pa.binary()] * 4
        names = ["dim", "part", "seq", "lows", "highs", "vectors", "h1", "h2", "n"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    for rows in batches:
        columns = (rows.column(c).to_pylist() for c in ("dim", "vector", "h1", "h2", "n"))
        for dim, *row in zip(*columns, strict=True):
            if held and dim == dim0 and held[-1][1:3] == row[1:3]:
                held[-1][3] += row[3]
                continue
            if held and (dim != dim0 or len(held) == size):
                yield interval()
                seq, held = seq + 1, []
            dim0 = dim
            held.append(row)
    if held:
        yield interval()


def _box_apart(a: tuple, b: tuple, eps2: float) -> bool:
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(gap @ gap) > eps2


class _Side:
    def __init__(self, vectors: bytes, h1: bytes, h2: bytes, n: bytes, dim: int, axes: np.ndarray, dims: int, kind: str):
        self.u = unit(np.frombuffer(vectors, kind).reshape(-1, dim))
        y = self.u @ axes
        self.y = y[:, :dims]
        rest = np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1, keepdims=True)))
        # products of what is here are as large as those of the vectors, or larger
        self.near = [np.hstack([y, rest]).astype(np.float32)] * (y.shape[1] + 1 < dim) + [self.u.astype(np.float32)]
        self.h1, self.h2, self.n = (np.frombuffer(x, np.int64) for x in (h1, h2, n))
        self.boxes: dict = {}

    def box(self, a: int, b: int) -> tuple:
        if (a, b) not in self.boxes:
            self.boxes[a, b] = self.y[a:b].min(axis=0) - 1e-6, self.y[a:b].max(axis=0) + 1e-6
        return self.boxes[a, b]


def _roots_of_block(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns the lowest row that links reach (rows count first, then columns)."""
    m, n = linked.shape
    rows, columns = np.arange(m), np.arange(n) + m
    while True:
        c = np.minimum(columns, np.where(linked, rows[:, None], m + n).min(axis=0))
        r = np.minimum(rows, np.where(linked, c[None, :], m + n).min(axis=1))
        if (c == columns).all() and (r == rows).all():
            return rows, columns
        rows, columns = r, c


def _join_intervals(batches, axes: dict[int, np.ndarray], dims: int, cosine: float, eps2: float, kind: str):
    a = held = None
    for rows in batches:
        for i in range(rows.num_rows):
            r = {c: rows.column(c)[i].as_py() for c in rows.schema.names}
            dim, same = r["dim"], r["a"] == r["b"]
            near = cosine - (dim + 8) * 1.2e-7  # single precision is off by less
            if r["a"] != held:
                held, a = r["a"], _Side(r["vectors"], r["h1"], r["h2"], r["n"], dim, axes[dim], dims, kind)
            b = a if same else _Side(r["vectors2"], r["h12"], r["h22"], r["n2"], dim, axes[dim], dims, kind)
            na, nb = len(a.u), len(b.u)
            count_a = np.zeros(na, np.int64)
            count_b = count_a if same else np.zeros(nb, np.int64)
            parent = list(range(na if same else na + nb))

            def find(x, parent=parent):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            def join(x, y, parent=parent, find=find):
                p, q = find(x), find(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)

            todo = [(0, na, 0, nb)]
            while todo:
                a0, a1, b0, b1 = todo.pop()
                if same and b1 <= a0 or _box_apart(a.box(a0, a1), b.box(b0, b1), eps2):
                    continue
                small = max(a1 - a0, b1 - b0) <= BLOCK
                if max(a1 - a0, b1 - b0) <= NEAR_BLOCK:
                    for p, q in zip(a.near, b.near, strict=True):
                        products = p[a0:a1] @ q[b0:b1].T
                        at = np.flatnonzero(products >= near) if products.max() >= near else ()
                        if len(at) <= 4 * (a1 - a0 + b1 - b0):
                            break
                    if not len(at):
                        continue
                    if len(at) <= 4 * (a1 - a0 + b1 - b0):  # few: one by one
                        x, y = at // (b1 - b0) + a0, at % (b1 - b0) + b0
                        linked = np.einsum("ij,ij->i", a.u[x], b.u[y]) >= cosine
                        if same:  # each pair once
                            linked &= x < y
                        x, y = x[linked], y[linked]
                        np.add.at(count_a, x, b.n[y])
                        np.add.at(count_b, y, a.n[x])
                        for p, q in zip(x.tolist(), (y if same else y + na).tolist(), strict=True):
                            join(p, q)
                        continue
                if not small:
                    if a1 - a0 >= b1 - b0:
                        mid = (a0 + a1) // 2
                        todo += [(a0, mid, b0, b1), (mid, a1, b0, b1)]
                    else:
                        mid = (b0 + b1) // 2
                        todo += [(a0, a1, b0, mid), (a0, a1, mid, b1)]
                    continue
                linked = a.u[a0:a1] @ b.u[b0:b1].T >= cosine
                if same:
                    linked &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
                if not linked.any():
                    continue
                count_a[a0:a1] += linked @ b.n[b0:b1]
                count_b[b0:b1] += a.n[a0:a1] @ linked
                place = np.concatenate([np.arange(a0, a1), np.arange(b0, b1) + (0 if same else na)])
                for x, root in enumerate(np.concatenate(_roots_of_block(linked)).tolist()):
                    if root != x:
                        join(int(place[x]), int(place[root]))
            h1, h2 = (a.h1, a.h2) if same else (np.concatenate([a.h1, b.h1]), np.concatenate([a.h2, b.h2]))
            count = count_a if same else np.concatenate([count_a, count_b])
            at = np.flatnonzero(count)
            root = np.array([find(x) for x in at.tolist()], np.int64)
            columns = (h1[at], h2[at], count[at], h1[root], h2[root])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h1", "h2", "links", "root_h1", "root_h2"])


def similar_vectors(
    vectors: DataFrame, cosine: float = 0.95, dims: int = 12, interval: int = 4096, sample: int = 2048
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, embedding, any other columns).

    Vectors that are null, empty, zero or hold null or non-finite components, and vectors of different lengths, link
    with nothing. Equal vectors are one class with a count: they link with each other and as one with all others, and
    their pairs are never made. A null vec_id is a row like others, but no component's smallest id unless all are null.
    The principal dimensions come from `sample` vectors of each length, chosen by hash; they steer the load only.
    """
    eps2 = max(0.0, 2 - 2 * cosine) * (1 + 1e-9) + 1e-12
    eps = eps2**0.5
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.coalesce((F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    element, kind = ("float", "<f4") if single else ("double", "<f8")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast(f"array<{element}>").alias("embedding"))
    names = [F.when(valid, F.xxhash64(x.cast("array<double>"), F.lit(i))).alias(f"h{i}") for i in (1, 2)]
    named = rows.select("vec_id", *names, F.when(valid, x).alias("embedding"), F.when(valid, F.size(x)).alias("dim"))
    some = named.where("h1 is not null")
    classes = some.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.max("dim").alias("dim"))
    classes = written(classes, "vectors")
    axes = {}
    for (dim,) in classes.select("dim").distinct().collect():
        few = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("h1"), "h1", "h2").limit(sample).select("h1", "h2")
        few = some.join(F.broadcast(few), ["h1", "h2"]).groupBy("h1", "h2").agg(F.first("embedding").alias("embedding"))
        axes[dim] = _axes([r[0] for r in few.orderBy("h1", "h2").select("embedding").collect()], dims)

    cut_by = {dim: v[:, :dims] for dim, v in axes.items()}
    cells = some.select("dim", "embedding", "h1", "h2").mapInArrow(lambda it: _with_cells(it, cut_by, eps), CELL_SCHEMA)
    order = ["dim", "cell", "h1", "h2"]
    cut = cells.repartitionByRange(-(-classes.count() // VECTORS_A_FILE) or 1, *order).sortWithinPartitions(*order)
    leaves = written(cut.mapInArrow(lambda it: _intervals(it, cut_by, interval, kind), INTERVAL_SCHEMA), "intervals", "none")
    most_part, most_seq = leaves.agg(F.max("part"), F.max("seq")).first()
    if most_part is None:
        return named.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    seq_bits = most_seq.bit_length()
    bits = max(1, most_part.bit_length() + seq_bits)
    leaves = leaves.withColumn("id", F.shiftleft(F.col("part").cast("long"), seq_bits) + F.col("seq"))
    boxes = leaves.select("dim", "id", *[F.get(c, F.lit(i)).alias(f"{c}{i}") for c in ("lows", "highs") for i in range(dims)])

    def level(k: int) -> DataFrame:
        if not k:
            return boxes
        low = [F.min(f"lows{i}").alias(f"lows{i}") for i in range(dims)]
        high = [F.max(f"highs{i}").alias(f"highs{i}") for i in range(dims)]
        return boxes.groupBy("dim", F.shiftright("id", k * FANOUT_BITS).alias("id")).agg(*low, *high)

    depth = -(-bits // FANOUT_BITS)
    pairs = boxes.select("dim").distinct().select("dim", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for k in range(depth - 1, -1, -1):
        nodes = level(k).withColumn("up", F.shiftright("id", FANOUT_BITS))
        one = nodes.select("dim", F.col("up").alias("a"), F.col("id").alias("x"), *[F.col(f"{c}{i}").alias(f"a_{c}{i}") for c in ("lows", "highs") for i in range(dims)])
        two = nodes.select("dim", F.col("up").alias("b"), F.col("id").alias("y"), *[F.col(f"{c}{i}").alias(f"b_{c}{i}") for c in ("lows", "highs") for i in range(dims)])
        gap2 = sum(F.pow(F.greatest(F.lit(0.0), F.coalesce(F.col(f"a_lows{i}") - F.col(f"b_highs{i}"), F.lit(0.0)), F.coalesce(F.col(f"b_lows{i}") - F.col(f"a_highs{i}"), F.lit(0.0))), F.lit(2.0)) for i in range(dims))
        pairs = pairs.join(one, ["dim", "a"]).join(two, ["dim", "b"]).where((F.col("x") <= F.col("y")) & (gap2 <= eps2))
        pairs = pairs.select("dim", F.col("x").alias("a"), F.col("y").alias("b"))
    partners = pairs.groupBy(F.col("a").alias("id")).agg(F.collect_list("b").alias("partners"))
    blobs = ["vectors", "h1", "h2", "n"]
    one = leaves.join(F.broadcast(partners), "id").select("dim", F.col("id").alias("a"), "partners", *blobs)
    two = leaves.select(F.col("id").alias("b"), *[F.col(c).alias(f"{c}2") for c in blobs])
    joined = one.join(two.hint("shuffle_replicate_nl"), F.array_contains("partners", F.col("b"))).drop("partners")
    found = written(
        joined.mapInArrow(
            lambda it: _join_intervals(it, axes, dims, cosine, eps2, kind), "h1 long, h2 long, links long, root_h1 long, root_h2 long"
        ),
        "found",
        rows=PAIRS_A_BATCH,
    )
    edges = found.select(F.struct("h1", "h2").alias("a"), F.struct(F.col("root_h1").alias("h1"), F.col("root_h2").alias("h2")).alias("b"))
    roots = components(edges).select("node.h1", "node.h2", "root")
    links = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    known = classes.select("h1", "h2", "n", "id").join(links, ["h1", "h2"], "left")
    known = known.join(roots, ["h1", "h2"], "left").withColumn("root", F.coalesce("root", F.struct("h1", "h2")))
    smallest = known.groupBy("root").agg(F.min("id").alias("component_id"))
    known = known.join(smallest, "root").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    out = named.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
