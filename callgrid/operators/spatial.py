"""Point and polygon joins on a grid of square cells.

A polygon is listed under the cells it touches, so candidates come from an equi-join on the cell. Cells that lie wholly
inside a polygon need no test; in the others the exact test sees only the edges that matter there. The polygon side
grows with the number of polygons, not with the points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geometry as g
from ..functions.base import Col, as_list, col

BROADCAST_BYTES_KEY = "spark.callgrid.broadcastBytes"
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def with_edges(polys: DataFrame, ring: str, several: bool = False) -> DataFrame:
    """Replace the ring column by the edge list `edges` and the bounding box; `several`: rings are parts and holes."""
    edged = polys.withColumn("edges", g.oriented_edges(ring) if several else g.edges(ring)).drop(ring)
    return edged.where(F.size("edges") >= 3).select("*", *g.bounds("edges"))


def _cell(v: Col, size: Column) -> Column:
    return F.floor(col(v) / size)


#: Cells per side of a bounding box, up to twice as many.
CELLS_A_SIDE = 8


def with_cell_size(polys: DataFrame, cell: float | None = None) -> DataFrame:
    """Add `size`, the side of the cells a polygon is listed under: the power of two that gives its box 8 to 16 a side.

    So a polygon has at most 17 x 17 cells, whatever the sizes of the others. `cell` fixes one size for all.
    """
    if cell:
        return polys.withColumn("size", F.lit(float(cell)))
    side = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(1e-9))
    return polys.withColumn("size", F.pow(F.lit(2.0), F.floor(F.log2(side / CELLS_A_SIDE))))


def sizes_in_use(*layers: DataFrame) -> list[float]:
    """The cell sizes of layers, ascending: one number per power of two between the smallest and the largest polygon."""
    sizes = layers[0].select("size")
    for layer in layers[1:]:
        sizes = sizes.union(layer.select("size"))
    return sorted(r["size"] for r in sizes.distinct().collect())


def by_cell(polys: DataFrame, size: str = "size") -> DataFrame:
    """One row per polygon and cell of its bounding box."""
    cells = [F.explode(F.sequence(_cell(f"min_{k}", F.col(size)), _cell(f"max_{k}", F.col(size)))) for k in "xy"]
    return polys.withColumn("cell_x", cells[0]).withColumn("cell_y", cells[1])


def classified_cells(polys: DataFrame) -> DataFrame:
    """Cells of each polygon, without those outside it; `edges` is NULL in cells wholly inside.

    A ray to the right of a point in a border cell can only cross edges that overlap the cell's height and do not lie
    to its left, so only those are kept.
    """
    size = F.col("size")
    x0, y0 = F.col("cell_x") * size, F.col("cell_y") * size
    # the margin makes up for rounding when cell corners are computed back from cell numbers
    margin = size * 1e-9
    x1, y1 = x0 + (size + margin), y0 + (size + margin)
    x0, y0 = x0 - margin, y0 - margin

    def level(k: Column) -> Column:
        return (F.least(k["y1"], k["y2"]) <= y1) & (F.greatest(k["y1"], k["y2"]) >= y0)

    ahead = F.filter("edges", lambda k: level(k) & (F.greatest(k["x1"], k["x2"]) >= x0))
    cells = by_cell(polys).withColumn("ahead", ahead)
    border = F.exists("ahead", lambda k: F.least(k["x1"], k["x2"]) <= x1)
    inside = g.contains("ahead", x0 + size / 2, y0 + size / 2)
    marked = cells.withColumn("border", border).where(F.col("border") | inside)
    return marked.withColumn("edges", F.when(F.col("border"), F.col("ahead"))).drop("ahead", "border")


def sized_for_join(listed: DataFrame) -> DataFrame:
    """Hint how to join the cell list: broadcast when its measured size is within bounds, sort-merge otherwise.

    The planner does not know how far cells and edges multiply, so the size is taken from the list itself. A merge
    join leaves a crowded cell to adaptive execution, which splits the points of a skewed partition.
    """
    measured = listed.agg(F.sum(F.coalesce(F.size("edges"), F.lit(0)) * 40 + 100).alias("b")).first()["b"] or 0
    limit = int(listed.sparkSession.conf.get(BROADCAST_BYTES_KEY, str(DEFAULT_BROADCAST_BYTES)))
    return F.broadcast(listed) if measured <= limit else listed.hint("merge")


def point_in_polygon(
    points: DataFrame,
    polys: DataFrame,
    x: str,
    y: str,
    ring: str,
    cell: float | None = None,
    several: bool = False,
    how: str = "inner",
    key=None,
) -> DataFrame:
    """Points joined to the polygons they lie in, with the polygon's other columns.

    Borders are half open: a border shared by two polygons belongs to one of them, so a gap-free layer gives every
    point one polygon. `how="left"` keeps points outside every polygon, and gives a point in several the one that is
    first by the polygon's columns: one row per row of `points`, told apart by the `key` columns and the place.
    """
    edged = with_cell_size(with_edges(polys, ring, several), cell)
    keep = [c for c in polys.columns if c != ring]
    sizes = sizes_in_use(edged)
    if not sizes:
        found = points.join(polys.select(*keep).limit(0), F.lit(False), "left")
        return found if how == "left" else found.limit(0)
    listed = classified_cells(edged).select(
        *keep, "edges", F.col("size").alias("__size"), F.col("cell_x").alias("__cx"), F.col("cell_y").alias("__cy")
    )
    listed = sized_for_join(listed)
    if how == "left":
        own = list(dict.fromkeys([*as_list(key or points.columns), x, y]))
        asked = points.select(*own)
    else:
        own, asked = points.columns, points
    # a point has one cell per size
    asked = asked.withColumn("__at", F.explode(F.array(*map(F.lit, sizes))) if len(sizes) > 1 else F.lit(sizes[0]))
    asked = asked.withColumns({"cell_x": _cell(x, F.col("__at")), "cell_y": _cell(y, F.col("__at"))})
    inside = F.col("edges").isNull() | g.contains("edges", x, y)
    on = (F.col("__at") == F.col("__size")) & (F.col("cell_x") == F.col("__cx")) & (F.col("cell_y") == F.col("__cy"))
    found = asked.join(listed, on & inside).select(*own, *keep)
    if how != "left":
        return found.select(*points.columns, *keep)
    mine = [F.col(c).alias(f"__own{i}") for i, c in enumerate(own)]
    best = found.select(*mine, F.struct(*keep).alias("__best")).groupBy(*[f"__own{i}" for i in range(len(own))])
    best, same = best.agg(F.min("__best").alias("__best")), F.lit(True)
    for i, c in enumerate(own):
        same = same & F.col(c).eqNullSafe(F.col(f"__own{i}"))
    return points.join(best, same, "left").select(*points.columns, *[F.col("__best")[c].alias(c) for c in keep])


def first_of_layers(
    points: DataFrame, layers: list[DataFrame], x: str, y: str, ring: str, key, cell: float | None = None, several: bool = False
) -> DataFrame:
    """(key, x, y, columns of every layer) of the points that lie in a polygon of some layer, one row per key and place.

    All layers share one list of cells, so a point is looked up once, whatever their number. Where polygons of a layer
    overlap, a point has the one that is first by its columns; a layer in which it has none gives NULL.
    """
    edged = [with_cell_size(with_edges(p, ring, several), cell) for p in layers]
    names = [[c for c in p.columns if c != ring] for p in layers]
    own = list(dict.fromkeys([*as_list(key), x, y]))
    kinds = [p.select(*n).schema for p, n in zip(layers, names, strict=True)]
    sizes = sizes_in_use(*edged)
    if not sizes:
        none = [F.lit(None).cast(f.dataType).alias(f.name) for kind in kinds for f in kind]
        return points.select(*own, *none).limit(0)
    listed = None
    for i, (polys, columns) in enumerate(zip(edged, names, strict=True)):
        best = [F.struct(*columns) if i == j else F.lit(None).cast(kind) for j, kind in enumerate(kinds)]
        cells = classified_cells(polys).select(
            *[b.alias(f"__best{j}") for j, b in enumerate(best)],
            "edges",
            F.col("size").alias("__size"),
            F.col("cell_x").alias("__cx"),
            F.col("cell_y").alias("__cy"),
        )
        listed = cells if listed is None else listed.unionByName(cells)
    listed = sized_for_join(listed)
    asked = points.select(*own).withColumn("__at", F.explode(F.array(*map(F.lit, sizes))) if len(sizes) > 1 else F.lit(sizes[0]))
    asked = asked.withColumns({"cell_x": _cell(x, F.col("__at")), "cell_y": _cell(y, F.col("__at"))})
    inside = F.col("edges").isNull() | g.contains("edges", x, y)
    on = (F.col("__at") == F.col("__size")) & (F.col("cell_x") == F.col("__cx")) & (F.col("cell_y") == F.col("__cy"))
    found = asked.join(listed, on & inside).groupBy(*own).agg(*[F.min(f"__best{i}").alias(f"__best{i}") for i in range(len(layers))])
    return found.select(*own, *[F.col(f"__best{i}")[c].alias(c) for i, columns in enumerate(names) for c in columns])


_BOX = ("min_x", "min_y", "max_x", "max_y")


def _candidates(a: DataFrame, b: DataFrame, a_key: str, b_key: str, cell: float | None) -> DataFrame:
    """Pairs of polygons whose boxes overlap, with the edges of both.

    A polygon is listed at its own cell size and all larger ones in use, where it has few cells; a pair meets at the
    larger size of the two, and is kept in the cell of its common corner. Edges join the pairs afterwards, once each.
    """
    a, b = with_cell_size(a, cell), with_cell_size(b, cell)
    sizes = F.array(*map(F.lit, sizes_in_use(a, b) or [1.0]))

    def cells(polys: DataFrame, key: str, side: str) -> DataFrame:
        at = F.explode(F.filter(sizes, lambda s: s >= F.col("size")))
        rows = by_cell(polys.withColumn("at", at), "at")
        boxed = [F.col(c).alias(f"{side}_{c}") for c in (*_BOX, "size")]
        return rows.select(F.col(key).alias(f"__{side}"), *boxed, "at", "cell_x", "cell_y")

    corner = F.col("at") == F.greatest("a_size", "b_size")
    for k in "xy":
        corner = corner & (F.col(f"cell_{k}") == _cell(F.greatest(f"a_min_{k}", f"b_min_{k}"), F.col("at")))
        corner = corner & (F.col(f"a_min_{k}") <= F.col(f"b_max_{k}")) & (F.col(f"b_min_{k}") <= F.col(f"a_max_{k}"))
    pairs = cells(a, a_key, "a").join(cells(b, b_key, "b"), ["at", "cell_x", "cell_y"]).where(corner).select("__a", "__b")
    one = a.select(F.col(a_key).alias("__a"), F.col("edges").alias("a_edges"))
    two = b.select(F.col(b_key).alias("__b"), F.col("edges").alias("b_edges"))
    return pairs.join(one, "__a").join(two, "__b")


def overlap_weights(
    polys_a: DataFrame, polys_b: DataFrame, a_key: str, b_key: str, ring: str, cell: float | None = None, several: bool = False
) -> DataFrame:
    """(a_key, b_key, multiplier) of polygons that meet; the multiplier is area(a and b) / area(b).

    With `several` the column of both layers has arrays of rings, parts and holes.
    """
    a, b = with_edges(polys_a.select(a_key, ring), ring, several), with_edges(polys_b.select(b_key, ring), ring, several)
    return _candidates(a, b, a_key, b_key, cell).where(g.intersects("a_edges", "b_edges", several)).select(
        F.col("__a").alias(a_key),
        F.col("__b").alias(b_key),
        F.try_divide(g.overlap_area("a_edges", "b_edges"), g.edges_area("b_edges")).alias("multiplier"),
    )


def intersects_any(
    polys: DataFrame, other: DataFrame, key: str, ring: str, other_key: str, cell: float | None = None, several: bool = False
) -> DataFrame:
    """Polygons that meet at least one polygon of another layer; with `several`, of rings that are parts and holes."""
    a, b = with_edges(polys.select(key, ring), ring, several), with_edges(other.select(other_key, ring), ring, several)
    pairs = _candidates(a, b, key, other_key, cell)
    hits = pairs.where(g.intersects("a_edges", "b_edges", several)).select(F.col("__a").alias(key)).distinct()
    return polys.join(hits, key, "left_semi")


def counts_per_area(
    points: DataFrame,
    polys: DataFrame,
    x: str,
    y: str,
    ring: str,
    key: str,
    out: str = "incidents",
    cell: float | None = None,
) -> DataFrame:
    """Points per polygon that has any."""
    joined = point_in_polygon(points.select(x, y), polys.select(key, ring), x, y, ring, cell)
    return joined.groupBy(key).agg(F.count(F.lit(1)).alias(out))
