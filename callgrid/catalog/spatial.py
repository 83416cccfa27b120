"""Points and polygons."""

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import aggregates as a, spatial as sp
from .base import POINTS, query

_AREA = "cast(floor(x / 2) + 5 * floor(y / 2) AS bigint)"


@query(
    "point_in_square",
    f"""
    WITH {POINTS}
    SELECT l_orderkey, l_linenumber, round(x, 6) AS x, round(y, 6) AS y, {_AREA} AS area FROM points WHERE x < 10 AND y < 10
    """,
)
def _(t):
    return sp.point_in_polygon(t.points.drop("l_quantity"), t.areas, "x", "y", "ring")


@query(
    "point_in_diamond",
    f"""
    WITH {POINTS}
    SELECT r_regionkey AS region, count(*) AS n, cast(sum(l_quantity) AS bigint) AS q
    FROM points JOIN region ON abs(x - (2 * r_regionkey + 1)) + abs(y - 5) < 1.50005 GROUP BY 1
    """,
)
def _(t):
    inside = sp.point_in_polygon(t.points, t.diamonds, "x", "y", "ring", cell=0.5)
    return inside.groupBy("region").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("q"))


@query(
    "points_outside_kept",
    f"""
    WITH {POINTS}
    SELECT CASE WHEN x < 10 AND y < 10 THEN {_AREA} END AS area, count(*) AS n FROM points GROUP BY 1
    """,
)
def _(t):
    return sp.point_in_polygon(t.points, t.areas, "x", "y", "ring", how="left").groupBy("area").agg(F.count("*").alias("n"))


_WEIGHTS = """
    w AS (SELECT r_regionkey AS strip, n_nationkey AS area,
                 greatest(least(2 * r_regionkey + 2.5, n_nationkey % 5 * 2 + 2) - greatest(2 * r_regionkey + 0.5, n_nationkey % 5 * 2), 0)
                 * greatest(least(6.5, n_nationkey // 5 * 2 + 2) - greatest(0.5, n_nationkey // 5 * 2), 0) / 4.0 AS m
          FROM region, nation)
"""


@query(
    "overlap_weights",
    f"WITH {_WEIGHTS} SELECT strip, area, round(m::double, 6) AS multiplier FROM w WHERE m > 0",
)
def _(t):
    return sp.overlap_weights(t.strips, t.areas, "strip", "area", "ring")


@query(
    "diamond_overlap_total",
    """
    SELECT r_regionkey AS region, round(2 * 1.50005::double * 1.50005 / 4
           - CASE WHEN r_regionkey = 4 THEN 0.50005::double * 0.50005 / 4 ELSE 0 END
           - CASE WHEN r_regionkey = 0 THEN 0.50005::double * 0.50005 / 4 ELSE 0 END, 6) AS total
    FROM region
    """,
)
def _(t):
    w = sp.overlap_weights(t.diamonds, t.areas, "region", "area", "ring")
    return w.groupBy("region").agg(F.sum("multiplier").alias("total"))


@query(
    "intersects_any",
    """
    SELECT n_nationkey AS area FROM nation WHERE EXISTS (
      SELECT 1 FROM region WHERE 2 * r_regionkey + 0.5 <= n_nationkey % 5 * 2 + 2 AND 2 * r_regionkey + 2.5 >= n_nationkey % 5 * 2
      AND 0.5 <= n_nationkey // 5 * 2 + 2 AND 6.5 >= n_nationkey // 5 * 2)
    """,
)
def _(t):
    return sp.intersects_any(t.areas, t.strips, "area", "ring", "strip").select("area")


@query(
    "rate_per_area",
    f"""
    WITH {POINTS}, c AS (SELECT {_AREA} AS area, count(*) AS incidents FROM points WHERE x < 10 AND y < 10 GROUP BY 1),
    p AS (SELECT n_nationkey AS area, count(c_custkey) AS pop FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
    SELECT area, incidents, pop, round(incidents / pop, 6) AS rate FROM p LEFT JOIN c USING (area)
    """,
)
def _(t):
    counts = sp.counts_per_area(t.points, t.areas, "x", "y", "ring", "area")
    return a.rate_per_area(counts, _population(t), "area", "incidents", "pop")


def _population(t):
    people = t.customer.groupBy(F.col("c_nationkey").alias("area")).agg(F.count("*").alias("pop"))
    return t.areas.select("area").join(people, "area", "left").na.fill(0, ["pop"])


@query(
    "area_weighted",
    f"""
    WITH {POINTS}, {_WEIGHTS}, c AS (SELECT {_AREA} AS area, count(*) AS incidents FROM points WHERE x < 10 AND y < 10 GROUP BY 1),
    p AS (SELECT n_nationkey AS area, count(c_custkey) AS pop FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
    SELECT strip, round(sum(m::double * incidents), 4) AS incidents, round(sum(m::double * pop), 4) AS pop,
           round(sum(m::double * incidents) / sum(m::double * pop), 4) AS rate
    FROM w JOIN p USING (area) JOIN c USING (area) GROUP BY 1
    """,
    digits=4,
)
def _(t):
    counts = sp.counts_per_area(t.points, t.areas, "x", "y", "ring", "area").join(_population(t), "area")
    weights = sp.overlap_weights(t.strips, t.areas, "strip", "area", "ring")
    sums = a.area_weighted(counts, weights, "area", "strip", ["incidents", "pop"])
    return sums.withColumn("rate", F.try_divide("incidents", "pop"))


@query(
    "ring_area",
    """
    SELECT 'area ' || n_nationkey AS name, 4.0::double AS area FROM nation
    UNION ALL SELECT 'region ' || r_regionkey, round(2 * 1.50005::double * 1.50005, 6) FROM region
    """,
)
def _(t):
    named = lambda df, key, kind: df.select(F.concat(F.lit(kind), F.col(key).cast("string")).alias("name"), g.ring_area("ring").alias("area"))
    return named(t.areas, "area", "area ").unionByName(named(t.diamonds, "region", "region "))


@query(
    "reprojection_round_trip",
    """
    SELECT c_custkey, round(1400000.0::double + c_custkey % 997 * 100, 3) AS x, round(400000.0::double + c_custkey % 641 * 70, 3) AS y FROM customer
    """,
    digits=3,
)
def _(t):
    x, y = F.lit(1400000.0) + F.col("c_custkey") % 997 * 100, F.lit(400000.0) + F.col("c_custkey") % 641 * 70
    there = t.customer.select("c_custkey", g.lcc_to_lonlat(x, y).alias("p"))
    back = g.lonlat_to_lcc(g.point_x("p"), g.point_y("p"))
    return there.select("c_custkey", back.alias("q")).select("c_custkey", "q.x", "q.y")


def _box(x, y, side_x, side_y, clockwise=False):
    corners = [(x, y), (x + side_x, y), (x + side_x, y + side_y), (x, y + side_y)]
    return F.array(*[F.struct(F.lit(a).cast("double").alias("x"), F.lit(b).cast("double").alias("y")) for a, b in corners[:: -1 if clockwise else 1]])


def _frames(t):
    """Regions as strips with a hole and a second part; rings run in either direction."""
    x = F.col("r_regionkey") * 2 + 0.5
    rings = F.array(_box(x + 0.5, 2.5, 1, 2), _box(x, 0.5, 2, 6, clockwise=True), _box(x, 8, 1, 1))
    return t.region.select(F.col("r_regionkey").alias("strip"), rings.alias("rings"))


# a strip's outline, hole and second part as boxes (sign, left, bottom, width, height)
_FRAMES_SQL = """
    f AS (SELECT r_regionkey AS strip, unnest([{'s': 1, 'x': 0.0, 'y': 0.5, 'w': 2.0, 'h': 6.0}, {'s': -1, 'x': 0.5, 'y': 2.5, 'w': 1.0, 'h': 2.0},
                 {'s': 1, 'x': 0.0, 'y': 8.0, 'w': 1.0, 'h': 1.0}]) AS b FROM region),
    b AS (SELECT strip, b.s AS s, 2 * strip + 0.5 + b.x AS x, b.y AS y, b.w AS w, b.h AS h FROM f)
"""


@query(
    "overlap_weights_of_parts_and_holes",
    f"""
    WITH {_FRAMES_SQL}, n AS (SELECT n_nationkey AS area, n_nationkey % 5 * 2 AS nx, n_nationkey // 5 * 2 AS ny FROM nation)
    SELECT strip, area, round(sum(s * greatest(least(x + w, nx + 2) - greatest(x, nx), 0) * greatest(least(y + h, ny + 2) - greatest(y, ny), 0) / 4)::double, 6) AS multiplier
    FROM b, n GROUP BY ALL HAVING bool_or(s = 1 AND x <= nx + 2 AND x + w >= nx AND y <= ny + 2 AND y + h >= ny)
    """,
)
def _(t):
    cells = t.areas.select("area", F.array("ring").alias("rings"))
    return sp.overlap_weights(_frames(t), cells, "strip", "area", "rings", several=True)


@query(
    "intersects_any_of_parts_and_holes",
    f"""
    WITH {_FRAMES_SQL}, c AS (SELECT c_custkey, c_custkey % 97 / 9.0 + 0.013 AS cx, c_custkey % 89 / 9.0 + 0.017 AS cy FROM customer),
    m AS (SELECT c_custkey, strip, bool_or(s = 1 AND x <= cx + 0.3 AND x + w >= cx AND y <= cy + 0.3 AND y + h >= cy)
                 AND NOT bool_or(s = -1 AND x < cx AND cx + 0.3 < x + w AND y < cy AND cy + 0.3 < y + h) AS meets FROM b, c GROUP BY ALL)
    SELECT c_custkey FROM m GROUP BY 1 HAVING bool_or(meets)
    """,
)
def _(t):
    squares = t.customer.select("c_custkey", F.array(_box(F.col("c_custkey") % 97 / 9.0 + 0.013, F.col("c_custkey") % 89 / 9.0 + 0.017, 0.3, 0.3)).alias("rings"))
    return sp.intersects_any(squares, _frames(t), "c_custkey", "rings", "strip", several=True).select("c_custkey")


# The parameters of EPSG:3735 and of its ellipsoid. The latitude is found by iteration here.
_CONE_SQL = """
    p AS (SELECT radians(38 + 44 / 60.0::double) AS f1, radians(40 + 2 / 60.0::double) AS f2, radians(38.0::double) AS f0, 6378137.0::double AS a,
                 sqrt(2 / 298.257222101::double - 1 / 298.257222101::double ^ 2) AS e),
    k AS (SELECT *, cos(f1) / sqrt(1 - (e * sin(f1)) ^ 2) AS m1, cos(f2) / sqrt(1 - (e * sin(f2)) ^ 2) AS m2,
                 tan(pi() / 4 - f1 / 2) / ((1 - e * sin(f1)) / (1 + e * sin(f1))) ^ (e / 2) AS t1,
                 tan(pi() / 4 - f2 / 2) / ((1 - e * sin(f2)) / (1 + e * sin(f2))) ^ (e / 2) AS t2,
                 tan(pi() / 4 - f0 / 2) / ((1 - e * sin(f0)) / (1 + e * sin(f0))) ^ (e / 2) AS t0 FROM p),
    n AS (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM k),
    c AS (SELECT *, a * m1 / (n * t1 ^ n) AS af, a * m1 / (n * t1 ^ n) * t0 ^ n AS rho0 FROM n),
    g AS (SELECT c_custkey, corner, (x * 1200 / 3937 - 600000) AS east, rho0 - y * 1200 / 3937 AS north, af, n, e FROM c, corners),
    it AS (SELECT *, (sqrt(east ^ 2 + north ^ 2) / af) ^ (1 / n) AS t, pi() / 2 - 2 * atan((sqrt(east ^ 2 + north ^ 2) / af) ^ (1 / n)) AS phi, 0 AS step FROM g
           UNION ALL SELECT * REPLACE (pi() / 2 - 2 * atan(t * ((1 - e * sin(phi)) / (1 + e * sin(phi))) ^ (e / 2)) AS phi, step + 1 AS step) FROM it WHERE step < 9)
"""


@query(
    "layer_reprojected",
    f"""
    WITH RECURSIVE corners AS (
      SELECT c_custkey, i AS corner, 1400000.0::double + c_custkey % 997 * 100 + (i IN (1, 2))::int * 500 AS x, 400000.0::double + c_custkey % 641 * 70 + (i >= 2)::int * 300 AS y
      FROM customer, (SELECT unnest(range(4)) AS i)),
    {_CONE_SQL}
    SELECT c_custkey, corner, round(degrees(atan2(east, north) / n) - 82.5, 7) AS lon, round(degrees(phi), 7) AS lat FROM it WHERE step = 9
    """,
    digits=7,
)
def _(t):
    """A layer of squares in state plane feet, each with its corners in degrees."""
    squares = t.customer.select("c_custkey", F.array(_box(F.lit(1400000.0) + F.col("c_custkey") % 997 * 100, F.lit(400000.0) + F.col("c_custkey") % 641 * 70, 500, 300)).alias("rings"))
    degrees = squares.select("c_custkey", g.reprojected("rings", several=True)[0].alias("ring"))
    return degrees.select("c_custkey", F.posexplode("ring").alias("corner", "p")).select("c_custkey", "corner", F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))
