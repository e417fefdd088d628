"""Zones as tables of ring vertices (zone_id, part, ring, seq, x, y): measures, cells, containment.

A zone has one or more parts; ring 0 of a part is its outer ring, the others are holes in it.  Tables without part or ring are of
one ring a zone.  A ring may repeat its first vertex at the end or not.  Rings without three vertices have area 0 and hold
no point; points with a null coordinate are in no zone.  A point is inside where it lies within an odd number of rings.
Work is spread by zone and grid cell: a point meets only the zones whose bounding box touches its cell, and then only
their edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RING = ["zone_id", "part", "ring"]
_ROUND_EARTH_DEGREE = 111_000.0  # metres of a degree, as error distances are turned into degrees


def degrees(metres: Column) -> Column:
    """An error distance in metres as a buffer in degrees."""
    return metres / F.lit(_ROUND_EARTH_DEGREE)


def vertices(df: DataFrame, zone: str, wkt: str) -> DataFrame:
    """zone_id, part, ring, seq (each from 0), x, y of a column of POLYGON and MULTIPOLYGON texts.

    Numbers may have signs and exponents; further coordinates of a point (Z, M) are not taken.  Null texts and EMPTY ones give no
    rows; any other text fails the query, so that no zone is silently wrong."""
    t = F.trim(F.regexp_replace(F.upper(F.col(wkt)), r"\s+", " "))
    head = r"^(?:SRID=[0-9]+ ?; ?)?(MULTIPOLYGON|POLYGON)(?: ?(?:ZM|Z|M))?(?= ?\(| EMPTY$)"
    body = F.regexp_replace(F.trim(F.regexp_replace(t, head, "")), r" ?([(),]) ?", "$1")
    n = F.when(F.regexp_extract(t, head, 1) == "MULTIPOLYGON", 3).otherwise(2)
    rows = df.select(F.col(zone).alias("zone_id"), t.alias("__t"), body.alias("__b"), n.alias("__n")).where(F.col("__t").isNotNull() & (F.col("__b") != "EMPTY"))
    sound = F.col("__t").rlike(head) & F.expr("left(__b, __n) = repeat('(', __n) and right(__b, __n) = repeat(')', __n)")
    bad = F.raise_error(F.concat(F.lit("no polygon: "), F.left("__t", F.lit(200))))
    inner = F.when(sound, F.expr("substr(__b, __n + 1, length(__b) - 2 * __n)")).otherwise(bad.cast("string"))
    parts = rows.select("zone_id", "__t", F.posexplode(F.split(inner, r"\)\),\(\(")).alias("part", "__r"))
    rings = parts.select("zone_id", "__t", "part", F.posexplode(F.split("__r", r"\),\(")).alias("ring", "__p"))
    points = rings.select("zone_id", "__t", "part", "ring", F.posexplode(F.split("__p", ",")).alias("seq", "__p"))
    at = F.split("__p", " ")
    number = lambda i: F.coalesce(F.get(at, F.lit(i)).try_cast("double"), bad.cast("double"))
    return points.select("zone_id", "part", "ring", "seq", number(0).alias("x"), number(1).alias("y"))


def _whole(v: DataFrame) -> DataFrame:
    """The vertex table with part and ring, 0 where it has none."""
    return v.withColumns({c: F.lit(0) for c in ("part", "ring") if c not in v.columns})


def edges(v: DataFrame) -> DataFrame:
    """zone_id, part, ring, seq, x1, y1, x2, y2; the last vertex of a ring leads back to its first."""
    w = Window.partitionBy(*_RING).orderBy("seq")
    nxt = F.coalesce(F.lead(F.struct("x", "y")).over(w), F.first(F.struct("x", "y")).over(w))
    return _whole(v).withColumn("__n", nxt).select(*_RING, "seq", F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("__n.x").alias("x2"), F.col("__n.y").alias("y2"))


def ring_measures(v: DataFrame) -> DataFrame:
    """zone_id, part, ring, signed_area (positive: counter-clockwise), perimeter, and moments mx, my (6 * area * centroid)."""
    turn = F.expr("x1 * y2 - x2 * y1")
    return edges(v).groupBy(*_RING).agg(
        (F.sum(turn) / 2).alias("signed_area"),
        F.sum(F.sqrt(F.expr("(x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)"))).alias("perimeter"),
        F.sum(F.expr("x1 + x2") * turn).alias("mx"),
        F.sum(F.expr("y1 + y2") * turn).alias("my"),
    )


def measures(v: DataFrame) -> DataFrame:
    """zone_id, signed_area (of all rings as they are wound), area (holes off), perimeter (holes too), cx, cy.

    The winding of rings does not matter to area and centroid; a zone of area 0 has a null centroid."""
    side = F.when(F.col("ring") == 0, 1).otherwise(-1) * F.signum("signed_area")
    total = ring_measures(v).groupBy("zone_id").agg(F.sum("signed_area").alias("signed_area"), F.sum(side * F.col("signed_area")).alias("area"), F.sum("perimeter").alias("perimeter"), F.sum(side * F.col("mx")).alias("__x"), F.sum(side * F.col("my")).alias("__y"))
    six = F.nullif(F.col("area") * 6, F.lit(0.0))
    return total.select("zone_id", "signed_area", "area", "perimeter", (F.col("__x") / six).alias("cx"), (F.col("__y") / six).alias("cy"))


def fix_orientation(v: DataFrame) -> DataFrame:
    """The same rings with seq from 0: outer ones counter-clockwise, holes clockwise."""
    a = ring_measures(v).select(*_RING, (F.when(F.col("ring") == 0, F.col("signed_area") < 0).otherwise(F.col("signed_area") > 0)).alias("__turn"))
    n = F.row_number().over(Window.partitionBy(*_RING).orderBy(F.when(F.col("__turn"), -F.col("seq")).otherwise(F.col("seq")))) - 1
    return _whole(v).join(a, _RING).select(*_RING, n.alias("seq"), "x", "y")


def shift_scale(v: DataFrame, dx: float = 0.0, dy: float = 0.0, scale: float = 1.0) -> DataFrame:
    """Rings scaled about their centroids, then moved; zones without area are only moved."""
    c = measures(v).select("zone_id", "cx", "cy")
    out = _whole(v).join(c, "zone_id")
    return out.select(*_RING, "seq", *((F.coalesce(F.col(m) + (F.col(p) - F.col(m)) * scale, F.col(p)) + d).alias(p) for p, m, d in (("x", "cx", dx), ("y", "cy", dy))))


def validity(v: DataFrame) -> DataFrame:
    """A row a ring: zone_id, part, ring, n vertices, closed, few (under 4 with the closing one), bad (null or non-finite), repeated ones."""
    w = Window.partitionBy(*_RING).orderBy("seq")
    ends = _whole(v).withColumn("__last", F.row_number().over(w) == F.count("*").over(Window.partitionBy(*_RING))).withColumn("__first", F.row_number().over(w) == 1)
    bad = F.count_if(F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y") | (F.abs("x") == float("inf")) | (F.abs("y") == float("inf")))
    out = ends.groupBy(*_RING).agg(
        F.count("*").alias("n"),
        F.max(F.when(F.col("__first"), F.struct("x", "y"))).eqNullSafe(F.max(F.when(F.col("__last"), F.struct("x", "y")))).alias("closed"),
        bad.alias("bad"),
        F.count_distinct(F.struct("x", "y")).alias("__distinct"),
    )
    return out.select(*_RING, "n", "closed", (F.col("n") < 4).alias("few"), "bad", (F.col("n") - F.col("__distinct") - F.when(F.col("closed"), 1).otherwise(0)).alias("repeated"))


def cover(v: DataFrame, size: float) -> DataFrame:
    """zone_id, gx, gy: cells whose centre lies in the zone, found row by row of cells.

    A row is cut by the edges that pass its middle; between an odd cut and the next the zone lies.  Work follows the
    edges' heights and the cells found, however large the bounding box is."""
    s = F.lit(float(size))
    rows = edges(v).withColumn("gy", F.explode(F.sequence(F.floor(F.least("y1", "y2") / s) - 1, F.floor(F.greatest("y1", "y2") / s) + 1)))
    middle = (F.col("gy") + 0.5) * s
    cuts = rows.withColumn("__y", middle).where("(y1 > __y) <> (y2 > __y)").select("zone_id", "gy", F.expr("(x2 - x1) * (__y - y1) / (y2 - y1) + x1").alias("cut"))
    w = Window.partitionBy("zone_id", "gy").orderBy("cut")
    spans = cuts.withColumns({"__i": F.row_number().over(w), "upto": F.lead("cut").over(w)}).where("__i % 2 = 1")
    wide = spans.withColumn("gx", F.explode(F.sequence(F.floor(F.col("cut") / s) - 1, F.floor(F.col("upto") / s) + 1)))
    centre = (F.col("gx") + 0.5) * s
    return wide.where((centre >= F.col("cut")) & (centre < F.col("upto"))).select("zone_id", "gx", "gy")


def _box_levels(v: DataFrame, size: float, most: int, classes: list[int]) -> DataFrame:
    """zone_id, class, level, gx, gy: cells of size * 2 ^ level that a zone's bounding box touches, at most about `most`.

    A class k >= 0 is of points with buffers up to size * 2 ^ k: its boxes are grown by that, and its level is k at least."""
    grow = F.when(F.col("class") < 0, F.lit(0.0)).otherwise(F.lit(float(size)) * F.pow(F.lit(2.0), "class"))
    ends = v.groupBy("zone_id").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.min("y").alias("c"), F.max("y").alias("d")).where("a is not null and c is not null")
    ends = ends.withColumn("class", F.explode(F.array(*[F.lit(k) for k in classes])))
    at = lambda x: F.floor(x / F.lit(float(size)))
    box = ends.select("zone_id", "class", at(F.col("a") - grow).alias("a"), at(F.col("b") + grow).alias("b"), at(F.col("c") - grow).alias("c"), at(F.col("d") + grow).alias("d"))
    n = (F.col("b") - F.col("a") + 1).cast("double") * (F.col("d") - F.col("c") + 1)
    box = box.withColumn("level", F.greatest(F.lit(0), "class", F.ceil(F.log2(n / most) / 2)).cast("int"))
    up = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), "level"))
    wide = box.select("zone_id", "class", "level", F.explode(F.sequence(up("a"), up("b"))).alias("gx"), up("c").alias("c"), up("d").alias("d"))
    return wide.select("zone_id", "class", "level", "gx", F.explode(F.sequence("c", "d")).alias("gy"))


def points_in_zones(points: DataFrame, v: DataFrame, point: str, size: float, most: int = 4096, buffer: str | None = None) -> DataFrame:
    """point, zone_id of each containment; points is (point, x, y), repeated ids count as one point each place.

    buffer: a column of points with an error distance in the unit of the coordinates.  A point then counts too where an edge
    of the zone passes within that distance, the distance itself included, so at 0 the zone's edges and vertices are part of
    it; a null or negative distance is none, and the zone is then half open.  A zone is looked up by cells of `size`, or
    of the power of two of it at which its box has about `most`; points with wide buffers use wide cells, so that one of
    them does not widen the search of the others."""
    reach = F.lit(None).cast("double") if buffer is None else F.when(F.col(buffer) >= 0, F.col(buffer).cast("double"))
    p = points.select(point, F.col("x").alias("px"), F.col("y").alias("py"), reach.alias("reach")).distinct()
    p = p.withColumn("class", F.when(F.coalesce("reach", F.lit(0.0)) == 0, -1).otherwise(F.greatest(F.lit(0), F.ceil(F.log2(F.col("reach") / size)))).cast("int"))
    classes = [-1] if buffer is None else [r["class"] for r in p.select("class").distinct().collect()]  # powers of two of one length
    boxes = _box_levels(v, size, most, classes) if classes else None
    levels = boxes.select("class", "level").distinct().collect() if classes else []  # some sixty of each class at most
    if not levels:
        return points.select(point, F.lit(None).cast(v.schema["zone_id"].dataType).alias("zone_id")).limit(0)
    by = F.create_map(*[x for k in classes for x in (F.lit(k), F.array(*[F.lit(r["level"]) for r in levels if r["class"] == k]).cast("array<int>"))])
    p = p.withColumn("level", F.explode(F.element_at(by, F.col("class"))))
    at = lambda c: F.floor(F.floor(F.col(c) / size) / F.pow(F.lit(2.0), "level"))
    candidates = p.withColumns({"gx": at("px"), "gy": at("py")}).join(boxes, ["class", "level", "gx", "gy"]).select(point, "px", "py", "reach", "zone_id")
    crosses = F.expr("(y1 > py) <> (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1")
    near = F.coalesce(edge_distance2(*map(F.col, ("px", "py", "x1", "y1", "x2", "y2"))) <= F.col("reach") * F.col("reach"), F.lit(False))
    met = candidates.join(edges(v).drop("seq", "part", "ring"), "zone_id").select(point, "px", "py", "reach", "zone_id", crosses.alias("__in"), near.alias("__near"))
    held = met.where("__in or __near").groupBy(point, "px", "py", "reach", "zone_id").agg(F.count_if("__in").alias("__n"), F.max("__near").alias("__near"))
    return held.where("__n % 2 = 1 or __near").select(point, "zone_id").distinct()


def edge_distance2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance of a point from the segment between two vertices, which may be one place."""
    dx, dy = x2 - x1, y2 - y1
    along = ((px - x1) * dx + (py - y1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.least(F.greatest(F.coalesce(along, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    ex, ey = px - x1 - t * dx, py - y1 - t * dy
    return ex * ex + ey * ey


def assign(points: DataFrame, v: DataFrame, point: str, size: float) -> DataFrame:
    """Every point with its zone; of several, the lowest id; none: null."""
    found = points_in_zones(points, v, point, size).groupBy(point).agg(F.min("zone_id").alias("zone_id"))
    return points.join(found, point, "left").select(point, "zone_id")


def union_cells(v: DataFrame, groups: DataFrame, group: str, size: float) -> DataFrame:
    """group, n, area: the union of each group's zones as the cells whose centres lie in any of them.

    groups: zone_id and the group's column; a zone may belong to several."""
    covered = cover(v, size).join(groups, "zone_id").select(group, "gx", "gy").distinct()
    return covered.groupBy(group).agg(F.count("*").alias("n"), (F.count("*") * F.lit(float(size * size))).alias("area"))
