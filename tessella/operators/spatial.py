"""Joins by place: nearest reference, boxes, polygons, nearest neighbour. Small dimensions are broadcast after a count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import haversine_km, ring_contains, tide_band
from ..storage import stored

#: Rows of a dimension that are broadcast at most, by count.
BROADCAST_ROWS = 10_000
PORTS = ((1, "Burnett Heads", -24.7607, 152.4063, 3.70, 1.407, 2.176), (2, "Brisbane Bar", -27.3667, 153.1667, 2.81, 1.002, 1.653), (3, "Mooloolaba", -26.6833, 153.1167, 2.24, 0.775, 1.234))
PORT_SCHEMA = "seq int, port string, plat double, plng double, hat double, b1 double, b2 double"
REGIONS = ((1, "woongarra", -24.98, 152.30, -24.66, 152.60), (2, "seq_coast", -27.35, 153.02, -26.34, 153.22), (3, "brisbane_river", -27.66, 152.72, -27.27, 153.34))
REGION_SCHEMA = "rseq int, region string, s double, w double, n double, e double"
ZONE_RANK = {"MNP": 0, "CPZ": 1, "HPZ": 2, "GUZ": 3}


def small(df: DataFrame) -> DataFrame:
    """df, broadcast if it is known to be small."""
    if df.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        raise ValueError(f"a dimension of this join has at most {BROADCAST_ROWS} rows")
    return F.broadcast(df)


def _folded(points: DataFrame, dimension: DataFrame, name: str) -> DataFrame:
    """points with the dimension's rows as one array column: points are not multiplied and keep their partitions."""
    rows = dimension.limit(BROADCAST_ROWS + 1).agg(F.sort_array(F.collect_list(F.struct(*dimension.columns))).alias(name))
    small(dimension)
    return points.crossJoin(F.broadcast(rows))  # one row


def nearest(points: DataFrame, ports: DataFrame, *, lat: str = "lat", lng: str = "lng", within_km: float | None = None) -> DataFrame:
    """points with the fields of the nearest port and km; the first port wins ties; null beyond within_km."""
    p = _folded(points, ports, "__ports")
    key = lambda q: F.struct(haversine_km(lat, lng, q["plat"], q["plng"]).alias("km"), q["seq"].alias("seq"), q["port"].alias("port"), q["hat"].alias("hat"), q["b1"].alias("b1"), q["b2"].alias("b2"))
    best = p.withColumn("__best", F.array_min(F.transform("__ports", key)))
    if within_km is not None:
        best = best.withColumn("__best", F.when(F.col("__best.km") <= within_km, F.col("__best")))
    return best.select(*points.columns, *(F.col(f"__best.{c}").alias(c) for c in ("port", "hat", "b1", "b2", "km")))


def first_box(points: DataFrame, regions: DataFrame, *, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """points with the first region, in order, whose closed box holds them; null outside all."""
    p = _folded(points, regions, "__boxes")
    inside = lambda b: F.col(lat).between(b["s"], b["n"]) & F.col(lng).between(b["w"], b["e"])
    return p.select(*points.columns, F.get(F.filter("__boxes", inside), F.lit(0))["region"].alias("region"))


def polygon_hits(points: DataFrame, zones: DataFrame, *, key: str, x: str = "lng", y: str = "lat", bucket: float = 0.25) -> DataFrame:
    """(key, zone columns) for every polygon that holds a point; zones have `rings` (outer and holes, even-odd).

    Both sides meet on the buckets that a zone's bounding box touches, so the join is by equality at any size.
    """
    ring = F.flatten("rings")
    lo = lambda c: F.floor(F.array_min(F.transform(ring, lambda v: v[c])) / bucket)
    hi = lambda c: F.floor(F.array_max(F.transform(ring, lambda v: v[c])) / bucket)
    z = zones.withColumn("__bx", F.explode(F.sequence(lo("x"), hi("x")))).withColumn("__by", F.explode(F.sequence(lo("y"), hi("y"))))
    p = points.select(key, F.col(x).alias("__x"), F.col(y).alias("__y")).withColumns({"__bx": F.floor(F.col("__x") / bucket), "__by": F.floor(F.col("__y") / bucket)})
    odd = F.aggregate("rings", F.lit(False), lambda a, r: a != ring_contains(r, F.col("__x"), F.col("__y")))
    return p.join(z, ["__bx", "__by"]).where(odd).drop("__bx", "__by", "__x", "__y", "rings")


def most_protective(points: DataFrame, zones: DataFrame, *, key: str, x: str = "lng", y: str = "lat", unknown_rank: int = 98) -> DataFrame:
    """(key, zt, name): of the zones that hold a point the most protective, the first of equals; null outside."""
    rank = F.lit(unknown_rank)
    for name, r in ZONE_RANK.items():
        rank = F.when(F.col("zt") == name, r).otherwise(rank)
    hits = polygon_hits(points, zones, key=key, x=x, y=y).groupBy(key).agg(F.min_by(F.struct("zt", "name"), F.struct(rank, "zseq")).alias("z"))
    return points.select(key).join(hits, key, "left").select(key, "z.zt", "z.name")


def zone_state(points: DataFrame, zones: DataFrame, coverage: DataFrame, *, key: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """zone, outside, unassessed or notloaded for each point: what the zones say where a loaded coverage box holds it."""
    boxed = first_box(points, coverage, lat=lat, lng=lng).select(key, F.col("region").alias("covered"))
    zoned = most_protective(points, zones, key=key, x=lng, y=lat)
    state = F.when(F.col("covered").isNull(), "unassessed").when(F.col("covered").startswith("notloaded"), "notloaded").when(F.col("zt").isNull(), "outside").otherwise("zone")
    return boxed.join(zoned, key).select(key, state.alias("state"), F.when(state == "zone", F.col("zt")).alias("zt"))


def nearest_neighbour(points: DataFrame, targets: DataFrame, *, key: str, target_key: str, cell: float, reach: int = 64) -> DataFrame:
    """Each point's nearest target (x, y, ties to the smallest target_key) and the distance; null beyond reach cells.

    Points probe the 3 x 3 block of cells around their own, then blocks of four times the side. A point is done once its
    best distance is no more than a side, which the block guarantees, so the answer is exact; only the rest goes on, from
    a stored table, and the rounds end when none is left.
    """
    todo = points.select(key, "x", "y")
    t = targets.select(F.col(target_key).alias("tk"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    distance = F.hypot(F.col("x") - F.col("tx"), F.col("y") - F.col("ty"))
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    done, r = None, 1
    while True:
        side = cell * r
        keyed = t.withColumns({"bx": F.floor(F.col("tx") / side), "by": F.floor(F.col("ty") / side)})
        probes = todo.withColumn("o", F.explode(around)).withColumns({"bx": F.floor(F.col("x") / side) + F.col("o.i"), "by": F.floor(F.col("y") / side) + F.col("o.j")})
        best = probes.join(keyed, ["bx", "by"]).groupBy(key).agg(F.min(F.struct(distance.alias("d"), F.col("tk"))).alias("b"))
        met = todo.join(best, key, "left").withColumn("b", F.when(F.col("b.d") <= side, F.col("b")))
        met = met if r >= reach else stored(met)
        found = met.where(F.lit(r >= reach) | F.col("b").isNotNull()).select(key, F.col("b.tk").alias("target"), F.col("b.d").alias("distance"))
        done = found if done is None else done.unionByName(found)
        if r >= reach:
            return done
        todo = met.where("b IS NULL").select(key, "x", "y")
        if todo.isEmpty():
            return done
        r = min(4 * r, reach)


def above_tide(points: DataFrame, *, elevation: str = "e") -> DataFrame:
    """Points not above their port's highest tide, with a band: strictly above goes."""
    return points.where(F.col(elevation) <= F.col("hat")).withColumn("band", tide_band(elevation, "b1", "b2"))


def lattice(south: float, north: float, west: float, east: float, n: int, spark) -> DataFrame:
    """n x n points from corner to corner of a box."""
    k = spark.range(n * n)
    i, j = F.floor(F.col("id") / n), F.col("id") % n
    return k.select("id", (F.lit(south) + i * F.lit((north - south) / (n - 1))).alias("lat"), (F.lit(west) + j * F.lit((east - west) / (n - 1))).alias("lng"))


def tiles(regions: Sequence[tuple], step: float, spark) -> DataFrame:
    """Boxes of `step` degrees that cover each region, clipped to it, numbered in order."""
    r = spark.createDataFrame(list(regions), REGION_SCHEMA)
    steps = lambda a, b: F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.col(b) - F.col(a) - 1e-9) / step) - 1).cast("int"))
    out = r.withColumn("i", F.explode(steps("s", "n"))).withColumn("j", F.explode(steps("w", "e")))
    south, west = F.col("s") + F.col("i") * step, F.col("w") + F.col("j") * step
    return out.select("rseq", "region", "i", "j", south.alias("ts"), west.alias("tw"), F.least(south + step, F.col("n")).alias("tn"), F.least(west + step, F.col("e")).alias("te"))


def quadrants(s: float, w: float, n: float, e: float) -> list[tuple[float, float, float, float]]:
    """A failing box in quarters, for acquisition to try again."""
    y, x = (s + n) / 2, (w + e) / 2
    return [(s, w, y, x), (s, x, y, e), (y, w, n, x), (y, x, n, e)]


def grid_dims(span: Column, cell: float) -> Column:
    return F.greatest(F.lit(1), F.rint(span / cell).cast("int"))


def cell_mesh(regions: DataFrame, cell: float) -> DataFrame:
    """(region, row, col, lat, lng): the centre of every cell of each region's raster; rows count from the north."""
    r = regions.withColumns({"rows": grid_dims(F.col("n") - F.col("s"), cell), "cols": grid_dims(F.col("e") - F.col("w"), cell)})
    r = r.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)))
    lat = F.col("n") - (F.col("row") + 0.5) * (F.col("n") - F.col("s")) / F.col("rows")
    return r.select("region", "row", "col", lat.alias("lat"), (F.col("w") + (F.col("col") + 0.5) * (F.col("e") - F.col("w")) / F.col("cols")).alias("lng"))


def in_any(points: DataFrame, zones: DataFrame, *, keys: Sequence[str], x: str = "lng", y: str = "lat", bucket: float = 0.25) -> DataFrame:
    """points' keys and whether any polygon holds the point: a raster of cell centres, if the points are a mesh."""
    named = points.withColumn("__k", F.struct(*keys))
    hits = polygon_hits(named, zones, key="__k", x=x, y=y, bucket=bucket).select("__k").distinct().withColumn("__hit", F.lit(True))
    return named.join(hits, "__k", "left").select(*keys, F.coalesce("__hit", F.lit(False)).alias("bit"))


def representative(ring: str) -> Column:
    """A point inside a simple ring: half-way between the first two crossings of the line half-way up."""
    r = F.col(ring)
    ys = F.transform(r, lambda v: v["y"])
    pairs = F.zip_with(r, F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1)), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))

    def point(level: Column) -> Column:
        crossed = F.filter(pairs, lambda e: (e["y1"] > level) != (e["y2"] > level))
        xs = F.sort_array(F.transform(crossed, lambda e: (e["x2"] - e["x1"]) * (level - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
        return F.struct(((F.get(xs, F.lit(0)) + F.get(xs, F.lit(1))) / 2).alias("x"), level.alias("y"))

    # The level is a lambda's variable, or each vertex would compute it again.
    return F.get(F.transform(F.array((F.array_min(ys) + F.array_max(ys)) / 2), point), F.lit(0))


def holes_of(members: DataFrame, of: str = "ring") -> DataFrame:
    """(rel_id, pos, ring, holes) for each outer ring of members (rel_id, pos, role, ring); holes: by pos, the column `of` of the
    relation's inner rings that lie in it. Inner rings in no outer ring go.

    Rings and points meet on cells about as wide as the ring (sides are powers of 2, a point is on a cell of each side in
    its relation), an equi-join at any size. Equal rings are compared once, and so are inner rings at one point.
    """
    plain = F.transform("ring", lambda v: F.struct(v["x"].cast("double").alias("x"), v["y"].cast("double").alias("y")))
    once = lambda df, c, name: df.select("*", F.explode(F.array(c)).alias(name))  # noqa: E731  # a generator: computed once for each row
    inner = members.where("role = 'inner'").select("rel_id", F.struct("pos", F.col(of).alias("hole")).alias("hole"), F.explode(F.array("ring")).alias("r"))
    outer = once(members.where("role = 'outer'").select("rel_id", "pos", F.explode(F.array("ring")).alias("ring")), plain, "shape")
    inner = once(inner, representative("r"), "p").select("rel_id", "hole", F.col("p.x").alias("px"), F.col("p.y").alias("py"))
    lo, hi = (lambda c, f=f: f(F.transform("shape", lambda v: v[c])) for f in (F.array_min, F.array_max))
    shapes = outer.select("rel_id", "shape").distinct().withColumns({"x1": lo("x"), "x2": hi("x"), "y1": lo("y"), "y2": hi("y")})
    shapes = shapes.withColumn("extent", F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).where("extent > 0 AND extent < double('infinity')").withColumn("side", F.pow(F.lit(2.0), F.ceil(F.log2("extent"))))
    cell = lambda c: F.floor(F.col(c) / F.col("side"))
    sides = shapes.groupBy("rel_id").agg(F.collect_set("side").alias("sides"))
    shapes = shapes.withColumn("bx", F.explode(F.sequence(cell("x1"), cell("x2")))).withColumn("by", F.explode(F.sequence(cell("y1"), cell("y2"))))
    points = inner.select("rel_id", "px", "py").where("px IS NOT NULL AND py IS NOT NULL").distinct().join(sides, "rel_id").withColumn("side", F.explode("sides")).drop("sides").withColumns({"bx": cell("px"), "by": cell("py")})
    held = shapes.join(points, ["rel_id", "side", "bx", "by"]).where("px BETWEEN x1 AND x2 AND py BETWEEN y1 AND y2").where(ring_contains("shape", F.col("px"), F.col("py")))
    holes = held.select("rel_id", "shape", "px", "py").join(inner, ["rel_id", "px", "py"]).groupBy("rel_id", "shape").agg(F.transform(F.sort_array(F.collect_list("hole")), lambda h: h["hole"]).alias("holes"))
    none = F.array().cast(f"array<{members.schema[of].dataType.simpleString()}>")
    return outer.join(holes, ["rel_id", "shape"], "left").select("rel_id", "pos", "ring", F.coalesce("holes", none).alias("holes"))


def with_holes(members: DataFrame) -> DataFrame:
    """(rel_id, pos, rings) for each outer ring of members: the ring, then the holes that holes_of() finds."""
    return holes_of(members).select("rel_id", "pos", F.concat(F.array("ring"), "holes").alias("rings"))
