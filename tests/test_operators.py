"""Hand-computed cases; expected values do not come from the engine."""

import hashlib
import itertools
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import columns as C
from tessella.functions.columns import geographic_of, grid_of
from tessella.operators import audit, cells, mask, packing, quality, raster, spatial, surface, thin
from tessella.sources import files
from tessella.streaming import ingest

POINT = "tile_id string, tile_seq int, pt_seq long, survey string, rank int, epsg int, x double, y double, z double, cls int"


def test_grids_and_keys(spark):
    r = spark.sql("SELECT 12.5D AS a, 37.5D AS b, -12.5D AS c, -0.1D AS d").select(C.cell_round("a"), C.cell_round("b"), C.cell_round("c"), C.cell_floor("d"), C.cell_floor("b")).first()
    assert tuple(r) == (0, 2, 0, -1, 1)
    key = C.pack_key(F.lit(20120), F.lit(282080))
    assert tuple(spark.range(1).select(key, *C.unpack_key(key)).first()) == (201200282080, 20120, 282080)


def test_projection_golden_and_round_trip(spark):
    p = spark.createDataFrame([(508000.0, 7052000.0, -26.65295, 153.08039), (503000.0, 7062000.0, -26.56268, 153.03012)], "e double, n double, lat double, lng double")
    lat, lng = C.to_geographic("e", "n")
    for r in p.select("*", lat.alias("a"), lng.alias("b")).collect():
        assert abs(r.a - r.lat) < 1e-5 and abs(r.b - r.lng) < 1e-5
    e, n = C.to_grid("a", "b")
    for r in p.select("e", "n", lat.alias("a"), lng.alias("b")).select("e", "n", e.alias("x"), n.alias("y")).collect():
        assert math.hypot(r.e - r.x, r.n - r.y) < 1e-3


def test_offset_and_band_bounds_are_strict(spark):
    lats = spark.createDataFrame([(-26.5329,), (-26.533,), (-26.908,), (-26.9081,)], "lat double")
    assert [r[0] for r in lats.select(C.lat_offset("lat")).collect()] == [1.15, 1.0, 1.26, 1.26]
    e = spark.createDataFrame([(-0.01,), (0.0,), (1.0,), (1.1,), (2.0,), (2.1,)], "e double").withColumns({"b1": F.lit(1.0), "b2": F.lit(2.0)})
    assert [r[0] for r in e.select(C.tide_band("e", "b1", "b2")).collect()] == ["blue", "teal", "teal", "amber", "amber", "gold"]


@pytest.mark.parametrize("partitions", [1, 5])
def test_rank_priority(spark, partitions):
    rows = [
        ("b", 2, 1, "s", 1, 28356, 1.0, 1.0, 9.0, 2),
        ("a", 1, 1, "s", 2, 28356, 2.0, 2.0, 1.0, 2),
        ("c", 3, 1, "s", 1, 7856, 3.0, 3.0, 2.0, 2),
        ("c", 3, 2, "s", 1, 7856, 4.0, 4.0, 5.0, 2),
        ("c", 3, 3, "s", 1, 7856, 5.0, 5.0, -3.0, 2),
        ("c", 3, 4, "s", 0, 7856, 5.0, 5.0, -3.0001, 2),
        ("c", 3, 5, "s", 0, 7856, 5.0, 5.0, 1.0, 9),
    ]
    p = spark.createDataFrame(rows, POINT).repartition(partitions)
    got = cells.rank_priority_cells(cells.ground(p), ("tile_seq", "pt_seq")).collect()
    assert [tuple(r) for r in got] == [(0, 0, 1, 2.0, 3.0, 3.0, 7856, 3)]


def test_two_level_median_is_not_pooled(spark):
    rows = [("a", 1, k, "s", 1, 1, 0.0, 0.0, z, 13) for k, z in enumerate((1.0, 3.0))] + [("b", 2, 1, "s", 1, 1, 0.0, 0.0, 10.0, 13)]
    r = cells.two_level_median(spark.createDataFrame(rows, POINT)).first()
    assert (r.z, r.n, r.n_tiles) == (pytest.approx((2 * 2 + 10) / 3), 3, 2)


def test_audit_thresholds_status_and_summary(spark):
    c = spark.createDataFrame(
        [("t1", "s", 0, 0, 20, 100, 1.0, 1.5), ("t1", "s", 0, 1, 19, 100, 1.0, 1.0), ("t2", "s", 0, 0, 20, 99, 1.0, 1.0), ("t2", "s", 1, 0, 20, 100, 1.0, 1.51), ("t3", "u", 0, 0, 5, 0, 1.0, None)],
        "tile_id string, survey string, cx long, cy long, c9 long, c2 long, z9 double, z2 double",
    )
    assert c.where(audit.adjacent()).count() == 1
    t = audit.tile_status(c, audit.adjacent())
    assert {r.tile_id: (r.status, r.sus_cells, r.mean_density) for r in t.collect()} == {"t1": ("HIT", 1, 100), "t2": ("clean", 0, None), "t3": ("clean_by_absence", 0, None)}
    total = audit.survey_summary(t, 1).where("is_total = 1").first()
    assert (total.survey, total.n_tiles, total.n_hit, total.artifact_km2) == (None, 3, 1, 0.000625)
    a = spark.createDataFrame([("x", "HIT")], "name string, status string")
    with pytest.raises(ValueError):
        audit.merge_results(a, a)
    with pytest.raises(ValueError):
        audit.require_match(audit.count_check(spark.createDataFrame([("t", 1)], "tile_id string, n_cells long"), spark.createDataFrame([("t", 2)], "tile_id string, expected long")))


def test_masks(spark):
    m = mask.union_of(spark.createDataFrame([(28356, [(0, 0), (0, 0)]), (7856, [(5, 5)])], "epsg int, cells array<struct<cx: long, cy: long>>"))
    assert m.count() == 2
    rows = spark.createDataFrame([(1, 28356, 1.0, 1.0, 200.0, 200.0), (2, 7856, 1.0, 1.0, 126.0, 126.0), (3, 7856, 1.0, 30.0, 200.0, 200.0)], "id int, epsg int, x double, y double, x2 double, y2 double")
    assert {r.id for r in mask.drop_native(rows, m).collect()} == {2, 3}
    once = mask.drop_any(rows, m, ((28356, "x", "y"), (7856, "x2", "y2")))
    assert {r.id for r in once.collect()} == {3}
    assert mask.drop_any(once, m, ((28356, "x", "y"),)).count() == once.count()


def test_thinning(spark):
    rows = [(1, 0, -1.0), (2, 0, 3.0), (3, 0, 3.0), (4, 1, -1.0), (5, 1, -4.0), (6, 2, 0.0), (7, 2, -9.0)]
    p = spark.createDataFrame(rows, "row_id long, cell long, depth double").repartition(3)
    assert sorted(r.row_id for r in thin.conditional_argmax(p, ("cell",), "depth", "row_id").collect()) == [2, 5, 6]
    d = thin.rule_differences(p, ("cell",), "depth", "row_id").first()
    assert (d.n_cells, d.differs_signed, d.flips_magnitude) == (3, 1, 1)


def test_listings_in_their_own_form(spark):
    place = "QLD Government/Point Clouds/AHD/"
    lines = [
        f"  123456 2022-10-01 10:22:33 {place}Sunshine_Coast_2022_LGA_SW_480000_7080000_1k.zip",
        f"9 2009-1-1 1:02:03 {place}MoretonBay_2009_LGA_sw_500000_6990000_1K_DEM.zip more",
        f"9 2009-1-1 1:02:03 {place}A_SW_1_SW_2_3_1k.las",
        f"9 2009-1-1 1:02:03 {place}Unknown_2009_LGA_SW_1_2_1k.zip",
        f"9 2009-1-1 1:02:03 {place}MoretonBay_2009_LGA_SW_1_2_2k.zip",
        "9 2009-1-1 1:02:03 Elsewhere/MoretonBay_2009_LGA_SW_1_2_1k.zip",
        "",
    ]
    surveys = spark.createDataFrame([("Sunshine_Coast_2022_LGA", 1), ("MoretonBay_2009_LGA", 3), ("A_SW_1", 4), ("LGA", 9)], "survey string, rank int")
    got = {(r.survey, r.name, r.e, r.n, r["rank"]) for r in quality.manifest(spark.createDataFrame([(x,) for x in lines], "line string"), surveys).collect()}
    assert got == {("Sunshine_Coast_2022_LGA", "Sunshine_Coast_2022_LGA_SW_480000_7080000_1k.zip", 480000, 7080000, 1), ("MoretonBay_2009_LGA", "MoretonBay_2009_LGA_sw_500000_6990000_1K_DEM.zip", 500000, 6990000, 3), ("A_SW_1", "A_SW_1_SW_2_3_1k.las", 2, 3, 4)}


def test_merge_guards_group_a_only(spark):
    old = spark.createDataFrame([("x", "HIT")], "name string, status string")
    new = lambda *rows: spark.createDataFrame(rows, "name string, status string, method string, group string")
    assert audit.merge_results(old, new(("x", "HIT", "density", "B"), ("y", "clean", "adjacency", "A"))).count() == 3
    with pytest.raises(ValueError):
        audit.merge_results(old, new(("x", "HIT", "adjacency", "A")))
    with pytest.raises(ValueError):
        audit.merge_results(new(("x", "HIT", "density", "B")), new(("y", "HIT", "adjacency", "A")))


def test_empty_answers(spark):
    rows = [(1, 0, 0.0), (1, 0, 0.0), (2, 0, 0.97), (3, 0, 0.0), (3, None, 0.0), (4, 0, 0.0), (5, None, 0.0), (5, None, 0.0), (6, 4, 0.0), (6, 0, 0.0), (7, None, 0.0)]
    got = {r.tile: r.verdict for r in quality.arbitrate_empty(spark.createDataFrame(rows, "tile int, n_elements int, ocean double")).collect()}
    assert got == {1: "empty", 2: "empty", 3: "empty", 4: "ask_again", 5: "failed", 6: "elements", 7: "ask_again"}


def test_kept_values_and_offsets(spark):
    p = spark.createDataFrame([(0, 3.0), (0, -1.0), (1, -2.0), (1, -5.0), (2, 1.0)], "cell int, depth double")
    kept = spark.createDataFrame([(0, 3.0), (1, -2.0), (3, 1.0)], "cell int, depth double")
    got = {r.cell: (r.expected, r.ok) for r in quality.kept_as_expected(p, kept, ("cell",), "depth").collect()}
    assert got == {0: (3.0, True), 1: (-5.0, False), 2: (1.0, False), 3: (None, False)}
    with pytest.raises(quality.GateError):
        quality.require_kept(quality.kept_as_expected(p, kept, ("cell",), "depth"))
    low = spark.createDataFrame([(1.0,), (1.15,)], "offset double")
    assert quality.require_offsets(low).count() == 2 and quality.require_offsets(low.where("false")).count() == 0
    with pytest.raises(quality.GateError):
        quality.require_offsets(low, least=1.01)


def test_grids_by_code(spark):
    p = spark.createDataFrame([(28356, -27.0, 153.0), (28355, -27.0, 147.0), (7856, -26.5, 152.9), (7849, -30.0, 111.2)], "epsg int, lat double, lng double")
    east, north = grid_of("epsg", "lat", "lng")
    rows = p.withColumns({"east": east, "north": north})
    lat, lng = geographic_of("epsg", "east", "north")
    got = rows.select("epsg", "east", (F.abs(lat - F.col("lat")) + F.abs(lng - F.col("lng"))).alias("d")).collect()
    assert all(r.d < 1e-8 for r in got) and [r.east for r in got[:2]] == [pytest.approx(500000), pytest.approx(500000)]
    with pytest.raises(Exception, match="unknown grid"):
        spark.createDataFrame([(4326, 1.0, 1.0)], "epsg int, lat double, lng double").select(*grid_of("epsg", "lat", "lng")).collect()


def test_nearest_neighbour_at_the_reach(spark):
    """Beyond the reach nothing counts, though a farther point may share the last block."""
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 1000.0, 0.0)], "k int, x double, y double")
    t = spark.createDataFrame([(7, 3.9, 0.0), (8, 1005.0, 0.0)], "t int, x double, y double")
    got = {r.k: (r.target, r.distance) for r in spatial.nearest_neighbour(p, t, key="k", target_key="t", cell=1.0, reach=4).collect()}
    assert got == {1: (7, 3.9), 2: (None, None)}


def test_masks_by_region_and_outside(spark):
    regions = spark.createDataFrame([(1, "r", 0.0, 0.0, 1.0, 1.0)], spatial.REGION_SCHEMA)
    bits = spark.createDataFrame([("r", 0, 0, True), ("r", 1, 1, False)], "region string, row int, col int, bit boolean")
    p = spark.createDataFrame([(1, 0.9, 0.1, "own"), (2, 0.1, 0.9, "own"), (3, 0.1, 0.1, "own"), (4, 5.0, 5.0, "own"), (5, 0.1, 0.9, "woongarra"), (6, 1.0, 0.0, None), (7, 0.0, 1.0, "own")], "pid int, lat double, lng double, source string")
    got = {r.pid: r.water for r in surface.on_water(p, regions, bits, 0.5).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: True, 6: True, 7: False}
    assert surface.points_per_km() == 320


def test_interpolation(spark):
    s = spark.createDataFrame([(0.0, 0.0, 1.0), (10.0, 0.0, 3.0), (0.0, 0.0, 2.0), (500.0, 0.0, 9.0)], "x double, y double, depth double")
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 0.0), (3, 2.0, 0.0), (4, 250.0, 0.0), (5, 500.0, 120.0)], "k int, x double, y double")
    got = {r.k: (None if r.depth is None else round(r.depth, 6), r.n) for r in surface.interpolated(p, s, key="k").collect()}
    w = [(1.0, 4.0), (2.0, 4.0), (3.0, 64.0)]
    assert got == {1: (1.5, 3), 2: (2.0, 3), 3: (round(sum(v / d for v, d in w) / sum(1 / d for _, d in w), 6), 3), 4: (None, 0), 5: (9.0, 1)}
    deep = {r.k: (r.depth, r.x, r.y) for r in surface.deepest(p.where("k IN (2, 4)"), s, key="k", radius=10.0, step=5.0, reach=10.0).collect()}
    assert deep == {2: (3.0, 10.0, -5.0)}  # of equals the first by x, then y


def test_interpolation_against_brute_force(spark, monkeypatch):
    """Odd places and samples, very near pairs, and blocks in several parts and chunks."""
    monkeypatch.setattr(surface, "BLOCK_PLACES", 40)
    rng = np.random.default_rng(5)
    s = [(float(x), float(y), float(v)) for x, y, v in zip(rng.integers(-60, 60, 700), rng.integers(-60, 60, 700), rng.normal(0, 50, 700), strict=True)]
    s += [(0.5, 0.5, None), (0.5, 0.5, 7.0), (30.25, 30.25, None), (None, 1.0, 2.0), (math.nan, 1.0, 2.0), (-300.0, -300.0, math.nan), (200.0, 200.0, 3.25), (200.0, 200.000001, -8.5), (1e15, 0.0, 1.0)]
    p = [(k, float(x), float(y)) for k, x, y in zip(range(400), rng.integers(-60, 60, 400), rng.integers(-60, 60, 400), strict=True)]
    p += [(400, 0.5, 0.5), (401, 30.25, 30.25), (None, 1.5, 1.5), (None, -1.5, 2.5), (402, None, 0.0), (403, math.inf, 0.0), (404, 200.0, 200.00000001), (405, -301.0, -300.0), (406, -0.0, 0.0), (406, 9.5, 9.5)]
    got = surface.interpolated(spark.createDataFrame(p, "k int, x double, y double"), spark.createDataFrame(s, "x double, y double, depth double"), key="k", reach=12.0).collect()

    def expected(x, y):
        up = lambda v: int(math.copysign(math.floor(abs(v) + 0.5), v))
        met = [] if x is None or not math.isfinite(x) else [(math.sqrt((x - a) ** 2 + (y - b) ** 2), v) for a, b, v in s if a is not None and math.isfinite(a)]
        met = [(d, v) for d, v in met if d <= 12.0]
        on, off = [v for d, v in met if d == 0], [(12.0 / d, v) for d, v in met if d > 0]
        values = [v for v in on if v is not None] if on else [v for _, v in off if v is not None]
        if not values:
            return None, len(met)
        if any(math.isnan(v) for v in values):
            return "nan", len(met)
        return (sum(up(v * 1e6) for v in values) / 1e6 / len(on) if on else float(sum(up(w * w * v * 1e6) for w, v in off if v is not None)) / float(sum(up(w * w * 1e6) for w, _ in off))), len(met)

    assert sorted(repr((r.k, "nan" if r.depth is not None and math.isnan(r.depth) else r.depth, r.n)) for r in got) == sorted(repr((k, *expected(x, y))) for k, x, y in p)


def test_surface_and_contours(spark):
    s = spark.createDataFrame([(float(x), float(y), float(x)) for x in range(0, 41, 10) for y in range(0, 31, 10)], "x double, y double, depth double")
    grid = surface.surface(s, (0.0, 0.0, 40.0, 30.0), cells=4, reach=5.0)
    assert {(r.row, r.col): r.depth for r in grid.collect()} == {(i, j): 10.0 * j for i in range(4) for j in range(5)}
    lines = surface.contours(grid, 15.0)
    assert sorted((r.level, r.row, r.x1, r.x2) for r in lines.collect()) == [(level, row, level, level) for level in (15.0, 30.0) for row in range(3)]
    saddle = spark.createDataFrame([(0, 0, 0.0, 0.0, 1.0), (0, 1, 1.0, 0.0, 0.0), (1, 0, 0.0, 1.0, 0.0), (1, 1, 1.0, 1.0, 1.0), (0, 2, 2.0, 0.0, None), (1, 2, 2.0, 1.0, 1.0)], "row int, col int, x double, y double, depth double")
    assert len(surface.contours(saddle, 0.5).where("level = 0.5").collect()) == 2


def test_packings(spark):
    rows = [("a", 2, -26.5, 153.0, 1.25), ("a", 1, -26.500001, 153.25, -0.75), ("a", 3, -26.5, 153.0, 100.0), ("b", 1, 0.0, 0.0, 0.0)]
    c = packing.columnar(spark.createDataFrame(rows, "g string, k int, lat double, lng double, depth double"), "g", "k")
    got = {r.g: (r.n, r.lat, r.lng, r.depth) for r in c.collect()}
    assert got["a"] == (3, [-26500001, -26500000, -26500000], [153250000, 153000000, 153000000], [-75, 125, 10000])
    assert {r.g: r.json for r in packing.integer_json(c, "g").collect()}["b"] == '{"lat":[0],"lng":[0],"depth":[0]}'
    raw = {r.g: bytes(r.packed) for r in packing.fixed(c, "g").collect()}["a"]
    assert struct.unpack("<3i3i3h", raw) == (*got["a"][1], *got["a"][2], *got["a"][3])
    with pytest.raises(Exception, match="does not fit"):
        packing.fixed(c, "g", (4, 4, 1)).collect()
    d = packing.numbers_of({r.g: bytes(r.packed) for r in packing.delta_varints(c, "g").collect()}["a"])
    assert [list(itertools.accumulate(d[k : k + 3])) for k in (0, 3, 6)] == list(got["a"][1:])
    near = {r.g: r for r in packing.relative(c, "g").collect()}["a"]
    x = np.frombuffer(bytes(near.packed), "<u2").reshape(3, 3).astype(float)
    for k in range(3):
        back = near.low[k] + x[k] * max(1, near.high[k] - near.low[k]) / 65535
        assert np.abs(back - got["a"][k + 1]).max() <= max(1, near.high[k] - near.low[k]) / 65535


def test_thin_to_cap(spark):
    p = spark.createDataFrame([(k, float(k % 10 * 10), float(k // 10 * 10), float(k % 7 - 3)) for k in range(100)], "row_id int, x double, y double, depth double")
    assert thin.thin_to_cap(p, "depth", "row_id", cap=100, size=5.0).count() == 100
    assert thin.thin_to_cap(p, "depth", "row_id", cap=36, size=5.0).count() <= 36
    with pytest.raises(ValueError):
        thin.thin_to_cap(p, "depth", "row_id", cap=3, size=5.0, doublings=1)
    assert thin.spaced_picks(p.select("row_id", F.lit(3).alias("n")), "row_id").select("row_id", "place").orderBy("place").collect() == [(0, 0), (24, 24), (49, 49), (74, 74), (99, 99)]
    assert thin.spaced_picks(p.select("row_id", F.lit(1).alias("n")), "row_id").count() == 0


def test_incremental_load_skips_what_is_done(spark):
    tiles = spark.createDataFrame([("a",), ("b",)], "tile_id string")
    assert [r.tile_id for r in ingest.unprocessed(tiles, tiles.where("tile_id = 'a'")).collect()] == ["b"]
    assert sorted(map(tuple, quality.merge_by_id(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_reports_in_order(spark):
    r = spark.createDataFrame([("b", "HIT", 60), ("a", "clean", 0)], "survey string, status string, sus_cells int")
    assert [x.survey for x in audit.displayed(audit.survey_summary(r)).collect()] == ["a", "b", None]


def test_json_and_digests(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"outer":"o","path":"p","name":"n2","survey":"s","e":2,"n":1},{"name":"n1","rank":3,"extra":[1]}]')
    m = files.manifest_json(spark, str(tmp_path / "m.json"))
    assert [(r.tile_seq, r.name, r["rank"]) for r in m.orderBy("tile_seq").collect()] == [(0, "n2", None), (1, "n1", 3)]
    files.write_json(m.select("tile_seq", "name"), str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"tile_seq":0,"name":"n2"}', '{"tile_seq":1,"name":"n1"}']
    (tmp_path / "DATA_1.zip.listing.txt").write_bytes(b"x \xff y\n")
    (tmp_path / "DATA_2.zip.listing.txt").write_text("z\n")
    assert [r.outer for r in files.listing(spark, str(tmp_path), ["DATA_1.zip"]).collect()] == ["DATA_1.zip"]
    body = spark.createDataFrame([(bytearray(b"II*"), hashlib.sha256(b"II*").hexdigest().upper())], "content binary, digest string")
    assert body.select(files.checked("content", "digest") & files.is_tiff()).first()[0]
    files.write_depth_csv(spark.createDataFrame([(-26.5, 153.0, 1.25)], "lat double, lng double, depth double").coalesce(1), str(tmp_path / "csv"), fixed=False)
    assert next((tmp_path / "csv").glob("*.csv")).read_bytes() == b"lat,lng,depth\r\n-26.5,153.0,1.25\r\n"


def test_spatial(spark):
    ports = spark.createDataFrame(list(spatial.PORTS), spatial.PORT_SCHEMA)
    p = spark.createDataFrame([(1, -26.68, 153.11, 2.24), (2, -27.30, 153.10, 2.82), (3, 10.0, 10.0, 0.0)], "pid int, lat double, lng double, e double")
    near = spatial.nearest(p, ports, within_km=200)
    assert {r.pid: r.port for r in near.collect()} == {1: "Mooloolaba", 2: "Brisbane Bar", 3: None}
    assert {r.pid for r in spatial.above_tide(near).collect()} == {1}  # strictly above goes
    boxes = spark.createDataFrame(list(spatial.REGIONS), spatial.REGION_SCHEMA)
    assert {r.pid: r.region for r in spatial.first_box(p, boxes).collect()} == {1: "seq_coast", 2: "seq_coast", 3: None}


def test_polygon_with_hole(spark):
    ring = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    z = spark.createDataFrame([(1, "outer", "GUZ", [ring(0.0, 10.0), ring(4.0, 6.0)]), (2, "odd", "???", [ring(0.0, 3.0)]), (3, "core", "MNP", [ring(7.0, 8.0)])], "zseq int, name string, zt string, rings array<array<struct<x: double, y: double>>>")
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 7.5, 7.5), (4, 20.0, 1.0)], "pid int, lng double, lat double")
    assert {r.pid: r.zt for r in spatial.most_protective(p, z, key="pid").collect()} == {1: "GUZ", 2: None, 3: "MNP", 4: None}
    assert {r.pid: r.zt for r in spatial.most_protective(p, z, key="pid", unknown_rank=-1).collect()}[1] == "???"


def test_nearest_neighbour_is_exact(spark):
    pts = [(k, float(k * 37 % 101), float(k * 91 % 103)) for k in range(60)]
    targets = [(k, float(k * 53 % 211) * 3, float(k * 29 % 197) * 2) for k in range(25)]
    got = spatial.nearest_neighbour(spark.createDataFrame(pts, "k int, x double, y double"), spark.createDataFrame(targets, "t int, x double, y double"), key="k", target_key="t", cell=5.0, reach=256)
    want = {k: min((math.hypot(x - a, y - b), t) for t, a, b in targets) for k, x, y in pts}
    assert {r.k: (pytest.approx(r.distance), r.target) for r in got.collect()} == want


def test_raster_and_runs(spark):
    nan = float("nan")
    parts = spark.createDataFrame([("r", 1, 0, 0, 0.1), ("r", 2, 0, 0, 0.9), ("r", 3, 0, 0, nan), ("r", 1, 0, 1, nan)], "region string, tile_seq int, row int, col int, freq double")
    got = {r.col: (r.freq, r.wet) for r in raster.mosaic(parts).select("col", "freq", raster.wet().alias("wet")).collect()}
    assert got == {0: (0.9, True), 1: (None, False)}
    for bits in ([True] * 5, [False] * 5, [False, True, True, False] * 3, [True] * 127 + [False] * 128 + [True] * 16384):
        df = spark.createDataFrame([("r", i, b) for i, b in enumerate(bits)], "region string, i long, bit boolean")
        rle = raster.encode(raster.run_lengths(df)).select(F.unbase64("rle")).first()[0]
        assert list(raster.bits_of(bytes(rle))) == bits
    assert raster.varints([127, 128, 16384]) == b"\x7f\x80\x01\x80\x80\x01"


def test_coast_side_turns_with_the_line(spark):
    c = spark.createDataFrame([(1, 50.0, 10.0), (2, 50.0, -10.0)], "k int, x double, y double")
    line = [(1, 0, 0.0, 0.0), (1, 1, 100.0, 0.0)]
    for way, sea in ((line, {1: False, 2: True}), ([(1, 0, 100.0, 0.0), (1, 1, 0.0, 0.0)], {1: True, 2: False})):
        got = raster.sea_side(c, spark.createDataFrame(way, "way_id int, pos int, x double, y double"), key="k", step=10.0, cell=10.0, reach=64)
        assert {r.k: r.sea for r in got.collect()} == sea


def test_gates(spark):
    empty = spark.createDataFrame([], "depth double")
    with pytest.raises(quality.GateError):
        quality.require_bathymetry(empty)
    ok = spark.createDataFrame([(25.0,), (-1.0,)], "depth double")
    assert quality.require_bathymetry(ok).count() == 2
    with pytest.raises(quality.GateError):
        quality.require_empty(ok, F.col("depth") < 0)


def test_files_and_ingest(spark, tmp_path):
    (tmp_path / "d.csv").write_text("lat,lng,depth\n-26.5,153.0,1.25\nbad,153.0,1\n-26.6,153.1,oops\n")
    d = files.depth_csv(spark, str(tmp_path / "d.csv"))
    assert sorted((r.lat, r.depth) for r in d.collect()) == [(-26.6, None), (-26.5, 1.25)]
    files.write_depth_csv(d.where("depth IS NOT NULL").coalesce(1), str(tmp_path / "out"))
    assert "-26.500000,153.000000,1.25\n" in next((tmp_path / "out").glob("*.csv")).read_text()
    (tmp_path / "z.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"name":"a","zt":"MNP","zid":"1","notake":true,"plan":"p","src":"s"},"geometry":{"type":"Polygon","coordinates":[[[153.0,-27.0],[153.1,-27.0],[153.1,-27.1],[153.0,-27.0]]]}}]}')
    z = files.zones_geojson(spark, str(tmp_path / "z.json"))
    assert z.select(F.size("rings")).first()[0] == 1 and quality.contract_violations(z).count() == 0
    rows = [("a", 1, 1, "s", 1, 1, 0.0, 0.0, 1.0, 2), ("a", 1, 2, "s", 1, 1, 0.0, 0.0, 3.0, 2)]
    src, target, cp = (str(tmp_path / n) for n in ("src", "target", "cp"))
    schema = spark.createDataFrame(rows, POINT).schema
    for tile, part in (("a", rows), ("b", [("b", 2, 1, "s", 1, 1, 0.0, 0.0, 10.0, 2)])):
        spark.createDataFrame(part, POINT).write.mode("append").parquet(src)
        ingest.ingest(spark, src, schema, target, cp)
    ingest.ingest(spark, src, schema, target, cp)
    r = ingest.cells(spark, target).first()
    assert (r.z, r.n) == (pytest.approx(14 / 3), 3)
