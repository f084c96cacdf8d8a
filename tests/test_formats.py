"""Binary formats against files made here, acquisition against servers made here."""

import io
import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import quality, raster, spatial, zones
from tessella.sources import acquire, files, formats


def las(points, kind=1, minor=2):
    """A LAS file: 227 or 375 bytes of header, one record a point (x, y, z as whole numbers of 0.01, class)."""
    size, begin = {0: 20, 1: 28, 6: 30}[kind], 375 if minor == 4 else 227
    head = bytearray(begin)
    head[:4], head[24], head[25] = b"LASF", 1, minor
    struct.pack_into("<HI", head, 94, begin, begin)
    struct.pack_into("<BHI", head, 104, kind, size, 0 if minor == 4 else len(points))
    struct.pack_into("<6d", head, 131, 0.01, 0.01, 0.01, 500000.0, 7000000.0, 0.0)
    if minor == 4:
        struct.pack_into("<Q", head, 247, len(points))
    body = b""
    for x, y, z, c in points:
        record = bytearray(size)
        struct.pack_into("<3i", record, 0, x, y, z)
        record[15 if kind < 6 else 16] = c
        body += record
    return bytes(head) + body


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


POINTS = [(100, 200, -150, 2), (101, 201, 50, 9), (-5, 7, 0, 13)]


def test_las_points():
    for kind, minor in ((0, 2), (1, 2), (6, 4)):
        x, y, z, c = formats.las_points(las(POINTS, kind, minor))
        assert np.allclose(x, [500001.0, 500001.01, 499999.95]) and np.allclose(y, [7000002.0, 7000002.01, 7000000.07]) and np.allclose(z, [-1.5, 0.5, 0])
        assert c.tolist() == [2, 9, 13]
    flagged = bytearray(las(POINTS, 0))
    flagged[227 + 15] |= 0x80  # a flag beside the class
    assert formats.las_points(bytes(flagged))[3][0] == 2
    for bad in (b"", b"LASX" + bytes(300), las(POINTS)[:-3], las(POINTS)[:104] + b"\x81" + las(POINTS)[105:]):
        with pytest.raises((ValueError, IndexError)):
            formats.las_points(bad)


def test_las_tiles_of_nested_archives(spark, tmp_path):
    plain, inner = las(POINTS), zipped([("readme.txt", b"x"), ("a/T.LAS", las(POINTS[:1]))])
    for name, data in (("plain.las", plain), ("one.zip", zipped([("x.txt", b""), ("b.las", las(POINTS[:2])), ("a.laz", b"LASF")])), ("nested.zip", zipped([("in.zip", inner)])), ("empty.zip", zipped([("x.txt", b"")])), ("bad.las", b"junk")):
        (tmp_path / name).write_bytes(data)
    got = formats.las_tiles(spark, str(tmp_path)).withColumn("name", F.element_at(F.split("tile_id", "/"), -1))
    rows = {r["name"]: (r["status"], r["n"]) for r in got.groupBy("name").agg(F.first("status").alias("status"), F.count("pt_seq").alias("n")).collect()}
    assert rows == {"plain.las": ("ok", 3), "one.zip": ("ok", 2), "nested.zip": ("ok", 1), "empty.zip": ("no_las", 0), "bad.las": ("error", 0)}
    assert [(r.z, r.cls) for r in got.where("name = 'plain.las'").orderBy("pt_seq").collect()] == [(-1.5, 2), (0.5, 9), (0.0, 13)]


def test_archive_members(spark, tmp_path):
    (tmp_path / "t.zip").write_bytes(zipped([(n, b"") for n in ("b/two.LAZ", "a/one.las", "b/one.las", "b/x.txt", "c.zip")]))
    assert [(r.place, r.member) for r in formats.archive_members(spark, str(tmp_path / "t.zip"), "b/").collect()] == [(0, "b/one.las"), (1, "b/two.LAZ")]
    assert formats.zip_members(zipped([]), "b/") == []


def tiff(grid, order="<", tiled=0, deflate=False, predictor=1, nodata=None, west=152.0, north=-24.0, cell=0.5, strip=2):
    """A GeoTIFF of one band."""
    h, w = grid.shape
    kind = {"f": 3, "u": 1, "i": 2}[grid.dtype.kind]
    blocks, (bw, bh) = [], (tiled, tiled) if tiled else (w, strip)
    for r in range(0, h, bh):
        for c in range(0, w, bw):
            part = grid[r : r + bh, c : c + bw]
            if tiled:
                part = np.pad(part, ((0, bh - part.shape[0]), (0, bw - part.shape[1])))
            if predictor == 2:
                part = np.diff(part, axis=1, prepend=np.zeros((part.shape[0], 1), part.dtype)).astype(part.dtype)
            if predictor == 3:
                planes = np.ascontiguousarray(part.astype(part.dtype.newbyteorder(">"))).view(np.uint8).reshape(part.shape[0], part.shape[1], -1).transpose(0, 2, 1).reshape(part.shape[0], -1)
                body = np.diff(planes, axis=1, prepend=np.zeros((planes.shape[0], 1), np.uint8)).astype(np.uint8).tobytes()
            else:
                body = part.astype(part.dtype.newbyteorder(order)).tobytes()
            blocks.append(zlib.compress(body) if deflate else body)
    tags = [(256, "I", [w]), (257, "I", [h]), (258, "H", [grid.itemsize * 8]), (259, "H", [8 if deflate else 1]), (277, "H", [1]), (317, "H", [predictor]), (339, "H", [kind]), (33550, "d", [cell, cell, 0.0]), (33922, "d", [0.0, 0.0, 0.0, west, north, 0.0])]
    tags += [(322, "I", [bw]), (323, "I", [bh])] if tiled else [(278, "I", [bh])]
    if nodata is not None:
        tags.append((42113, "s", f"{nodata}\0".encode()))
    at = 8 + 2 + 12 * (len(tags) + 2) + 4
    starts = []
    for b in blocks:
        starts.append(at)
        at += len(b)
    tags += [(324 if tiled else 273, "I", starts), (325 if tiled else 279, "I", [len(b) for b in blocks])]
    out, more = bytearray({"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, 8) + struct.pack(order + "H", len(tags))), b""
    for tag, code, values in sorted(tags):
        data = values if code == "s" else struct.pack(f"{order}{len(values)}{code}", *values)
        out += struct.pack(order + "HHI", tag, {"H": 3, "I": 4, "d": 12, "s": 2}[code], len(values))
        if len(data) <= 4:
            out += data.ljust(4, b"\0")
        else:
            out += struct.pack(order + "I", at + len(more))
            more += data
    return bytes(out) + bytes(4) + b"".join(blocks) + more


@pytest.mark.parametrize(("order", "tiled", "deflate", "predictor", "kind"), [("<", 0, False, 1, "f4"), (">", 0, True, 1, "f8"), ("<", 16, True, 1, "u1"), ("<", 16, False, 1, "i2"), ("<", 0, True, 2, "u2"), ("<", 16, True, 3, "f4"), (">", 0, True, 3, "f4")])
def test_geotiff(order, tiled, deflate, predictor, kind):
    grid = (np.arange(7 * 21).reshape(7, 21) * 3 % 101).astype(kind)
    band, bounds, none = formats.geotiff(tiff(grid, order, tiled, deflate, predictor, nodata=-9))
    assert (band == grid).all() and bounds == (152.0, -27.5, 162.5, -24.0) and none == -9
    for bad in (b"<html>", b"II" + bytes(8)):
        with pytest.raises((ValueError, struct.error)):
            formats.geotiff(bad)


def test_raster_tiles_on_a_grid(spark, tmp_path):
    a, b = np.full((4, 4), 0.25, "f4"), np.full((4, 4), 0.95, "f4")
    b[0, 0] = np.nan
    (tmp_path / "r_0.tif").write_bytes(tiff(a, west=152.0, north=-24.0))
    (tmp_path / "r_1.tif").write_bytes(tiff(b, west=153.0, north=-24.0))
    (tmp_path / "r_2.tif").write_bytes(b"service error")
    cells = formats.geotiff_cells(spark, str(tmp_path))
    assert cells.where("error IS NOT NULL").count() == 1 and cells.where("freq IS NULL AND error IS NULL").count() == 1
    grid = formats.placed(cells, ("r", -25.5, 152.0, -24.0, 154.0), 0.5)
    m = {(r.row, r.col): round(r.freq, 2) for r in raster.mosaic(grid).collect()}
    assert m == {(i, j): 0.25 if j < 2 or (i, j) == (0, 2) else 0.95 for i in range(3) for j in range(4)}


def shp(shapes):
    body = b""
    for k, rings in enumerate(shapes):
        if rings is None:
            record = struct.pack("<i", 0)
        else:
            xy = [p for r in rings for p in r]
            first = [sum(len(r) for r in rings[:j]) for j in range(len(rings))]
            record = struct.pack("<i4d2i", 5, *([0.0] * 4), len(rings), len(xy)) + struct.pack(f"<{len(rings)}i", *first) + b"".join(struct.pack("<2d", *p) for p in xy)
        body += struct.pack(">2i", k + 1, len(record) // 2) + record
    return struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i", 1000, 5) + bytes(64) + body


def dbf(fields, rows):
    size = 1 + sum(f[2] for f in fields)
    head = struct.pack("<4BIHH20x", 3, 120, 1, 1, len(rows), 32 + 32 * len(fields) + 1, size)
    for name, kind, width, decimals in fields:
        head += name.encode().ljust(11, b"\0") + kind.encode() + bytes(4) + bytes([width, decimals]) + bytes(14)
    body = b"".join((b"*" if r is None else b" ") + b"".join(("" if r is None else str(v)).encode().ljust(f[2])[: f[2]] for v, f in zip(r or [""] * len(fields), fields, strict=True)) for r in rows)
    return head + b"\x0d" + body


FIELDS = (("zone_type", "C", 30, 0), ("zone_name", "C", 20, 0), ("zone_id", "C", 8, 0), ("area", "N", 10, 2))


def test_shapefile_to_geojson(spark, tmp_path):
    square = [(153.0, -27.0), (153.1, -27.0), (153.1, -26.9), (153.0, -26.9), (153.0, -27.0)]
    dotted = [(153.0, -27.0), (153.05, -27.00000001), *square[1:]]
    (tmp_path / "z.shp").write_bytes(shp([[square, [(153.04, -26.96), (153.06, -26.96), (153.05, -26.94), (153.04, -26.96)]], [dotted]]))
    (tmp_path / "z.dbf").write_bytes(dbf(FIELDS, [("Marine National Park Zone ", " Reef", "MNP01", 1.5), ("General Use Zone", "Bay", "GUZ01", "")]))
    got = formats.shapefile(spark, str(tmp_path))
    assert {r.fseq: (r.record["zone_id"], r.record["area"], [len(x) for x in r.rings]) for r in got.collect()} == {0: ("MNP01", "1.5", [5, 4]), 1: ("GUZ01", None, [6])}
    f = zones.features(got, "Bay MP", "https://example.org")
    assert {r.zid: (r["name"], r.zt, r.notake, [len(x) for x in r.rings]) for r in f.collect()} == {"MNP01": ("Reef", "MNP", True, [5, 4]), "GUZ01": ("Bay", "GUZ", False, [5])}
    files.write_geojson(f, str(tmp_path / "out"))
    text = spark.read.text(str(tmp_path / "out")).first()[0]
    parsed = json.loads(text)
    assert ": " not in text and parsed["type"] == "FeatureCollection" and [x["properties"]["zid"] for x in parsed["features"]] == ["MNP01", "GUZ01"]
    assert parsed["features"][0]["geometry"]["coordinates"][0][0] == [153.0, -27.0]
    (tmp_path / "in.geojson").write_text(text)
    back = files.zones_geojson(spark, str(tmp_path / "in.geojson"))
    assert quality.contract_violations(back).count() == 0 and back.count() == 2
    assert quality.collection_violations(spark.read.text(str(tmp_path / "in.geojson"), wholetext=True)).count() == 0
    with pytest.raises(Exception, match="unknown zone type"):
        spark.range(1).select(F.lit("Harbour").alias("k")).select(zones.code_of("k")).collect()


def test_collection_rules(spark):
    good = {"type": "Feature", "properties": {k: None for k in ("name", "zt", "zid", "notake", "plan", "src")}, "geometry": {"type": "Polygon", "coordinates": []}}
    texts = ["{", json.dumps({"type": "Feature"}), json.dumps({"type": "FeatureCollection", "features": []}), json.dumps({"type": "FeatureCollection", "features": [good, {**good, "type": "x"}, {**good, "properties": {"name": 1}}, {**good, "geometry": {"type": "Point"}}]})]
    rules = [sorted((r.fseq if r.fseq is not None else -1, r.rule) for r in quality.collection_violations(spark.createDataFrame([(t,)], "value string")).collect()) for t in texts]
    assert [r[0] for r in rules[:3]] == [(-1, "0_parse"), (-1, "0_collection"), (-1, "0_features")]
    assert rules[3] == [(1, "0_feature"), *[(2, "0_property")] * 5, (3, "0_geometry")]


def test_rings(spark):
    zig = [(x / 100, 0.00001 * (x % 2)) for x in range(101)] + [(1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    bow = [(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]
    openly = [(0.0, 0.0), (0.0, 0.0), (2.0, 0.0), (2.0, 2.0)]
    df = spark.createDataFrame([(1, [zig]), (2, [bow]), (3, [openly]), (4, [[(0.0, 0.0), (1.0, 1.0)]]), (5, None)], f"k int, rings {zones.RINGS}")
    got = {r.k: (r.ok, r.fixed, r.slim) for r in df.select("k", zones.valid()("rings").alias("ok"), F.transform(zones.repaired()("rings"), lambda x: F.size(x)).alias("fixed"), F.transform(zones.simplified()("rings"), lambda x: F.size(x)).alias("slim")).collect()}
    assert got == {1: (True, [104], [5]), 2: (False, [5], [5]), 3: (False, [4], [4]), 4: (False, [], [2]), 5: (False, None, None)}
    fine = df.where("k = 1").select(zones.rounded("rings", 2).alias("r")).first().r[0]
    assert all(round(v.x, 2) == v.x for v in fine)


def test_holes(spark):
    box = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    m = spark.createDataFrame([(1, 0, "outer", box(0.0, 10.0)), (1, 1, "inner", box(4.0, 6.0)), (1, 2, "inner", box(20.0, 21.0)), (1, 3, "outer", box(19.0, 30.0)), (1, 4, "inner", box(1.0, 2.0)), (2, 0, "outer", box(0.0, 1.0))], "rel_id int, pos int, role string, ring array<struct<x: double, y: double>>")
    assert {(r.rel_id, r.pos): [x[0].x for x in r.rings] for r in spatial.with_holes(m).collect()} == {(1, 0): [0.0, 4.0, 1.0], (1, 3): [19.0, 20.0], (2, 0): [0.0]}


def test_holes_of_many_rings(spark):
    """Rings of many sizes and equal ones, more than a thousand holes in one, against all pairs; rings meet only on cells."""
    box = lambda x, y, a: [(x, y), (x + a, y), (x + a, y + a), (x, y + a)]
    outer = [(k % 2, k, "outer", (float(k * 37 % 100 - 50), float(k * 91 % 100 - 50), 0.5 * 2.0 ** (k % 8))) for k in range(0, 400)] + [(0, 400, "outer", (-100.0, -100.0, 300.0)), (1, 401, "outer", (0.0, 0.0, 0.0))]
    inner = [(k % 2, k, "inner", (float(k * 53 % 100 - 50) + 0.3, float(k * 29 % 101 - 50) + 0.3, 0.25)) for k in range(1000, 3100)]
    m = spark.createDataFrame([(r, k, role, box(*b)) for r, k, role, b in outer + inner] + [(0, 5000, "outer", None), (None, 5001, "inner", box(0.0, 0.0, 1.0))], "rel_id int, pos int, role string, ring array<struct<x: double, y: double>>")
    got = spatial.holes_of(m, of="pos")
    holds = lambda o, i: all(o[c] <= i[c] + 0.125 < o[c] + o[2] for c in (0, 1))
    want = {(r, k): [j for q, j, _, i in inner if q == r and holds(o, i)] for r, k, _, o in outer} | {(0, 5000): []}
    assert {(x.rel_id, x.pos): x.holes for x in got.collect()} == want and len(want[0, 400]) == 1050
    meet = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert sum("bx#" in line and "by#" in line for line in meet) == 1


def test_masks_as_arrays(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, 0, True), ("a", 2, 1, True), ("a", 1, 1, None), ("b", 0, 1, False)], "region string, row int, col int, bit boolean")
    formats.save_masks(df, str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    grid = np.load(io.BytesIO(stored.where("region = 'a'").first().npy))
    assert grid.tolist() == [[True, False], [False, False], [False, True]]
    assert sorted((r.row, r.col) for r in formats.mask_cells(stored).where("bit").collect()) == [(0, 0), (2, 1)]


def test_rle_payload(spark, tmp_path):
    bits = spark.createDataFrame([("r", 0, True), ("r", 1, True), ("r", 2, False), ("r", 3, False)], "region string, i long, bit boolean")
    boxes = spark.createDataFrame([(1, "r", -25.0, 152.0, -24.0, 153.0)], spatial.REGION_SCHEMA)
    files.write_rle(raster.encode(raster.run_lengths(bits)), boxes, str(tmp_path / "p"), 0.5)
    got = json.loads(spark.read.text(str(tmp_path / "p")).first()[0])
    assert got == {"v": 1, "cell": 0.5, "freqMin": 0.2, "regions": [{"key": "r", "s": -25.0, "w": 152.0, "n": -24.0, "e": 153.0, "cols": 2, "rows": 2, "rle": "AAIC"}]}


def test_backup_before_append_and_gated_sink(spark, tmp_path):
    old = spark.createDataFrame([("x", "HIT"), ("y", "clean")], "name string, status string")
    new = spark.createDataFrame([("z", "HIT", "gap", "A"), ("x", "HIT", "gap", "B")], "name string, status string, method string, group string")
    path = str(tmp_path / "results")
    old.write.parquet(path)
    files.append_results(spark, path, new)
    assert sorted(r.name for r in spark.read.parquet(path).collect()) == ["x", "x", "y", "z"]
    assert sorted(r.name for r in spark.read.parquet(path + ".before").collect()) == ["x", "y"]
    with pytest.raises(ValueError, match="before"):
        files.append_results(spark, path, new)
    points = spark.createDataFrame([(1.0, 2.0, -1.0)], "lat double, lng double, depth double")
    with pytest.raises(quality.GateError):
        files.write_gated(points, str(tmp_path / "csv"))
    assert not (tmp_path / "csv").exists()
    files.write_gated(points.unionByName(spark.createDataFrame([(1.0, 2.5, 30.0)] * 2, points.schema)), str(tmp_path / "csv"))
    assert files.depth_csv(spark, str(tmp_path / "csv")).count() == 3


def test_versions_and_undo(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    assert files.versions(spark, path) == []
    assert [files.save_version(rows(1), path), files.save_version(rows(1, 2), path)] == [1, 2]
    (tmp_path / "t" / "version=9").mkdir()  # not written to its end
    assert files.undo(spark, path) == 3 and [r.k for r in files.version(spark, path).collect()] == [1]
    assert files.version(spark, path, 2).count() == 2 and files.versions(spark, path) == [1, 2, 3]
    with pytest.raises(ValueError):
        files.version(spark, path, 9)


def test_requests_and_retries():
    box = (-25.0, 152.0, -24.75, 152.25)
    q = acquire.water_query(box)
    assert q.count("-25.0,152.0,-24.75,152.25") == 7 and 'way["natural"="coastline"]' in q and q.endswith("out geom;")
    assert "width=8&height=8" in acquire.coverage_request("https://example.org/ows", "freq", box, 0.03125)
    assert acquire.checked_tiff(b"II*\0") == b"II*\0"
    with pytest.raises(ValueError):
        acquire.checked_tiff(b"<?xml")
    waits, calls = [], iter([OSError(), OSError(), b"ok"])

    def get():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert acquire.with_retries(get, sleep=waits.append) == b"ok" and waits == [5.0, 10.0]
    with pytest.raises(RuntimeError):
        acquire.with_retries(lambda: 1 / 0, tries=2, sleep=waits.append)


def test_quartering_and_empty_answers():
    asked = []

    def small_boxes_only(query):
        south, west, north, east = map(float, query.split("](")[1].split(")")[0].split(","))
        asked.append((south, west, north, east))
        if north - south > 0.3:
            raise OSError("timeout")
        return json.dumps({"elements": [{"type": "way", "id": 1}, {"type": "way", "id": int(west * 100)}]}).encode()

    got = acquire.elements((0.0, 0.0, 1.0, 1.0), [small_boxes_only])
    assert sorted(e["id"] for e in got) == [0, 1, 25, 50, 75] and len(asked) == 1 + 4 + 16
    with pytest.raises(RuntimeError):
        acquire.elements((0.0, 0.0, 8.0, 8.0), [small_boxes_only])
    empty, fails = (lambda q: b'{"elements": []}'), (lambda q: 1 / 0)
    one = lambda q: b'{"elements": [{"type": "node", "id": 5}]}'
    box = (0.0, 0.0, 1.0, 1.0)
    assert acquire.elements(box, [empty, fails]) == [] == acquire.elements(box, [empty, empty, one])
    assert len(acquire.elements(box, [empty, one])) == 1 and acquire.elements(box, [empty, one], ocean=0.95) == []
