"""Binary survey formats, read without other libraries: LAS, zip archives, GeoTIFF, shapefiles, .npy masks.

Each reader takes a file's bytes; the Spark sources hand them one file a row (binaryFile), so a file is a task's unit of
work and a file that fails is a row with its error. Compressed LAS (LAZ) needs a reader that the caller gives.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------- LAS

# Fixed values of the format: where a point's class stands, by point format, and how many of its bits count.
LAS_CLASS_AT = {0: 15, 1: 15, 2: 15, 3: 15, 4: 15, 5: 15, 6: 16, 7: 16, 8: 16, 9: 16, 10: 16}
LAS_OLD_CLASS_BITS = 0x1F


def las_points(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """x, y, z (scaled, with offsets) and classes of an uncompressed LAS file, versions 1.0 to 1.4."""
    if data[:4] != b"LASF":
        raise ValueError("not a LAS file")
    major, minor = data[24], data[25]
    begin, = struct.unpack_from("<I", data, 96)
    kind, length, count = struct.unpack_from("<BHI", data, 104)
    if kind & 0x80:
        raise ValueError("compressed points (LAZ)")
    if kind not in LAS_CLASS_AT:
        raise ValueError(f"point format {kind}")
    if (major, minor) >= (1, 4):
        many, = struct.unpack_from("<Q", data, 247)
        count = many or count
    scale, offset = np.array(struct.unpack_from("<3d", data, 131)), np.array(struct.unpack_from("<3d", data, 155))
    if len(data) < begin + count * length:
        raise ValueError("the file ends within its points")
    raw = np.frombuffer(data, np.uint8, count * length, begin).reshape(count, length)
    place = np.ascontiguousarray(raw[:, :12]).view("<i4") * scale + offset
    cls = raw[:, LAS_CLASS_AT[kind]].astype(np.int32)
    return place[:, 0], place[:, 1], place[:, 2], cls if kind >= 6 else cls & LAS_OLD_CLASS_BITS


def zip_members(data: bytes, prefix: str = "", suffixes: Sequence[str] = (".las", ".laz")) -> list[str]:
    """Names in an archive that begin with prefix and end in one of the suffixes, in whatever case, sorted."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return sorted(n for n in z.namelist() if n.startswith(prefix) and n.lower().endswith(tuple(suffixes)))


def first_las(data: bytes) -> bytes | None:
    """The bytes of a file that is no archive, of an archive's first LAS member, or of that of its first inner archive."""
    if not zipfile.is_zipfile(io.BytesIO(data)):
        return data
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for name in z.namelist():
            if name.lower().endswith((".las", ".laz")):
                return z.read(name)
        for name in z.namelist():
            if name.lower().endswith(".zip"):
                return first_las(z.read(name))
    return None


def las_tiles(spark: SparkSession, path: str, read: Callable[[bytes], tuple] = las_points) -> DataFrame:
    """(tile_id, status, error, pt_seq, x, y, z, cls): points of LAS files, plain or in archives, one task a tile.

    status is ok, no_las (an archive without a LAS member) or error; a tile that is not ok is one row without a point.
    """

    schema = pa.schema([("tile_id", pa.string()), ("status", pa.string()), ("error", pa.string()), ("pt_seq", pa.int64()), ("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64()), ("cls", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                status, error, points = "ok", None, []
                try:
                    body = first_las(data)
                    status, points = ("no_las", []) if body is None else ("ok", read(body))
                except Exception as e:  # the tile's error is its result
                    status, error = "error", str(e)
                if status == "ok":
                    n = len(points[0])
                    columns = [pa.array([name] * n), pa.array([status] * n), pa.nulls(n, pa.string()), pa.array(np.arange(n)), *(pa.array(c, t) for c, t in zip(points, (pa.float64(), pa.float64(), pa.float64(), pa.int32()), strict=True))]
                else:
                    columns = [pa.array([x], t) for x, t in zip((name, status, error, *[None] * 5), schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "tile_id string, status string, error string, pt_seq long, x double, y double, z double, cls int")


def archive_members(spark: SparkSession, path: str, prefix: str = "", suffixes: Sequence[str] = (".las", ".laz")) -> DataFrame:
    """(archive, place, member): the chosen members of archives, in the order of their names."""
    listed = F.udf(lambda data: zip_members(bytes(data), prefix, suffixes), "array<string>")
    files = spark.read.format("binaryFile").load(path).select("path", listed("content").alias("m"))  # a row is an archive
    return files.select(F.col("path").alias("archive"), F.posexplode("m").alias("place", "member"))


# ---------------------------------------------------------------- GeoTIFF

# Fixed values of the format: field types' sizes and codes, tags, sample kinds by (format, bits).
_TIFF_TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
_WIDTH, _HEIGHT, _BITS, _COMPRESSION, _STRIP_AT, _SAMPLES, _STRIP_ROWS, _STRIP_SIZE = 256, 257, 258, 259, 273, 277, 278, 279
_PREDICTOR, _TILE_WIDTH, _TILE_HEIGHT, _TILE_AT, _TILE_SIZE, _FORMAT = 317, 322, 323, 324, 325, 339
_PLANAR, _PIXEL_SCALE, _TIE_POINT, _NO_DATA = 284, 33550, 33922, 42113
_KINDS = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


def geotiff(data: bytes) -> tuple[np.ndarray, tuple[float, float, float, float], float | None]:
    """The first band, (west, south, east, north) and the no-data value of a GeoTIFF: strips or tiles, whole samples,
    uncompressed or deflated, with or without a predictor."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, = struct.unpack_from(order + "I", data, 4)
    tags: dict[int, tuple] = {}
    for k in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if kind in _TIFF_TYPES:
            size, code = _TIFF_TYPES[kind]
            where = at + 10 + 12 * k
            if size * n > 4:
                where, = struct.unpack_from(order + "I", data, where)
            tags[tag] = (data[where : where + n],) if code == "s" else struct.unpack_from(f"{order}{n}{code}", data, where)
    one = lambda tag, default: tags.get(tag, (default,))[0]
    width, height, samples = one(_WIDTH, 0), one(_HEIGHT, 0), one(_SAMPLES, 1)
    kind = _KINDS.get((one(_FORMAT, 1), one(_BITS, 1)))
    if kind is None or one(_COMPRESSION, 1) not in (1, 8, 32946):
        raise ValueError(f"samples {one(_FORMAT, 1)}/{one(_BITS, 1)}, compression {one(_COMPRESSION, 1)}")
    together = samples if one(_PLANAR, 1) == 1 else 1
    tiled = _TILE_AT in tags
    bw, bh = (one(_TILE_WIDTH, 0), one(_TILE_HEIGHT, 0)) if tiled else (width, min(one(_STRIP_ROWS, height), height))
    starts, sizes = tags[_TILE_AT if tiled else _STRIP_AT], tags[_TILE_SIZE if tiled else _STRIP_SIZE]
    across = -(-width // bw)
    out = np.zeros((height, width), np.dtype(kind))
    item = np.dtype(kind).itemsize
    for k in range(across * -(-height // bh)):  # of more planes only the first
        body = data[starts[k] : starts[k] + sizes[k]]
        body = zlib.decompress(body) if one(_COMPRESSION, 1) != 1 else body
        row, left = k // across * bh, k % across * bw
        rows = bh if tiled else min(bh, height - row)
        if one(_PREDICTOR, 1) == 3:  # bytes of a row's samples by significance, as differences
            planes = np.cumsum(np.frombuffer(body, np.uint8)[: rows * bw * together * item].reshape(rows, -1, together), axis=1, dtype=np.uint8).reshape(rows, item, -1)
            block = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.dtype(kind).newbyteorder(">")).reshape(rows, bw, together).astype(kind)
        else:
            block = np.frombuffer(body, np.dtype(kind).newbyteorder(order))[: rows * bw * together].reshape(rows, bw, together).astype(kind)
            if one(_PREDICTOR, 1) == 2:
                block = np.cumsum(block, axis=1, dtype=kind)
        part = block[: height - row, : width - left, 0]
        out[row : row + part.shape[0], left : left + part.shape[1]] = part
    dx, dy = tags[_PIXEL_SCALE][:2] if _PIXEL_SCALE in tags else (1.0, 1.0)
    i, j, _, x, y = tags[_TIE_POINT][:5] if _TIE_POINT in tags else (0.0, 0.0, 0.0, 0.0, float(height))
    west, north = x - i * dx, y + j * dy
    text = one(_NO_DATA, b"").split(b"\0")[0].strip()
    return out, (west, north - height * dy, west + width * dx, north), float(text) if text else None


def geotiff_cells(spark: SparkSession, path: str) -> DataFrame:
    """(tile, west, south, east, north, rows, cols, row, col, freq, error): a raster's first band in long form, no-data as
    null; rows count from the north. A file that cannot be read is one row with its error."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["tile", "west", "south", "east", "north", "rows", "cols", "row", "col", "freq", "error"]
        for part in parts:
            for name, data in zip(part["path"], part["content"], strict=True):
                try:
                    band, (west, south, east, north), none = geotiff(data)
                    rows, cols = band.shape
                    row, col = np.divmod(np.arange(band.size), cols)
                    values = band.ravel().astype(float)
                    if none is not None:
                        values[values == none] = np.nan
                    out = pd.DataFrame({"tile": name, "west": west, "south": south, "east": east, "north": north, "rows": rows, "cols": cols, "row": row, "col": col, "freq": values, "error": None})
                except Exception as e:  # the file's error is its result
                    out = pd.DataFrame([{"tile": name, "error": str(e)}])
                yield out.reindex(columns=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    got = files.mapInPandas(run, "tile string, west double, south double, east double, north double, rows int, cols int, row int, col int, freq double, error string")
    return got.withColumn("freq", F.when(~F.isnan("freq"), F.col("freq")))


def placed(cells: DataFrame, region: tuple[str, float, float, float, float], cell: float) -> DataFrame:
    """geotiff_cells() of a region's tiles on the region's grid (key, south, west, north, east): region, row, col, tile_seq
    (tiles in the order of their names), freq; cells outside the grid go."""
    key, s, w, n, e = region
    rows, cols = max(1, round((n - s) / cell)), max(1, round((e - w) / cell))
    order = cells.select("tile").distinct()
    seq = {r["tile"]: k for k, r in enumerate(order.orderBy("tile").collect())}  # one row a file
    tiles = cells.sparkSession.createDataFrame(list(seq.items()), "tile string, tile_seq int")
    at = cells.where("error IS NULL").join(F.broadcast(tiles), "tile").withColumns({"row": F.col("row") + F.rint((F.lit(n) - F.col("north")) / cell).cast("int"), "col": F.col("col") + F.rint((F.col("west") - F.lit(w)) / cell).cast("int")})
    return at.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1)).select(F.lit(key).alias("region"), "row", "col", "tile_seq", "freq")


# ---------------------------------------------------------------- shapefiles


def shapes(data: bytes) -> list[list[list[tuple[float, float]]] | None]:
    """Rings (or lines, or one point) of each record of a .shp file; null shapes are None. Z and M values are left out."""
    if len(data) < 100 or struct.unpack_from(">i", data)[0] != 9994:
        raise ValueError("not a shapefile")
    out, at = [], 100
    while at + 8 <= len(data):
        size = 2 * struct.unpack_from(">i", data, at + 4)[0]
        kind, = struct.unpack_from("<i", data, at + 8)
        if kind == 0:
            out.append(None)
        elif kind % 10 == 1:
            out.append([[struct.unpack_from("<2d", data, at + 12)]])
        elif kind % 10 in (3, 5):
            parts, points = struct.unpack_from("<2i", data, at + 44)
            first = [*struct.unpack_from(f"<{parts}i", data, at + 52), points]
            xy = np.frombuffer(data, "<f8", 2 * points, at + 52 + 4 * parts).reshape(-1, 2).tolist()
            out.append([[tuple(p) for p in xy[a:b]] for a, b in zip(first, first[1:], strict=False)])
        else:
            raise ValueError(f"shape type {kind}")
        at += 8 + size
    return out


def dbf(data: bytes, encoding: str = "utf-8") -> list[dict[str, object]]:
    """A .dbf table's records by field: trimmed text, numbers (None if blank), T/F as booleans; deleted ones are left out."""
    count, begin, length = struct.unpack_from("<IHH", data, 4)
    fields, at, off = [], 32, 1
    while data[at] != 0x0D:
        name, kind, size, decimals = data[at : at + 11].split(b"\0")[0].decode("ascii"), chr(data[at + 11]), data[at + 16], data[at + 17]
        fields.append((name, kind, off, size, decimals))
        at, off = at + 32, off + size
    out = []
    for k in range(count):
        row = data[begin + k * length : begin + (k + 1) * length]
        if row[:1] == b"*":
            continue
        record: dict[str, object] = {}
        for name, kind, o, size, decimals in fields:
            text = row[o : o + size].decode(encoding, "replace").strip().strip("\0")
            if kind in "NF":
                record[name] = None if not text or set(text) == {"*"} else float(text) if decimals or kind == "F" or "." in text else int(text)
            elif kind == "L":
                record[name] = {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
            else:
                record[name] = text
        out.append(record)
    return out


def shapefile(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(fseq, record, rings) of .shp files with the .dbf beside each: record maps fields to text, rings are arrays of
    (x, y); fseq counts records in a file, file by file."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        by = {p.rsplit(".", 1)[1].lower(): c for p, c in zip(part["path"].to_pylist(), part["content"].to_pylist(), strict=True)}
        table, geometry = dbf(by["dbf"], encoding) if "dbf" in by else None, shapes(by["shp"])
        rows = []
        for k, rings in enumerate(geometry):
            record = None if table is None else [(n, None if v is None else str(v)) for n, v in table[k].items()]
            rows.append({"file": key[0].as_py(), "fseq": k, "record": record and [{"name": n, "value": v} for n, v in record], "rings": rings and [[{"x": x, "y": y} for x, y in r] for r in rings]})
        return pa.Table.from_pylist(rows, schema)

    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    schema = pa.schema([("file", pa.string()), ("fseq", pa.int32()), ("record", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))), ("rings", pa.list_(pa.list_(point)))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{shp,dbf}").load(path).select("path", "content").withColumn("stem", F.regexp_replace("path", r"\.[^.]*$", ""))
    got = files.groupBy("stem").applyInArrow(run, "file string, fseq int, record array<struct<name: string, value: string>>, rings array<array<struct<x: double, y: double>>>")
    return got.select("file", "fseq", F.map_from_entries("record").alias("record"), "rings")


# ---------------------------------------------------------------- masks


def npy_bytes(bits: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, bits)
    return out.getvalue()


def save_masks(cells: DataFrame, path: str, bit: str = "bit") -> None:
    """One row a region (region, npy): its raster (region, row, col, bit) as the bytes of a .npy file; absent cells are false.

    A region's raster is one array by its format, so one task holds it.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        grid = np.zeros((int(part["row"].max()) + 1, int(part["col"].max()) + 1), bool)
        grid[part["row"], part["col"]] = part[bit].fillna(False).astype(bool)
        return pd.DataFrame({"region": [part["region"].iat[0]], "npy": [npy_bytes(grid)]})

    cells.select("region", "row", "col", bit).groupBy("region").applyInPandas(run, "region string, npy binary").write.mode("overwrite").parquet(path)


def mask_cells(files: DataFrame, region: str = "region", content: str = "npy") -> DataFrame:
    """(region, row, col, bit) of .npy rasters, one a row: of save_masks() or of binary files."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, data in zip(part["region"], part["npy"], strict=True):
                grid = np.load(io.BytesIO(data), allow_pickle=False)
                row, col = np.divmod(np.arange(grid.size), grid.shape[1])
                yield pd.DataFrame({"region": name, "row": row, "col": col, "bit": grid.ravel().astype(bool)})

    return files.select(F.col(region).alias("region"), F.col(content).alias("npy")).mapInPandas(run, "region string, row int, col int, bit boolean")
