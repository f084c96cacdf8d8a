"""Points, manifests and zones from files, and the sinks. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ring_contains
from ..operators.audit import merge_results
from ..operators.quality import require_bathymetry
from ..operators.raster import WET
from ..operators.spatial import grid_dims, small

DEPTH_SCHEMA = "lat double, lng double, depth double"
MANIFEST_SCHEMA = "outer string, path string, name string, survey string, e int, n int, port string, offset double, epsg int, rank int, src string, method string, `group` string, expected_sus int"
ZONE_SCHEMA = "type string, features array<struct<type: string, properties: struct<name: string, zt: string, zid: string, notake: boolean, plan: string, src: string>, geometry: struct<type: string, coordinates: string>>>"


def depth_csv(spark: SparkSession, path: str) -> DataFrame:
    """Depth points; rows without a place go, a bad depth is null."""
    return spark.read.schema(DEPTH_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path).where("lat IS NOT NULL AND lng IS NOT NULL")


def manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Tile rows with tile_seq, their place in the file, which later ties are broken by."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", f"array<struct<{_struct(MANIFEST_SCHEMA)}>>")).alias("tile_seq", "r"))
    return rows.select("tile_seq", "r.*")


def _struct(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (part.strip().rsplit(" ", 1) for part in ddl.split(",")))


def zones_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Zone features: properties, and rings (array of arrays of struct x, y) of a Polygon or a MultiPolygon."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", ZONE_SCHEMA)["features"]).alias("fseq", "f"))
    raw = F.col("f.geometry.coordinates")
    parsed = F.when(F.col("f.geometry.type") == "Polygon", F.from_json(raw, "array<array<array<double>>>")).when(F.col("f.geometry.type") == "MultiPolygon", F.flatten(F.from_json(raw, "array<array<array<array<double>>>>")))
    rings = F.transform(parsed, lambda ring: F.transform(ring, lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))))
    return rows.select("fseq", "f.properties.*", rings.alias("rings"))


def listing(spark: SparkSession, path: str, outers: list[str], pattern: str = "*.listing.txt") -> DataFrame:
    """Lines of the listings below path whose names fit the pattern and whose archives are named, with the archive's name;
    bytes that are no text are replaced."""
    lines = spark.read.option("pathGlobFilter", pattern).text(path).select(F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.listing\.txt$", "").alias("outer"), F.col("value").alias("line"))
    return lines.where(F.col("outer").isin(*outers))


def is_tiff(content: str = "content"):
    """Whether bytes begin like a TIFF file."""
    return F.hex(F.substring(content, 1, 2)).isin("4949", "4D4D")


def write_depth_csv(points: DataFrame, path: str, *, fixed: bool = True) -> None:
    """lat, lng, depth as text: six, six and two decimals with LF, or the shortest forms with CRLF."""
    if fixed:
        points = points.select(F.format_string("%.6f", "lat").alias("lat"), F.format_string("%.6f", "lng").alias("lng"), F.format_string("%.2f", "depth").alias("depth"))
    points.write.mode("overwrite").option("header", True).option("lineSep", "\n" if fixed else "\r\n").csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)


def checked(content_column: str, digest: str):
    """Whether a file's bytes have the SHA-256 that was recorded."""
    return F.sha2(F.col(content_column), 256) == F.lower(F.col(digest))


def write_geojson(zones: DataFrame, path: str) -> None:
    """Zone features (fseq, properties, rings) as one compact FeatureCollection; outer rings are polygons of their own,
    unless all rings after the first lie within it by their first vertex, as holes do.

    The collection is one value by its format, so zones must be a dimension: their number is checked.
    """
    first_in = F.forall(F.slice("rings", 2, 1_000_000), lambda r: ring_contains(F.get("rings", F.lit(0)), F.get(r, F.lit(0))["x"], F.get(r, F.lit(0))["y"]))
    xy = F.transform("rings", lambda r: F.transform(r, lambda v: F.array(v["x"], v["y"])))
    shape = F.when(first_in, F.to_json(F.struct(F.lit("Polygon").alias("type"), xy.alias("coordinates")))).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.transform(xy, lambda r: F.array(r)).alias("coordinates"))))
    properties = F.to_json(F.struct("name", "zt", "zid", "notake", "plan", "src"), {"ignoreNullFields": "false"})
    text = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), shape, F.lit("}"))
    rows = small(zones).select("fseq", text.alias("t")).agg(F.sort_array(F.collect_list(F.struct("fseq", "t"))).alias("f"))
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform("f", lambda x: x["t"]), ","), F.lit("]}"))
    rows.select(whole.alias("value")).write.mode("overwrite").text(path)


def write_rle(encoded: DataFrame, regions: DataFrame, path: str, cell: float, least: float = WET) -> None:
    """Run-length rasters (region, rle) and their boxes as one compact JSON text; regions are a dimension."""
    dims = {"cols": grid_dims(F.col("e") - F.col("w"), cell), "rows": grid_dims(F.col("n") - F.col("s"), cell)}
    r = small(regions).join(encoded, "region").withColumns(dims)
    one = F.struct("rseq", F.struct(F.col("region").alias("key"), "s", "w", "n", "e", "cols", "rows", "rle").alias("r"))
    got = r.agg(F.sort_array(F.collect_list(one)).alias("a"))
    whole = F.struct(F.lit(1).alias("v"), F.lit(float(cell)).alias("cell"), F.lit(float(least)).alias("freqMin"), F.transform("a", lambda x: x["r"]).alias("regions"))
    got.select(F.to_json(whole).alias("value")).write.mode("overwrite").text(path)


def append_results(spark: SparkSession, path: str, new: DataFrame, key: str = "name") -> None:
    """Merge new results into the table at path, which is first copied beside itself; refuses what merge_results() refuses."""
    old = spark.read.parquet(path)
    merged = merge_results(old, new, key)
    old.write.mode("overwrite").parquet(path + ".before")
    merged.write.mode("overwrite").parquet(path + ".next")
    spark.read.schema(merged.schema).parquet(path + ".next").write.mode("overwrite").parquet(path)


def write_gated(points: DataFrame, path: str, depth: str = "depth") -> None:
    """write_depth_csv() behind the bathymetry gate: what fails it is not written."""
    write_depth_csv(require_bathymetry(points, depth), path)


def save_version(rows: DataFrame, path: str) -> int:
    """Keep rows as the next version of the table at path; earlier versions stay. One writer at a time."""
    known = versions(rows.sparkSession, path)
    n = (known[-1] if known else 0) + 1
    rows.write.mode("errorifexists").parquet(f"{path}/version={n}")
    return n


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions at path, oldest first: Spark marks a table that was written to its end."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = fs_path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(top)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=") and fs.exists(fs_path(f"{path}/{n}/_SUCCESS")))


def version(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """A version's rows, by default the last."""
    known = versions(spark, path)
    if not known or n is not None and n not in known:
        raise ValueError(f"no version {n or ''} at {path}")
    return spark.read.parquet(f"{path}/version={n or known[-1]}")


def undo(spark: SparkSession, path: str) -> int:
    """Make the version before the last the newest again, as a new version; the undone one stays too."""
    known = versions(spark, path)
    if len(known) < 2:
        raise ValueError("nothing to undo")
    return save_version(version(spark, path, known[-2]), path)
