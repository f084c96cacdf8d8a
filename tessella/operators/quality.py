"""Data-quality rules and gates, summaries and small relational steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .spatial import small

# Fixed values of the domain.
IMPORT_CAP = 25_000
LISTED_FOLDER = "QLD Government/Point Clouds/AHD/"
TILE_NAME = r"^(.+?)_(?:SW|sw)_(\d+)_(\d+)_1[Kk]"
#: Servers that an empty answer can come from.
MIRRORS = 2
ZONE_BOX = (152.9, 153.7, -28.05, -26.7)


class GateError(ValueError):
    """Data that must not be written."""


def depth_summary(points: DataFrame, depth: str = "depth") -> DataFrame:
    d = F.col(depth)
    n = F.greatest(F.count("*"), F.lit(1))
    return points.agg(F.count("*").alias("n"), F.count_if(d >= 0).alias("n_wet"), F.count_if(d < 0).alias("n_dry"), (F.count_if(d >= 0) * 100.0 / n).alias("pct_wet"), F.max(d).alias("deepest"), (F.count("*") > IMPORT_CAP).alias("over_cap"))


def require_bathymetry(points: DataFrame, depth: str = "depth", share: float = 50.0, deepest: float = 20.0) -> DataFrame:
    """points, or an error unless enough are under water and some are deep; an empty table fails."""
    s = depth_summary(points, depth).first()
    if not s["n"] or s["pct_wet"] < share or s["deepest"] < deepest:
        raise GateError(f"depths are implausible: {s}")
    return points


def require_empty(points: DataFrame, what) -> DataFrame:
    """points, or an error if any is where none may be."""
    if not points.where(what).isEmpty():
        raise GateError("rows where none may be")
    return points


def histogram(points: DataFrame, value: str, bounds: Sequence[float] = (0, 5, 10, 20, 30, 45)) -> DataFrame:
    """Counts in half-open buckets, with those below the first bound (bucket -1) and from the last one on; none is left out."""
    b = F.lit(-1)
    for k, x in enumerate(bounds):
        b = F.when(F.col(value) >= x, F.lit(k)).otherwise(b)
    counts = points.where(F.col(value).isNotNull()).groupBy(b.alias("bucket")).agg(F.count("*").alias("n"))
    all_of = points.sparkSession.range(-1, len(bounds)).select(F.col("id").cast("int").alias("bucket"))
    return all_of.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def duplicate_coordinates(points: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows, distinct places, and rows that repeat a place; by a sum over groups, so no task holds all places."""
    g = points.groupBy(lat, lng).agg(F.count("*").alias("n"))
    return g.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_places"), F.sum(F.col("n") - 1).alias("n_repeats"))


def extents(points: DataFrame, *columns: str) -> DataFrame:
    return points.agg(*(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))))


def stride_sample(rows: DataFrame, order: Sequence[str], step: int, most: int) -> DataFrame:
    """Every step-th row in order, `most` at most: for smoke runs. The order is total over the table."""
    n = step * most
    first = rows.orderBy(*order).limit(n).withColumn("place", F.row_number().over(W.orderBy(*order)) - 1)
    return first.where(F.col("place") % step == 0)


def contract_violations(zones: DataFrame, codes: Sequence[str] = ("MNP", "CPZ", "HPZ", "GUZ"), box: tuple = ZONE_BOX) -> DataFrame:
    """(fseq, rule, detail) for every broken rule of a zone feature table; fseq orders features, rules are numbered."""
    text = ("name", "zt", "zid", "plan", "src")
    x, y = F.transform(F.flatten("rings"), lambda v: v["x"]), F.transform(F.flatten("rings"), lambda v: v["y"])
    rules = [(f"1_{c}_empty", F.coalesce(F.trim(F.col(c)) == "", F.lit(True)), F.lit(c)) for c in text]
    rules += [
        ("2_code", ~F.coalesce(F.col("zt").isin(*codes), F.lit(False)), F.col("zt")),
        ("3_notake", ~F.coalesce(F.col("notake") == (F.col("zt") == "MNP"), F.lit(False)), F.col("notake").cast("string")),
        ("4_geometry", F.coalesce(F.size(F.flatten("rings")) <= 0, F.lit(True)), F.lit("empty")),
        ("5_extent", F.coalesce((F.array_min(x) < box[0]) | (F.array_max(x) > box[1]) | (F.array_min(y) < box[2]) | (F.array_max(y) > box[3]), F.lit(False)), F.lit("outside")),
    ]
    broken = F.filter(F.array(*(F.when(test, F.struct(F.lit(name).alias("rule"), detail.alias("detail"))) for name, test, detail in rules)), lambda r: r.isNotNull())
    return zones.select("fseq", F.explode(broken).alias("b")).select("fseq", "b.rule", "b.detail")


def expectations(zones: DataFrame, expected: DataFrame) -> DataFrame:
    """Whether each expected (zid, zt) is so; a missing zid fails. Of a repeated zid the last feature counts."""
    last = zones.groupBy("zid").agg(F.max_by("zt", "fseq").alias("found"))
    return expected.join(last, "zid", "left").select("zid", "zt", "found", F.col("found").eqNullSafe(F.col("zt")).alias("ok"))


def manifest(lines: DataFrame, surveys: DataFrame, line: str = "line", folder: str = LISTED_FOLDER) -> DataFrame:
    """Tile rows out of archive listings: (path, name, survey, e, n) with the survey's attributes; unknown surveys go.

    A line has a size, a date, a time and a path in folder, whose last part has no white space. The survey is all of the
    name before the first sheet mark that is followed by the tile's place, capitals and digits included.
    """
    entry = r"\d+\s+[\d-]+\s+[\d:]+\s+(" + folder.replace(".", r"\.") + r"(\S+))"
    parts = lines.select(F.regexp_extract(line, entry, 1).alias("path"), F.regexp_extract(line, entry, 2).alias("name"))
    g = lambda k: F.regexp_extract("name", TILE_NAME, k)
    parsed = parts.where(F.col("name").rlike(TILE_NAME)).select("path", "name", g(1).alias("survey"), g(2).cast("int").alias("e"), g(3).cast("int").alias("n"))
    return parsed.join(small(surveys), "survey")


def confusion(samples: DataFrame) -> DataFrame:
    """Per cohort: agreement of a raster's verdict with a vector's; a null verdict is neither."""
    m, v = F.col("mask"), F.col("vector")
    return samples.groupBy("cohort").agg(F.count("*").alias("n"), F.count_if(m.isNotNull()).alias("n_in"), F.count_if(m == v).alias("agree"), F.count_if(m & ~v).alias("only_mask"), F.count_if(~m & v).alias("only_vector"), F.count_if(m).alias("n_wet"))


def probe_verdicts(probes: DataFrame, expect: str = "expect", mask: str = "mask") -> DataFrame:
    """Whether the mask says what a probe expects; either always holds, a null mask holds for nothing else."""
    ok = F.when(F.col(expect).contains("either") | F.col(expect).contains("intertidal"), F.lit(True)).when(F.col(expect).contains("water"), F.coalesce(F.col(mask), F.lit(False))).when(F.col(expect).contains("land"), F.coalesce(~F.col(mask), F.lit(False))).otherwise(F.lit(False))
    return probes.withColumn("ok", ok)


def dedupe_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")


def arbitrate_empty(answers: DataFrame, hint: float = 0.95, mirrors: int = MIRRORS) -> DataFrame:
    """Per tile: whether an empty answer stands. answers: tile, mirror, n_elements (null: failed), ocean share.

    Elements settle it; two empty answers agree, a likely ocean needs one, and one stands once all mirrors have answered
    or failed. With mirrors left a tile is to be asked again; if all failed, so did the tile.
    """
    a = answers.groupBy("tile").agg(F.count_if(F.col("n_elements") > 0).alias("n_some"), F.count_if(F.col("n_elements") == 0).alias("n_empty"), F.count_if(F.col("n_elements").isNull()).alias("n_failed"), F.max("ocean").alias("ocean"))
    verdict = F.when(F.col("n_some") > 0, "elements").when((F.col("n_empty") >= 2) | ((F.col("n_empty") >= 1) & (F.coalesce("ocean", F.lit(0.0)) >= hint)) | ((F.col("n_empty") == 1) & (F.col("n_empty") + F.col("n_failed") >= mirrors)), "empty").when(F.col("n_empty") + F.col("n_failed") < mirrors, "ask_again").otherwise("failed")
    return a.select("tile", "n_some", "n_empty", "n_failed", verdict.alias("verdict"))


def receipts(points: DataFrame, stored: DataFrame) -> DataFrame:
    """Counted points of each region against what was recorded."""
    counted = points.groupBy("region").agg(F.count("*").alias("n"))
    return counted.join(stored, "region", "full_outer").select("region", "n", "recorded", F.col("n").eqNullSafe(F.col("recorded")).alias("ok"))


def assemble_members(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """Rings of relations: each member's own geometry, else its way's; members without either and those of fewer than
    four vertices go, open rings are closed. role is inner or outer (anything else)."""
    m = relations.select("rel_id", F.posexplode("members").alias("pos", "m")).select("rel_id", "pos", "m.*")
    g = m.join(ways.select(F.col("way_id").alias("ref"), F.col("geometry").alias("own")), "ref", "left").withColumn("g", F.coalesce("geometry", "own"))
    closed = F.when(F.get("g", F.lit(0)) == F.element_at("g", -1), F.col("g")).otherwise(F.concat("g", F.slice("g", 1, 1)))
    return g.where(F.size("g") >= 4).select("rel_id", "pos", F.when(F.col("role") == "inner", "inner").otherwise("outer").alias("role"), closed.alias("ring"))


def merge_by_id(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """new rows replace old ones with their key; the rest stays."""
    return new.unionByName(old.join(new, key, "left_anti"))


def semi_join_results(results: DataFrame, scan: DataFrame, key: str = "name", order: str = "scan_seq") -> DataFrame:
    """Results whose tile was scanned, with the scan's columns; of a tile scanned twice the last scan counts."""
    last = scan.groupBy(key).agg(F.max_by(F.struct(*(c for c in scan.columns if c != key)), order).alias("__s"))
    return results.join(last, key).select(*results.columns, "__s.*")


def require_offsets(points: DataFrame, offset: str = "offset", least: float = 1.0) -> DataFrame:
    """points, or an error if an offset lies below what the block's latitudes allow; an empty table passes."""
    low = points.agg(F.min(offset)).first()[0]
    if low is not None and low < least:
        raise GateError(f"an offset of {low} is below {least}")
    return points


def kept_as_expected(points: DataFrame, kept: DataFrame, cell: Sequence[str], value: str) -> DataFrame:
    """Per cell, kept against what the thinning rule says of all its points: the deepest if any is under water, else the
    most drying. A cell that one side lacks counts as different."""
    v = F.col(value)
    want = points.groupBy(*cell).agg(F.when(F.max(v) >= 0, F.max(v)).otherwise(F.min(v)).alias("expected"), F.count("*").alias("n"))
    both = want.join(kept.select(*cell, v.alias("kept")), list(cell), "full_outer")
    return both.select(*cell, "n", "kept", "expected", F.col("kept").eqNullSafe(F.col("expected")).alias("ok"))


def require_kept(checked: DataFrame) -> DataFrame:
    """checked, or an error if any cell's kept value is not the expected one."""
    if not checked.where("NOT ok").isEmpty():
        raise GateError("kept values differ from what the rule gives")
    return checked


def collection_violations(files: DataFrame, body: str = "value", properties: Sequence[str] = ("name", "zt", "zid", "notake", "plan", "src")) -> DataFrame:
    """(fseq, rule, detail) for what is wrong with the form of GeoJSON texts, one a row; fseq is null for the collection.

    Rules: 0_parse, 0_collection (the top type), 0_features (none), 0_feature (a feature's type), 0_property (one is
    missing; null counts as there), 0_geometry (a type other than Polygon and MultiPolygon).
    """
    kind = "struct<type: string, features: array<struct<type: string, properties: map<string, string>, geometry: struct<type: string>>>>"
    j = files.select(F.from_json(body, kind, {"mode": "PERMISSIVE"}).alias("j"))
    none = F.lit(None)
    top = [("0_parse", F.col("j").isNull() | (F.col("j.type").isNull() & F.col("j.features").isNull()), none.cast("string")), ("0_collection", F.coalesce(F.col("j.type") != "FeatureCollection", F.lit(True)), F.col("j.type")), ("0_features", F.coalesce(F.size("j.features") <= 0, F.lit(True)), none.cast("string"))]
    first = F.coalesce(*(F.when(test, F.struct(none.cast("int").alias("fseq"), F.lit(name).alias("rule"), detail.alias("detail"))) for name, test, detail in top))
    each = j.select(F.posexplode("j.features").alias("fseq", "f"))
    broken = [F.when(F.coalesce(F.col("f.type") != "Feature", F.lit(True)), F.struct(F.lit("0_feature").alias("rule"), F.col("f.type").alias("detail")))]
    broken += [F.when(~F.coalesce(F.map_contains_key("f.properties", F.lit(p)), F.lit(False)), F.struct(F.lit("0_property").alias("rule"), F.lit(p).alias("detail"))) for p in properties]
    broken += [F.when(~F.coalesce(F.col("f.geometry.type").isin("Polygon", "MultiPolygon"), F.lit(False)), F.struct(F.lit("0_geometry").alias("rule"), F.col("f.geometry.type").alias("detail")))]
    rows = each.select("fseq", F.explode(F.filter(F.array(*broken), lambda r: r.isNotNull())).alias("b")).select("fseq", "b.rule", "b.detail")
    return j.select(first.alias("v")).where("v IS NOT NULL").select("v.*").unionByName(rows)
