"""Queries by name, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import cell_floor, depth, grid_of, lat_offset, round_to, to_geographic, to_grid
from ..operators import audit, cells, mask, packing, quality, raster, spatial, surface, thin, zones
from . import surrogates as S

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- cells

_RANKED = (
    "WITH "
    + S.POINTS
    + """,
g AS (SELECT *, round_even(x / 25e0, 0)::BIGINT AS ex, round_even(y / 25e0, 0)::BIGINT AS ny FROM pts WHERE cls = 2 AND z BETWEEN -3 AND 5),
w AS (SELECT *, min(rank) OVER (PARTITION BY ex, ny) AS low FROM g),
cells AS (SELECT ex, ny, rank, median(z) AS z, arg_min(ROW(x, y, epsg), ROW(tile_id, l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice)) AS f, count(*) AS n
          FROM w WHERE rank = low GROUP BY ex, ny, rank),
ranked AS (SELECT ex, ny, rank, z, f[1] AS x, f[2] AS y, f[3] AS epsg, n FROM cells)"""
)


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    return cells.rank_priority_cells(cells.ground(S.points(spark, d)), S.ORDER)


@query(_RANKED + " SELECT * FROM ranked")
def rank_priority_cells(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d)


_MASKED = ", mask AS (SELECT DISTINCT epsg, floor(x / 25e0)::BIGINT AS cx, floor(y / 25e0)::BIGINT AS cy FROM pts WHERE cls = 9 AND l_linenumber = 1)"


def _mask(spark: SparkSession, d: str) -> DataFrame:
    flagged = S.points(spark, d).where("cls = 9 AND l_linenumber = 1")
    return mask.union_of(flagged.select("epsg", cell_floor("x").alias("cx"), cell_floor("y").alias("cy")))


@query(_RANKED + _MASKED + " SELECT * FROM ranked r WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.epsg = r.epsg AND m.cx = floor(r.x / 25e0) AND m.cy = floor(r.y / 25e0))")
def rank_priority_masked(spark: SparkSession, d: str) -> DataFrame:
    return mask.drop_native(_ranked(spark, d), _mask(spark, d))


@query(
    "WITH "
    + S.POINTS
    + _MASKED
    + """, p AS (SELECT l_suppkey, l_orderkey, x, y FROM (SELECT tile_id AS l_suppkey, * FROM pts) WHERE cls = 2),
k AS (SELECT *, floor(x / 25e0)::BIGINT AS ax, floor(y / 25e0)::BIGINT AS ay, floor((x + 1.8e0) / 25e0)::BIGINT AS bx, floor((y - 1.8e0) / 25e0)::BIGINT AS b_y FROM p)
SELECT l_suppkey AS tile_id, count(*) AS n_kept FROM k
WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.epsg = 28356 AND m.cx = ax AND m.cy = ay) AND NOT EXISTS (SELECT 1 FROM mask m WHERE m.epsg = 7856 AND m.cx = bx AND m.cy = b_y)
GROUP BY l_suppkey"""
)
def mask_anti_join(spark: SparkSession, d: str) -> DataFrame:
    p = S.points(spark, d).where("cls = 2").select("tile_id", "x", "y", (F.col("x") + 1.8).alias("x2"), (F.col("y") - 1.8).alias("y2"))
    return mask.drop_any(p, _mask(spark, d), ((28356, "x", "y"), (7856, "x2", "y2"))).groupBy("tile_id").agg(F.count("*").alias("n_kept"))


@query(
    "WITH "
    + S.POINTS
    + """, g AS (SELECT tile_id, round_even(x / 25e0, 0)::BIGINT AS ge, round_even(y / 25e0, 0)::BIGINT AS gn, median(z) AS m, count(*) AS n FROM pts
  WHERE cls IN (9, 13) AND x BETWEEN 503000 AND 503900 AND y BETWEEN 7052000 AND 7052900 AND NOT (x BETWEEN 503200 AND 503300 AND y BETWEEN 7052200 AND 7052300) GROUP BY 1, 2, 3)
SELECT ge, gn, sum(round(m * n * 1000000e0)::DECIMAL(38, 0))::DOUBLE / 1000000e0 / sum(n) AS z, sum(n)::BIGINT AS n, count(*) AS n_tiles FROM g GROUP BY 1, 2"""
)
def weighted_tile_median(spark: SparkSession, d: str) -> DataFrame:
    p = S.points(spark, d).where(F.col("cls").isin(9, 13) & cells.box("x", "y", 503000, 503900, 7052000, 7052900) & ~cells.box("x", "y", 503200, 503300, 7052200, 7052300))
    return cells.two_level_median(p)


@query(
    "WITH "
    + S.POINTS
    + """, t AS (SELECT cls IN (9, 13) AS w, x BETWEEN 503000 AND 503900 AND y BETWEEN 7052000 AND 7052900 AS i, x BETWEEN 503200 AND 503300 AND y BETWEEN 7052200 AND 7052300 AS h FROM pts)
SELECT count(*) AS n_read, count(*) FILTER (NOT w) AS dropped_class, count(*) FILTER (w AND NOT i) AS dropped_extent, count(*) FILTER (w AND i AND h) AS dropped_hole, count(*) FILTER (w AND i AND NOT h) AS n_kept FROM t"""
)
def drop_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return cells.drop_reasons(S.points(spark, d), (9, 13), cells.box("x", "y", 503000, 503900, 7052000, 7052900), cells.box("x", "y", 503200, 503300, 7052200, 7052300))


@query("WITH " + S.POINTS + " SELECT DISTINCT survey, round_even(x / 25e0, 0)::BIGINT AS cx, round_even(y / 25e0, 0)::BIGINT AS cy FROM pts WHERE cls = 2 AND z BETWEEN -3 AND 5")
def survey_cell_coverage(spark: SparkSession, d: str) -> DataFrame:
    return cells.coverage(cells.ground(S.points(spark, d)))


@query()
def reservoir_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return cells.hash_sample(cells.ground(S.points(spark, d), low=-1.6), S.ORDER)


# ---------------------------------------------------------------- audit

_CLASSES = (
    "WITH "
    + S.POINTS
    + """, cc AS (SELECT tile_id, survey, floor(x / 25e0)::BIGINT AS cx, floor(y / 25e0)::BIGINT AS cy, count(*) FILTER (cls = 9) AS c9, count(*) FILTER (cls = 2) AS c2,
  median(CASE WHEN cls = 9 THEN z END) AS z9, median(CASE WHEN cls = 2 THEN z END) AS z2 FROM pts WHERE cls IN (2, 9) GROUP BY 1, 2, 3, 4),
s AS (SELECT *, coalesce(c9 >= 1 AND c2 >= 1 AND abs(z2 - z9) <= 0.5e0, false) AS sus FROM cc),
t AS (SELECT tile_id, survey, CASE WHEN sum(c2) = 0 OR sum(c9) = 0 THEN 'clean_by_absence' WHEN count(*) FILTER (sus) = 0 THEN 'clean' ELSE 'HIT' END AS status, sum(c2)::BIGINT AS n2, sum(c9)::BIGINT AS n9,
  count(*) FILTER (sus) AS sus_cells, max(CASE WHEN sus THEN c2 END) AS max_density, trunc(sum(CASE WHEN sus THEN c2 END) * 1e0 / count(CASE WHEN sus THEN c2 END))::BIGINT AS mean_density, count(*) FILTER (sus) * 0.000625e0 AS area_km2 FROM s GROUP BY 1, 2)"""
)


def _classes(spark: SparkSession, d: str) -> DataFrame:
    return cells.class_cells(S.points(spark, d))


def _status(spark: SparkSession, d: str) -> DataFrame:
    return audit.tile_status(_classes(spark, d), audit.adjacent(1, 1, 0.5))


@query(_CLASSES + " SELECT tile_id, cx, cy, c9, c2, z9, z2 FROM s WHERE sus")
def class_adjacency_audit(spark: SparkSession, d: str) -> DataFrame:
    return _classes(spark, d).where(audit.adjacent(1, 1, 0.5)).select("tile_id", "cx", "cy", "c9", "c2", "z9", "z2")


@query(_CLASSES + " SELECT tile_id, cx, cy, c2, z2 FROM cc WHERE c2 >= 2 AND z2 <= 1.5e0")
def density_audit(spark: SparkSession, d: str) -> DataFrame:
    return _classes(spark, d).where(audit.dense(2, 1.5)).select("tile_id", "cx", "cy", "c2", "z2")


@query(_CLASSES + " SELECT * REPLACE (coalesce(max_density, 0) AS max_density, coalesce(mean_density, 0) AS mean_density) FROM t")
def tile_audit_status(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d).fillna(0, ["max_density", "mean_density"])


@query(_CLASSES + " SELECT tile_id, place, cx, cy, cx * 25e0 + 12.5e0 AS x, cy * 25e0 + 12.5e0 AS y, c2, c9, z2, z9 FROM (SELECT *, (row_number() OVER (PARTITION BY tile_id ORDER BY c2 DESC, cx, cy))::INT AS place FROM s WHERE sus) WHERE place <= 3")
def audit_examples_top3(spark: SparkSession, d: str) -> DataFrame:
    return audit.top_examples(_classes(spark, d), audit.adjacent(1, 1, 0.5))


@query(
    _CLASSES
    + """ SELECT survey, grouping(survey)::INT AS is_total, count(*) AS n_tiles, count(*) FILTER (status = 'HIT') AS n_hit, count(*) FILTER (status = 'HIT' AND sus_cells >= 2) AS n_artifact,
  coalesce(sum(sus_cells) FILTER (status = 'HIT' AND sus_cells >= 2), 0)::BIGINT AS artifact_cells, coalesce(sum(sus_cells) FILTER (status = 'HIT' AND sus_cells >= 2), 0)::BIGINT * 0.000625e0 AS artifact_km2 FROM t GROUP BY ROLLUP (survey)"""
)
def survey_rollup_total(spark: SparkSession, d: str) -> DataFrame:
    return audit.survey_summary(_status(spark, d), 2)


@query(
    _CLASSES
    + """, n AS (SELECT count(*) FILTER (status = 'HIT' AND sus_cells >= 2) AS k, coalesce(sum(sus_cells) FILTER (status = 'HIT' AND sus_cells >= 2), 0)::BIGINT AS c FROM t)
SELECT k AS new_tiles, c * 0.000625e0 AS new_km2, k + 192 AS total_tiles, c * 0.000625e0 + 13.61e0 AS total_km2 FROM n"""
)
def artifact_running_total(spark: SparkSession, d: str) -> DataFrame:
    return audit.running_total(_status(spark, d), least=2)


@query(
    _CLASSES
    + """ SELECT tile_id AS name, status, sus_cells, NULL::VARCHAR AS method, NULL::VARCHAR AS "group" FROM t WHERE tile_id % 2 = 0
UNION ALL SELECT tile_id, status, sus_cells, 'adjacency', 'A' FROM t WHERE tile_id % 2 = 1 UNION ALL SELECT tile_id, status, sus_cells, 'density', 'B' FROM t WHERE tile_id % 5 = 0"""
)
def union_audit_results(spark: SparkSession, d: str) -> DataFrame:
    t = _status(spark, d).select(F.col("tile_id").alias("name"), "status", "sus_cells")
    tagged = lambda rows, method, group: rows.withColumns({"method": F.lit(method), "group": F.lit(group)})
    new = tagged(t.where("name % 2 = 1"), "adjacency", "A").unionByName(tagged(t.where("name % 5 = 0"), "density", "B"))
    return audit.merge_results(t.where("name % 2 = 0"), new)


@query(
    _CLASSES
    + """ SELECT tile_id AS name, survey, status, 'A' AS "group" FROM t WHERE tile_id % 3 = 1
UNION ALL SELECT tile_id, survey, status, NULL FROM t WHERE tile_id % 3 = 0 AND tile_id % 4 <> 0 AND survey IN ('FRANCE', 'GERMANY', 'INDIA', 'CHINA', 'KENYA', 'PERU', 'JAPAN', 'IRAN')"""
)
def group_a_with_spot_tiles(spark: SparkSession, d: str) -> DataFrame:
    t = _status(spark, d).select(F.col("tile_id").alias("name"), "survey", "status")
    k = F.col("name")
    new = t.where(k % 3 != 0).withColumn("group", F.when(k % 3 == 1, "A").otherwise("B"))
    old = t.where(k % 3 == 0).withColumn("method", F.when(k % 4 == 0, "density"))
    return audit.group_picture(new, old, ("FRANCE", "GERMANY", "INDIA", "CHINA", "KENYA", "PERU", "JAPAN", "IRAN")).select("name", "survey", "status", "group")


@query(
    _CLASSES
    + """, sc AS (SELECT o_custkey % 97 AS name, o_orderkey AS scan_seq, o_orderkey % 1000 AS n_points FROM orders), last AS (SELECT name, arg_max(n_points, scan_seq) AS n_points, max(scan_seq) AS scan_seq FROM sc GROUP BY name)
SELECT tile_id AS name, status, scan_seq, n_points::BIGINT AS n_points FROM t JOIN last ON tile_id = name"""
)
def results_with_scan(spark: SparkSession, d: str) -> DataFrame:
    scan = S.table(spark, d, "orders").select((F.col("o_custkey") % 97).alias("name"), F.col("o_orderkey").alias("scan_seq"), (F.col("o_orderkey") % 1000).cast("long").alias("n_points"))
    return quality.semi_join_results(_status(spark, d).select(F.col("tile_id").alias("name"), "status"), scan)


@query(_CLASSES + " SELECT survey, tile_id, sus_cells, place FROM (SELECT *, (row_number() OVER (PARTITION BY survey ORDER BY sus_cells DESC, tile_id))::INT AS place FROM t WHERE status = 'HIT') WHERE place <= 2")
def topk_tiles_per_survey(spark: SparkSession, d: str) -> DataFrame:
    return audit.top_tiles(_status(spark, d)).select("survey", "tile_id", "sus_cells", "place")


@query(
    _CLASSES
    + """, ex AS (SELECT tile_id, cx, cy FROM (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY c2 DESC, cx, cy) AS place FROM s WHERE sus) WHERE place <= 3), fl AS (SELECT tile_id, cx, cy FROM s WHERE sus AND c9 >= c2)
SELECT ex.tile_id, count(*) AS n_examples, count(fl.tile_id) AS n_found FROM ex LEFT JOIN fl USING (tile_id, cx, cy) GROUP BY 1"""
)
def example_membership(spark: SparkSession, d: str) -> DataFrame:
    c = _classes(spark, d)
    return audit.membership(audit.top_examples(c, audit.adjacent(1, 1, 0.5)), c.where(audit.adjacent(1, 1, 0.5) & (F.col("c9") >= F.col("c2"))))


@query(
    _CLASSES
    + """, a AS (SELECT tile_id, count(*) AS n_cells FROM s WHERE sus GROUP BY 1), e AS (SELECT tile_id, sus_cells AS expected FROM t WHERE tile_id % 3 <> 0)
SELECT coalesce(a.tile_id, e.tile_id) AS tile_id, coalesce(n_cells, -1) AS n_cells, coalesce(expected, -1) AS expected, n_cells IS NOT DISTINCT FROM expected AS matches FROM a FULL JOIN e ON a.tile_id = e.tile_id"""
)
def mask_count_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    c = _classes(spark, d).where(audit.adjacent(1, 1, 0.5)).groupBy("tile_id").agg(F.count("*").alias("n_cells"))
    return audit.count_check(c, _status(spark, d).where("tile_id % 3 <> 0").select("tile_id", F.col("sus_cells").alias("expected"))).fillna(-1)


# ---------------------------------------------------------------- thinning and summaries

_WET = "w AS (SELECT *, bool_or(depth >= 0) OVER (PARTITION BY cell) AS wet FROM depths)"


@query("WITH " + S.DEPTHS + ", " + _WET + " SELECT row_id, cell, depth, x, y FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY CASE WHEN wet THEN depth ELSE -depth END DESC, row_id) AS k FROM w) WHERE k = 1")
def thin_conditional_argmax(spark: SparkSession, d: str) -> DataFrame:
    return thin.conditional_argmax(S.depths(spark, d), ("cell",), "depth", "row_id")


@query(
    "WITH "
    + S.DEPTHS
    + ", "
    + _WET
    + """, k AS (SELECT cell, arg_min(depth, ROW(-depth, row_id)) AS a, arg_min(depth, ROW(-abs(depth), row_id)) AS b, arg_min(depth, ROW(CASE WHEN wet THEN -depth ELSE depth END, row_id)) AS c FROM w GROUP BY cell)
SELECT count(*) AS n_cells, count(*) FILTER (a <> c) AS differs_signed, count(*) FILTER (b <> c) AS differs_magnitude, count(*) FILTER ((a >= 0) <> (c >= 0)) AS flips_signed, count(*) FILTER ((b >= 0) <> (c >= 0)) AS flips_magnitude FROM k"""
)
def thin_rule_diffs(spark: SparkSession, d: str) -> DataFrame:
    return thin.rule_differences(S.depths(spark, d), ("cell",), "depth", "row_id")


@query(
    "WITH "
    + S.DEPTHS
    + """, n AS (SELECT s AS size, count(DISTINCT ROW(round_even(x / s, 0), round_even(y / s, 0))) AS n_cells FROM depths, (VALUES (15e0), (17.5e0), (18e0), (20e0)) t(s) GROUP BY s)
SELECT size, n_cells, round(size * sqrt(n_cells / 1900e0) * 1000000e0) / 1000000e0 AS suggested FROM n"""
)
def candidate_cell_counts(spark: SparkSession, d: str) -> DataFrame:
    return thin.candidate_counts(S.depths(spark, d), (15, 17.5, 18, 20), 1900).withColumn("suggested", round_to("suggested", 6))


@query(
    "WITH "
    + S.DEPTHS
    + """, c AS (SELECT cell, count(*) AS n FROM depths GROUP BY cell), o AS (SELECT *, row_number() OVER (ORDER BY cell) - 1 AS place, count(*) OVER () AS t FROM c WHERE n >= 3)
SELECT cell, n, place::INT AS place FROM o WHERE place IN (0, trunc((t - 1) / 4e0), trunc(2 * (t - 1) / 4e0), trunc(3 * (t - 1) / 4e0), t - 1)"""
)
def spaced_cell_picks(spark: SparkSession, d: str) -> DataFrame:
    return thin.spaced_picks(S.depths(spark, d).groupBy("cell").agg(F.count("*").alias("n")), "cell")


@query(
    "WITH "
    + S.DEPTHS
    + """, b AS (SELECT CASE WHEN depth >= 45 THEN 5 WHEN depth >= 30 THEN 4 WHEN depth >= 20 THEN 3 WHEN depth >= 10 THEN 2 WHEN depth >= 5 THEN 1 WHEN depth >= 0 THEN 0 ELSE -1 END AS bucket FROM depths)
SELECT k::INT AS bucket, count(b.bucket) AS n FROM range(-1, 6) r(k) LEFT JOIN b ON b.bucket = k GROUP BY k"""
)
def depth_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.histogram(S.depths(spark, d), "depth")


@query("WITH " + S.DEPTHS + " SELECT count(*) AS n, count(*) FILTER (depth >= 0) AS n_wet, count(*) FILTER (depth < 0) AS n_dry, count(*) FILTER (depth >= 0) * 100e0 / greatest(count(*), 1) AS pct_wet, max(depth) AS deepest, count(*) > 25000 AS over_cap FROM depths")
def bathymetry_gate_figures(spark: SparkSession, d: str) -> DataFrame:
    return quality.depth_summary(S.depths(spark, d))


@query("WITH " + S.PLACES + " SELECT count(*) AS n_rows, count(DISTINCT ROW(lat, lng)) AS n_places, count(*) - count(DISTINCT ROW(lat, lng)) AS n_repeats FROM (SELECT round(lat * 10) / 10 AS lat, round(lng * 10) / 10 AS lng FROM places)")
def duplicate_coords(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_coordinates(S.places(spark, d).select(round_to("lat", 1).alias("lat"), round_to("lng", 1).alias("lng")))


@query("WITH " + S.PLACES + " SELECT min(lat) AS min_lat, max(lat) AS max_lat, min(lng) AS min_lng, max(lng) AS max_lng FROM places")
def extents_min_max(spark: SparkSession, d: str) -> DataFrame:
    return quality.extents(S.places(spark, d), "lat", "lng")


@query("SELECT o_orderkey, (k - 1)::INT AS place FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE (k - 1) % 7 = 0 AND k <= 7 * 20")
def stride_sample(spark: SparkSession, d: str) -> DataFrame:
    return quality.stride_sample(S.table(spark, d, "orders").select("o_orderdate", "o_orderkey"), ("o_orderdate", "o_orderkey"), 7, 20).select("o_orderkey", "place")


# ---------------------------------------------------------------- text and features

_SURVEY = "substr(p_name, 1, 4) || CASE WHEN p_partkey % 3 = 0 THEN '_2014_LGA' WHEN p_partkey % 3 = 1 THEN 'Coast_2022_LGA' ELSE '_SW_2009' END"
_LISTED = (
    "CASE WHEN p_partkey % 11 = 0 THEN 'Archive: ' ELSE '' END || (p_size * 1000) || ' 2020-0' || (p_partkey % 9 + 1) || '-11 10:22:33 ' || CASE WHEN p_partkey % 13 = 0 THEN 'Elsewhere/' ELSE 'QLD Government/Point Clouds/AHD/' END || "
    + _SURVEY
    + " || CASE WHEN p_partkey % 2 = 0 THEN '_SW_' ELSE '_sw_' END || p_size || '_' || (p_partkey % 7000) || '_1' || CASE WHEN p_partkey % 5 = 0 THEN 'K' ELSE 'k' END || '.zip'"
)


@query(
    f"""WITH l AS (SELECT regexp_extract({_LISTED}, '[0-9]+\\s+[0-9-]+\\s+[0-9:]+\\s+(QLD Government/Point Clouds/AHD/(\\S+))', 2) AS name FROM part), s(survey, srank) AS (SELECT DISTINCT {_SURVEY}, 1 FROM part WHERE p_partkey % 4 = 0),
m AS (SELECT name, regexp_extract(name, '^(.+?)_(SW|sw)_([0-9]+)_([0-9]+)_1[Kk]', ['survey', 'sheet', 'e', 'n']) AS g FROM l WHERE regexp_matches(name, '^(.+?)_(SW|sw)_([0-9]+)_([0-9]+)_1[Kk]'))
SELECT name, s.survey, g.e::INT AS e, g.n::INT AS n, srank FROM m JOIN s ON s.survey = g.survey"""
)
def manifest_regex_parse(spark: SparkSession, d: str) -> DataFrame:
    p = S.table(spark, d, "part")
    surveys = p.where("p_partkey % 4 = 0").select(F.expr(_SURVEY).alias("survey"), F.lit(1).alias("srank")).distinct()
    return quality.manifest(p.select(F.expr(_LISTED).alias("line")), surveys).select("name", "survey", "e", "n", "srank")


_FEATURES = (
    "SELECT c_custkey AS fseq, CASE WHEN c_custkey % 50 = 0 THEN ' ' ELSE c_name END AS name, CASE c_custkey % 7 WHEN 0 THEN 'MNP' WHEN 1 THEN 'CPZ' WHEN 2 THEN 'HPZ' WHEN 3 THEN 'XXX' ELSE 'GUZ' END AS zt,"
    " 'Z' || CAST(c_nationkey AS STRING) AS zid, c_custkey % 7 = 0 OR c_custkey % 90 = 4 AS notake, CASE WHEN c_custkey % 80 = 5 THEN NULL ELSE c_mktsegment END AS plan, 'src' AS src, 152.2D + 1.2D * (c_custkey * 91 % 997) / 1000D AS x, -27.6D + 1D * (c_custkey * 37 % 1000) / 1000D AS y FROM customer"
)
_FEATURES_SQL = _FEATURES.replace("AS STRING", "AS VARCHAR").replace("152.2D", "152.2e0").replace("1.2D", "1.2e0").replace("1000D", "1000e0").replace("27.6D", "27.6e0").replace("1D", "1e0")


def _features(spark: SparkSession, d: str) -> DataFrame:
    S.table(spark, d, "customer").createOrReplaceTempView("tessella_customer")
    f = spark.sql(_FEATURES.replace("FROM customer", "FROM tessella_customer"))
    return f.withColumn("rings", F.expr("CASE WHEN fseq % 60 = 7 THEN CAST(array() AS array<array<struct<x: double, y: double>>>) ELSE array(array(struct(x, y), struct(x + 0.1D AS x, y AS y), struct(x AS x, y + 0.1D AS y))) END"))


@query(
    f"""WITH f AS ({_FEATURES_SQL}),
r AS (SELECT fseq, '1_name_empty' AS rule, 'name' AS detail FROM f WHERE trim(name) = '' UNION ALL SELECT fseq, '1_plan_empty', 'plan' FROM f WHERE plan IS NULL
  UNION ALL SELECT fseq, '2_code', zt FROM f WHERE zt = 'XXX' UNION ALL SELECT fseq, '3_notake', notake::VARCHAR FROM f WHERE notake <> (zt = 'MNP')
  UNION ALL SELECT fseq, '4_geometry', 'empty' FROM f WHERE fseq % 60 = 7
  UNION ALL SELECT fseq, '5_extent', 'outside' FROM f WHERE fseq % 60 <> 7 AND (x < 152.9e0 OR x + 0.1e0 > 153.7e0 OR y < -28.05e0 OR y + 0.1e0 > -26.7e0))
SELECT * FROM r"""
)
def contract_violations(spark: SparkSession, d: str) -> DataFrame:
    return quality.contract_violations(_features(spark, d))


@query(f"WITH f AS ({_FEATURES_SQL}), l AS (SELECT zid, arg_max(zt, fseq) AS found FROM f GROUP BY zid), e(zid, zt) AS (VALUES ('Z1', 'MNP'), ('Z2', 'GUZ'), ('Z3', 'HPZ'), ('Z99', 'HPZ')) SELECT e.zid, e.zt, found, found IS NOT DISTINCT FROM e.zt AS ok FROM e LEFT JOIN l USING (zid)")
def zone_expectations(spark: SparkSession, d: str) -> DataFrame:
    return quality.expectations(_features(spark, d), spark.createDataFrame([("Z1", "MNP"), ("Z2", "GUZ"), ("Z3", "HPZ"), ("Z99", "HPZ")], "zid string, zt string"))


@query(f"WITH f AS ({_FEATURES_SQL}) SELECT zt, count(*) AS n, count(DISTINCT zid) AS n_zids FROM f GROUP BY zt")
def zone_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d).groupBy("zt").agg(F.count("*").alias("n"), F.count_distinct("zid").alias("n_zids"))


@query("SELECT event_type AS type, user_id AS id, arg_min(event_id, event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2")
def dedupe_by_type_id(spark: SparkSession, d: str) -> DataFrame:
    e = S.table(spark, d, "events").select(F.col("event_type").alias("type"), F.col("user_id").alias("id"), "event_id", "value")
    return quality.dedupe_first(e, ("type", "id"), ("event_id",))


@query(
    """WITH a AS (SELECT user_id % 300 AS tile, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 0 ELSE event_id % 2 END AS n, user_id % 100 / 100e0 AS ocean FROM events),
g AS (SELECT tile, count(*) FILTER (n > 0) AS n_some, count(*) FILTER (n = 0) AS n_empty, count(*) FILTER (n IS NULL) AS n_failed, max(ocean) AS ocean FROM a GROUP BY tile)
SELECT tile, n_some, n_empty, n_failed, CASE WHEN n_some > 0 THEN 'elements' WHEN n_empty >= 2 OR (n_empty >= 1 AND coalesce(ocean, 0) >= 0.95e0) OR (n_empty = 1 AND n_empty + n_failed >= 2) THEN 'empty' WHEN n_empty + n_failed < 2 THEN 'ask_again' ELSE 'failed' END AS verdict FROM g"""
)
def mirror_empty_arbitration(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    e = S.table(spark, d, "events").select((F.col("user_id") % 300).alias("tile"), F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit(0).cast("long")).otherwise(k % 2).alias("n_elements"), (F.col("user_id") % 100 / F.lit(100.0)).alias("ocean"))
    return quality.arbitrate_empty(e)


@query(
    """WITH w AS (SELECT o_orderkey AS way_id, [o_orderkey, o_custkey, o_orderkey + 1, o_orderkey] AS g FROM orders WHERE o_orderkey % 3 = 0),
m AS (SELECT l_orderkey % 500 AS rel_id, l_orderkey AS ref, l_linenumber, l_partkey, l_suppkey, l_returnflag, CASE WHEN l_linenumber = 1 THEN [l_partkey, l_suppkey, l_partkey + 1, l_suppkey + 1] WHEN l_linenumber = 2 THEN [l_partkey] END AS own FROM lineitem),
j AS (SELECT rel_id, ref, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 'inner' ELSE 'outer' END AS role, coalesce(own, w.g) AS g FROM m LEFT JOIN w ON w.way_id = m.ref)
SELECT rel_id, role, count(*) AS n_rings, sum(CASE WHEN g[1] = g[-1] THEN len(g) ELSE len(g) + 1 END)::BIGINT AS n_vertices FROM j WHERE len(g) >= 4 GROUP BY 1, 2"""
)
def osm_member_assembly(spark: SparkSession, d: str) -> DataFrame:
    v = lambda *c: F.array(*(F.col(x) if isinstance(x, str) else x for x in c))
    ways = S.table(spark, d, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("way_id"), v("o_orderkey", "o_custkey", F.col("o_orderkey") + 1, "o_orderkey").alias("geometry"))
    li = S.table(spark, d, "lineitem")
    own = F.when(F.col("l_linenumber") == 1, v("l_partkey", "l_suppkey", F.col("l_partkey") + 1, F.col("l_suppkey") + 1)).when(F.col("l_linenumber") == 2, v("l_partkey"))
    role = F.when(F.col("l_returnflag") == "R", "inner").otherwise("")
    rel = li.groupBy((F.col("l_orderkey") % 500).alias("rel_id")).agg(F.collect_list(F.struct(F.col("l_orderkey").alias("ref"), role.alias("role"), own.alias("geometry"))).alias("members"))
    return quality.assemble_members(rel, ways).groupBy("rel_id", "role").agg(F.count("*").alias("n_rings"), F.sum(F.size("ring")).alias("n_vertices"))


# ---------------------------------------------------------------- places

_NEAREST = (
    "WITH "
    + S.PLACES
    + ", "
    + S.PORT_VALUES
    + """, h AS (SELECT *, 12742e0 * asin(least(1e0, sqrt(pow(sin((radians(plat) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plng - lng) / 2), 2)))) AS km FROM places, ports),
near AS (SELECT pid, lat, lng, e, port, hat, b1, b2, km FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY km, seq) AS k FROM h) WHERE k = 1)"""
)


@query(_NEAREST + " SELECT pid, port, round(km * 1000)::BIGINT AS metres FROM near")
def nearest_port(spark: SparkSession, d: str) -> DataFrame:
    return spatial.nearest(S.places(spark, d), S.ports(spark)).select("pid", "port", F.round(F.col("km") * 1000).cast("long").alias("metres"))


@query(_NEAREST + " SELECT pid, CASE WHEN km <= 60 THEN port END AS port FROM near")
def nearest_port_capped(spark: SparkSession, d: str) -> DataFrame:
    return spatial.nearest(S.places(spark, d), S.ports(spark), within_km=60).select("pid", "port")


@query(_NEAREST + " SELECT port, CASE WHEN e < 0 THEN 'blue' WHEN e <= b1 THEN 'teal' WHEN e <= b2 THEN 'amber' ELSE 'gold' END AS band, count(*) AS n FROM near WHERE e <= hat GROUP BY 1, 2")
def hat_and_tide_bands(spark: SparkSession, d: str) -> DataFrame:
    return spatial.above_tide(spatial.nearest(S.places(spark, d), S.ports(spark))).groupBy("port", "band").agg(F.count("*").alias("n"))


@query("WITH " + S.PLACES + ", " + S.REGION_VALUES + " SELECT pid, (SELECT arg_min(region, rseq) FROM regions WHERE lat BETWEEN s AND n AND lng BETWEEN w AND regions.e) AS region FROM places")
def first_matching_box(spark: SparkSession, d: str) -> DataFrame:
    return spatial.first_box(S.places(spark, d), S.regions(spark)).select("pid", "region")


_ZONED = (
    "WITH "
    + S.PLACES
    + ", "
    + S.EDGES
    + """, hit AS (SELECT pid, zseq, zt, name FROM places, edges WHERE (y1 > lat) <> (y2 > lat) AND lng < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1),
zoned AS (SELECT pid, zt, name FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY CASE zt WHEN 'MNP' THEN 0 WHEN 'CPZ' THEN 1 WHEN 'HPZ' THEN 2 WHEN 'GUZ' THEN 3 ELSE 98 END, zseq) AS k FROM hit) WHERE k = 1)"""
)


@query(_ZONED + " SELECT pid, zt, name FROM places LEFT JOIN zoned USING (pid)")
def point_in_polygon_zone(spark: SparkSession, d: str) -> DataFrame:
    return spatial.most_protective(S.places(spark, d), S.zones(spark), key="pid")


@query(
    _ZONED
    + ", "
    + S.COVERAGE_VALUES
    + """, c AS (SELECT pid, (SELECT arg_min(region, rseq) FROM cover WHERE lat BETWEEN s AND n AND lng BETWEEN w AND cover.e) AS r FROM places),
st AS (SELECT pid, zt, CASE WHEN r IS NULL THEN 'unassessed' WHEN starts_with(r, 'notloaded') THEN 'notloaded' WHEN zt IS NULL THEN 'outside' ELSE 'zone' END AS state FROM c LEFT JOIN zoned USING (pid))
SELECT pid, state, CASE WHEN state = 'zone' THEN zt END AS zt FROM st"""
)
def zone_coverage_state(spark: SparkSession, d: str) -> DataFrame:
    return spatial.zone_state(S.places(spark, d), S.zones(spark), S.regions(spark, S.COVERAGE), key="pid")


@query("WITH " + S.PLACES + ", o AS (SELECT *, CASE WHEN lat > -26.533e0 THEN 1.15e0 WHEN lat > -26.908e0 THEN 1.0e0 ELSE 1.26e0 END AS o FROM places) SELECT pid, o AS port_offset, round((-e - o) * 100) / 100 AS depth, -e - o >= 0 AS wet FROM o")
def lat_bucket_offset_depth(spark: SparkSession, d: str) -> DataFrame:
    p = S.places(spark, d).withColumn("port_offset", lat_offset("lat"))
    return p.select("pid", "port_offset", round_to(depth("e", "port_offset"), 2).alias("depth"), (depth("e", "port_offset") >= 0).alias("wet"))


@query("WITH " + S.PLACES + " SELECT pid, true AS lat_same, true AS lng_same, true AS plausible FROM places")
def tm_project_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    p = S.places(spark, d)
    east, north = to_grid("lat", "lng")
    p = p.withColumns({"east": east, "north": north})
    lat, lng = to_geographic("east", "north")
    return p.select("pid", (F.abs(lat - F.col("lat")) < 1e-8).alias("lat_same"), (F.abs(lng - F.col("lng")) < 1e-8).alias("lng_same"), (F.col("east").between(400_000, 600_000) & F.col("north").between(6_900_000, 7_300_000)).alias("plausible"))


def _krueger_sql() -> str:
    """Transverse Mercator of the standard's series, written out for SQL: n is the third flattening, A the rectifying radius."""
    f = "(1 / 298.257222101e0)"
    n = f"({f} / (2 - {f}))"
    radius = f"(6378137e0 / (1 + {n}) * (1 + pow({n}, 2) / 4 + pow({n}, 4) / 64))"
    alpha = (f"({n} / 2 - 2 * pow({n}, 2) / 3 + 5 * pow({n}, 3) / 16)", f"(13 * pow({n}, 2) / 48 - 3 * pow({n}, 3) / 5)", f"(61 * pow({n}, 3) / 240)")
    sinh, cosh = (lambda x, sign=sign: f"((exp({x}) {sign} exp(-({x}))) / 2)" for sign in ("-", "+"))
    atanh = lambda x: f"(ln((1 + {x}) / (1 - ({x}))) / 2)"
    e = f"sqrt({f} * (2 - {f}))"
    east = " + ".join(["eta", *(f"{a} * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, a in enumerate(alpha, 1))])
    north = " + ".join(["xi", *(f"{a} * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, a in enumerate(alpha, 1))])
    return f"""q AS (SELECT pid, {atanh('sin(radians(lat))')} - {e} * {atanh(f'{e} * sin(radians(lat))')} AS psi, radians(lng - (pid % 2 * 6 + 147)) AS lam FROM places),
t AS (SELECT pid, {sinh('psi')} AS t, lam FROM q), x AS (SELECT pid, atan2(t, cos(lam)) AS xi, {atanh('(sin(lam) / sqrt(1 + t * t))')} AS eta FROM t),
grid AS (SELECT pid, 500000 + 0.9996e0 * {radius} * ({east}) AS east, 10000000 + 0.9996e0 * {radius} * ({north}) AS north FROM x)"""


@query("WITH " + S.PLACES + ", " + _krueger_sql() + " SELECT pid, (28355 + pid % 2)::BIGINT AS epsg, round(east * 1000)::BIGINT AS east_mm, round(north * 1000)::BIGINT AS north_mm FROM grid")
def tm_project_grid(spark: SparkSession, d: str) -> DataFrame:
    p = S.places(spark, d).withColumn("epsg", 28355 + F.col("pid") % 2)
    east, north = grid_of("epsg", "lat", "lng")
    return p.select("pid", "epsg", F.round(east * 1000).cast("long").alias("east_mm"), F.round(north * 1000).cast("long").alias("north_mm"))


@query(
    "WITH "
    + S.PLACES
    + ", "
    + S.REGION_VALUES
    + """, j AS (SELECT pid % 3 AS cohort, (SELECT arg_min(region, rseq) FROM regions WHERE lat BETWEEN s AND n AND lng BETWEEN w AND regions.e) AS r, pid % 4 < 2 AS wet, pid % 5 < 3 AS v FROM places),
m AS (SELECT cohort, CASE WHEN r IS NOT NULL THEN wet END AS m, v FROM j)
SELECT cohort, count(*) AS n, count(m) AS n_in, count(*) FILTER (m = v) AS agree, count(*) FILTER (m AND NOT v) AS only_mask, count(*) FILTER (NOT m AND v) AS only_vector, count(*) FILTER (m) AS n_wet FROM m GROUP BY 1"""
)
def cohort_confusion(spark: SparkSession, d: str) -> DataFrame:
    p = spatial.first_box(S.places(spark, d), S.regions(spark))
    return quality.confusion(p.select((F.col("pid") % 3).alias("cohort"), F.when(F.col("region").isNotNull(), F.col("pid") % 4 < 2).alias("mask"), (F.col("pid") % 5 < 3).alias("vector")))


@query(
    """WITH p AS (SELECT c_custkey AS pid, CASE c_custkey % 5 WHEN 0 THEN 'water' WHEN 1 THEN 'land' WHEN 2 THEN 'either way' WHEN 3 THEN 'intertidal flat' ELSE 'none' END AS expect, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS mask FROM customer)
SELECT pid, expect, mask, CASE WHEN expect LIKE '%either%' OR expect LIKE '%intertidal%' THEN true WHEN expect LIKE '%water%' THEN coalesce(mask, false) WHEN expect LIKE '%land%' THEN coalesce(NOT mask, false) ELSE false END AS ok FROM p"""
)
def probe_expectations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    expect = F.when(k % 5 == 0, "water").when(k % 5 == 1, "land").when(k % 5 == 2, "either way").when(k % 5 == 3, "intertidal flat").otherwise("none")
    return quality.probe_verdicts(S.table(spark, d, "customer").select(k.alias("pid"), expect.alias("expect"), F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("mask")))


@query(
    "WITH "
    + S.REGION_VALUES
    + """, g AS (SELECT -26.653e0 + i * (0.09e0 / 5) AS lat, 153.03e0 + j * (0.05e0 / 5) AS lng FROM range(6) a(i), range(6) b(j)),
v AS (SELECT (SELECT arg_min(region, rseq) FROM regions WHERE lat BETWEEN s AND n AND lng BETWEEN w AND regions.e) AS r, lat + lng > 126.44e0 AS wet FROM g)
SELECT count(*) FILTER (r IS NOT NULL AND NOT wet) AS land, count(*) FILTER (r IS NOT NULL AND wet) AS water, count(*) FILTER (r IS NULL) AS outside, count(*) FILTER (r IS NOT NULL AND NOT wet) >= 30 AS passed FROM v"""
)
def defect_grid_score(spark: SparkSession, d: str) -> DataFrame:
    g = spatial.first_box(spatial.lattice(-26.653, -26.563, 153.03, 153.08, 6, spark), S.regions(spark)).withColumn("wet", F.col("lat") + F.col("lng") > 126.44)
    inside = F.col("region").isNotNull()
    return g.agg(F.count_if(inside & ~F.col("wet")).alias("land"), F.count_if(inside & F.col("wet")).alias("water"), F.count_if(~inside).alias("outside"), (F.count_if(inside & ~F.col("wet")) >= 30).alias("passed"))


@query(
    "WITH "
    + S.REGION_VALUES
    + """, t AS (SELECT region, i, j, s + i * 0.25e0 AS ts, w + j * 0.25e0 AS tw, s, w, n, e FROM regions, range(0, 10) a(i), range(0, 10) b(j) WHERE i < greatest(1, ceil((n - s - 1e-9) / 0.25e0)) AND j < greatest(1, ceil((e - w - 1e-9) / 0.25e0)))
SELECT region, i::INT AS i, j::INT AS j, round(ts * 1000000) / 1000000 AS ts, round(tw * 1000000) / 1000000 AS tw, round(least(ts + 0.25e0, n) * 1000000) / 1000000 AS tn, round(least(tw + 0.25e0, e) * 1000000) / 1000000 AS te FROM t"""
)
def tile_grid_generate(spark: SparkSession, d: str) -> DataFrame:
    t = spatial.tiles(spatial.REGIONS, 0.25, spark)
    return t.select("region", "i", "j", *(round_to(c, 6).alias(c) for c in ("ts", "tw", "tn", "te")))


@query("WITH " + S.PLACES + ", " + S.REGION_VALUES + ", b AS (SELECT (SELECT arg_min(region, rseq) FROM regions WHERE lat BETWEEN s AND n AND lng BETWEEN w AND regions.e) AS region FROM places), c AS (SELECT coalesce(region, 'none') AS region, count(*) AS n FROM b GROUP BY 1), r(region, recorded) AS (VALUES ('seq_coast', 55::BIGINT), ('gone', 3)) SELECT coalesce(c.region, r.region) AS region, coalesce(n, -1) AS n, coalesce(recorded, -1) AS recorded, n IS NOT DISTINCT FROM recorded AS ok FROM c FULL JOIN r ON c.region = r.region")
def region_receipt_check(spark: SparkSession, d: str) -> DataFrame:
    p = spatial.first_box(S.places(spark, d), S.regions(spark)).select(F.coalesce("region", F.lit("none")).alias("region"))
    return quality.receipts(p, spark.createDataFrame([("seq_coast", 55), ("gone", 3)], "region string, recorded long")).fillna(-1)


# ---------------------------------------------------------------- rasters

_MOSAIC = "WITH " + S.RASTER + ", mosaic AS (SELECT region, row, col, arg_max(freq, tile_seq) FILTER (freq IS NOT NULL) AS freq FROM raster GROUP BY 1, 2, 3)"


@query(_MOSAIC + " SELECT region, row, col, freq, coalesce(freq, 0) >= 0.2e0 AS wet, coalesce(freq, 0) >= 0.9e0 AS open_water FROM mosaic")
def raster_mosaic_last_wins(spark: SparkSession, d: str) -> DataFrame:
    m = raster.mosaic(S.raster(spark, d))
    return m.select("region", "row", "col", "freq", raster.wet().alias("wet"), raster.wet(least=raster.OPEN_WATER).alias("open_water"))


@query(_MOSAIC + ", a AS (SELECT region, row, col, coalesce(freq, 0) >= 0.2e0 AS a FROM mosaic), b AS (SELECT region, row, col, bool_or(bit) AS b FROM raster WHERE tile_seq % 3 = 0 GROUP BY 1, 2, 3), j AS (SELECT coalesce(a, false) AS a, coalesce(b, false) AS b, region FROM a FULL JOIN b USING (region, row, col)) SELECT region, avg((a AND b)::INT::DOUBLE) AS share, count(*) AS n_cells, count(*) FILTER (a OR b) AS n_either FROM j GROUP BY region")
def raster_strict_and(spark: SparkSession, d: str) -> DataFrame:
    r = S.raster(spark, d)
    a = raster.mosaic(r).select("region", "row", "col", raster.wet().alias("bit"))
    b = r.where("tile_seq % 3 = 0").groupBy("region", "row", "col").agg(F.bool_or("bit").alias("bit"))
    both = raster.combine(a, b)
    return raster.share_true(both, "both").join(both.groupBy("region").agg(F.count_if("either").alias("n_either")), "region")


_COAST = (
    "WITH "
    + S.WAY_VALUES
    + """, seg AS (SELECT *, lead(x) OVER (PARTITION BY way_id ORDER BY pos) AS bx, lead(y) OVER (PARTITION BY way_id ORDER BY pos) AS b_y FROM ways),
n AS (SELECT *, greatest(1, trunc(sqrt((bx - x) * (bx - x) + (b_y - y) * (b_y - y)) / 50e0))::BIGINT AS n FROM seg WHERE bx IS NOT NULL),
dense AS (SELECT way_id, pos, k, x + k / n::DOUBLE * (bx - x) AS cx, y + k / n::DOUBLE * (b_y - y) AS cy, x AS ax, y AS ay, bx, b_y FROM n, range(0, 100) r(k) WHERE k < n)"""
)


@query(
    _COAST
    + ", "
    + S.DEPTHS
    + """, c AS (SELECT row_id, x AS px, y AS py FROM depths),
j AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy)), way_id, pos, k) AS r FROM c, dense)
SELECT row_id, (bx - ax) * (py - ay) - (b_y - ay) * (px - ax) < 0 AS sea, round(sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy)) * 1000)::BIGINT AS mm FROM j WHERE r = 1"""
)
def coastline_side_test(spark: SparkSession, d: str) -> DataFrame:
    ways = spark.createDataFrame(list(S.WAYS), "way_id int, pos int, x double, y double")
    c = S.depths(spark, d).select("row_id", "x", "y")
    return raster.sea_side(c, ways, key="row_id", step=50.0, cell=50.0).select("row_id", "sea", F.round(F.col("distance") * 1000).cast("long").alias("mm"))


@query(
    """WITH e AS (SELECT vec_id, embedding[1]::DOUBLE * 1000 AS x, embedding[2]::DOUBLE * 1000 AS y FROM embeddings),
j AS (SELECT a.vec_id, b.vec_id AS target, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist FROM e a, e b WHERE a.vec_id % 2 = 0 AND b.vec_id % 2 = 1)
SELECT vec_id, target, round(dist * 1000)::BIGINT AS gap FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, target) AS k FROM j) WHERE k = 1"""
)
def nearest_neighbour_gap(spark: SparkSession, d: str) -> DataFrame:
    e = S.table(spark, d, "embeddings").select("vec_id", (F.col("embedding")[0].cast("double") * 1000).alias("x"), (F.col("embedding")[1].cast("double") * 1000).alias("y"))
    near = spatial.nearest_neighbour(e.where("vec_id % 2 = 0"), e.where("vec_id % 2 = 1"), key="vec_id", target_key="vec_id", cell=40.0, reach=64)
    return near.select("vec_id", "target", F.round(F.col("distance") * 1000).cast("long").alias("gap"))


_BITS = "b AS (SELECT 'r' || (event_id // 1000) AS region, event_id AS i, event_type IN ('click', 'view') AS bit FROM events)"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    e = S.table(spark, d, "events").select(F.concat(F.lit("r"), F.floor(F.col("event_id") / 1000).cast("string")).alias("region"), F.col("event_id").alias("i"), F.col("event_type").isin("click", "view").alias("bit"))
    return raster.run_lengths(e)


@query("WITH " + _BITS + ', g AS (SELECT *, i - row_number() OVER (PARTITION BY region, bit ORDER BY i) AS g FROM b) SELECT region, bit, min(i) AS start, count(*) AS "length" FROM g GROUP BY region, bit, g')
def run_length_encode(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d)


_VARINTS = """l AS (SELECT region, list_concat(CASE WHEN arg_min(bit, start) THEN [0::BIGINT] ELSE []::BIGINT[] END, list("length" ORDER BY start)) AS r FROM (SELECT region, bit, min(i) AS start, count(*) AS "length" FROM g GROUP BY region, bit, g) GROUP BY region),
v AS (SELECT region, r, generate_subscripts(r, 1) AS i, unnest(r) AS v FROM l),
b AS (SELECT region, i, v, unnest(range(0, CASE WHEN v < 128 THEN 1 WHEN v < 16384 THEN 2 WHEN v < 2097152 THEN 3 ELSE 4 END)) AS k, CASE WHEN v < 128 THEN 1 WHEN v < 16384 THEN 2 WHEN v < 2097152 THEN 3 ELSE 4 END AS n FROM v),
h AS (SELECT region, string_agg(lpad(hex(((v >> (7 * k)::INT) & 127) | CASE WHEN k < n - 1 THEN 128 ELSE 0 END), 2, '0'), '' ORDER BY i, k) AS h FROM b GROUP BY region)"""


@query("WITH " + _BITS.replace("b AS (", "e AS (", 1) + ", g AS (SELECT *, i - row_number() OVER (PARTITION BY region, bit ORDER BY i) AS g FROM e), " + _VARINTS + " SELECT region, to_base64(unhex(h)) AS rle, len(r)::INT AS n_runs FROM h JOIN l USING (region)")
def run_length_varints(spark: SparkSession, d: str) -> DataFrame:
    return raster.encode(_runs(spark, d))


# ---------------------------------------------------------------- meshes, masks and samples

_MESH_CELL = 0.02
_MESH = (
    S.REGION_VALUES
    + f""", dims AS (SELECT region, rseq, s, w, n, e, greatest(1, round_even((n - s) / {_MESH_CELL}e0, 0))::INT AS n_rows, greatest(1, round_even((e - w) / {_MESH_CELL}e0, 0))::INT AS n_cols FROM regions),
mesh AS (SELECT region, r::INT AS row, c::INT AS col, n - (r + 0.5e0) * (n - s) / n_rows AS lat, w + (c + 0.5e0) * (e - w) / n_cols AS lng FROM dims, range(0, 60) a(r), range(0, 60) b(c) WHERE r < n_rows AND c < n_cols)"""
)
_RASTERISED = _MESH + ", " + S.EDGES + """, inside AS (SELECT DISTINCT region, row, col FROM (SELECT region, row, col, zseq FROM mesh, edges WHERE (y1 > lat) <> (y2 > lat) AND lng < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1)),
bits AS (SELECT region, row, col, i.region IS NOT NULL AS bit FROM mesh m LEFT JOIN inside i USING (region, row, col))"""


@query("WITH " + _MESH + " SELECT region, row, col, round(lat * 1000000)::BIGINT AS lat_e6, round(lng * 1000000)::BIGINT AS lng_e6 FROM mesh")
def cell_centre_mesh(spark: SparkSession, d: str) -> DataFrame:
    m = spatial.cell_mesh(S.regions(spark), _MESH_CELL)
    return m.select("region", "row", "col", *(F.round(F.col(c) * 1000000).cast("long").alias(f"{c}_e6") for c in ("lat", "lng")))


def _water(spark: SparkSession) -> DataFrame:
    return spatial.in_any(spatial.cell_mesh(S.regions(spark), _MESH_CELL), S.zones(spark), keys=("region", "row", "col"))


@query("WITH " + _RASTERISED.replace("i.region IS NOT NULL", "i.row IS NOT NULL").replace("SELECT region, row, col, i.row", "SELECT m.region, m.row, m.col, i.row").replace("LEFT JOIN inside i USING (region, row, col)", "LEFT JOIN inside i ON i.region = m.region AND i.row = m.row AND i.col = m.col") + " SELECT * FROM bits")
def rasterised_zones(spark: SparkSession, d: str) -> DataFrame:
    return _water(spark)


@query(
    ORACLE_SQL["rasterised_zones"].removesuffix(" SELECT * FROM bits")
    + ", "
    + _NEAREST.removeprefix("WITH ")
    + """, g AS (SELECT *, CASE WHEN pid % 10 = 0 THEN 'woongarra' ELSE 'own' END AS source FROM near WHERE e <= hat),
pt AS (SELECT g.*, (SELECT arg_min(region, rseq) FROM dims WHERE lat BETWEEN s AND n AND lng BETWEEN w AND dims.e) AS region FROM g),
pl AS (SELECT pt.*, least(greatest(trunc((dims.n - lat) / (dims.n - dims.s) * n_rows)::INT, 0), n_rows - 1) AS row, least(greatest(trunc((lng - dims.w) / (dims.e - dims.w) * n_cols)::INT, 0), n_cols - 1) AS col FROM pt LEFT JOIN dims USING (region))
SELECT pid, pl.region, port, CASE WHEN e < 0 THEN 'blue' WHEN e <= b1 THEN 'teal' WHEN e <= b2 THEN 'amber' ELSE 'gold' END AS band
FROM pl LEFT JOIN bits ON bits.region = pl.region AND bits.row = pl.row AND bits.col = pl.col WHERE pl.region IS NULL OR source = 'woongarra' OR bit"""
)
def depth_samples(spark: SparkSession, d: str) -> DataFrame:
    p = S.places(spark, d).withColumn("source", F.when(F.col("pid") % 10 == 0, "woongarra").otherwise("own"))
    return surface.depth_samples(p, S.ports(spark), S.regions(spark), _water(spark), _MESH_CELL).select("pid", "region", "port", "band")


@query(
    "WITH "
    + S.DEPTHS
    + """, j AS (SELECT p.row_id, s.depth AS v, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) AS d FROM depths p, depths s WHERE p.row_id % 2 = 0 AND s.row_id % 2 = 1 AND abs(p.x - s.x) <= 30 AND abs(p.y - s.y) <= 30),
g AS (SELECT row_id, count(*) AS n, count(*) FILTER (d = 0) AS n_on, sum(round(v * 1e6)) FILTER (d = 0) AS on_v, sum(round(pow(30 / d, 2) * v * 1e6)) FILTER (d > 0) AS wv, sum(round(pow(30 / d, 2) * 1e6)) FILTER (d > 0) AS w FROM j WHERE d <= 30 GROUP BY row_id)
SELECT p.row_id, round(CASE WHEN n_on > 0 THEN on_v / 1e6 / n_on ELSE wv / w END * 1000)::BIGINT AS depth_mm, coalesce(n, 0)::BIGINT AS n FROM depths p LEFT JOIN g USING (row_id) WHERE p.row_id % 2 = 0"""
)
def weighted_interpolation(spark: SparkSession, d: str) -> DataFrame:
    p = S.depths(spark, d)
    got = surface.interpolated(p.where("row_id % 2 = 0"), p.where("row_id % 2 = 1"), key="row_id", reach=30.0)
    return got.select("row_id", F.round(F.col("depth") * 1000).cast("long").alias("depth_mm"), "n")


@query(
    "WITH "
    + S.DEPTHS
    + """, c AS (SELECT n_nationkey AS place, (n_nationkey * 37 % 1000)::DOUBLE AS x, (n_nationkey * 91 % 990)::DOUBLE AS y FROM nation),
o AS (SELECT place, x + i * 7 AS x, y + j * 7 AS y FROM c, range(-7, 8) a(i), range(-7, 8) b(j) WHERE (i * i + j * j) * 49 <= 2500),
j AS (SELECT place, o.x, o.y, s.depth AS v, sqrt((o.x - s.x) * (o.x - s.x) + (o.y - s.y) * (o.y - s.y)) AS d FROM o, depths s WHERE abs(o.x - s.x) <= 20 AND abs(o.y - s.y) <= 20),
g AS (SELECT place, x, y, CASE WHEN count(*) FILTER (d = 0) > 0 THEN sum(round(v * 1e6)) FILTER (d = 0) / 1e6 / count(*) FILTER (d = 0) ELSE sum(round(pow(20 / d, 2) * v * 1e6)) FILTER (d > 0) / sum(round(pow(20 / d, 2) * 1e6)) FILTER (d > 0) END AS depth FROM j WHERE d <= 20 GROUP BY 1, 2, 3)
SELECT place, round(depth * 1000)::BIGINT AS depth_mm, x, y FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY round(depth * 1e6) DESC, x, y) AS k FROM g) WHERE k = 1"""
)
def deepest_nearby(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    places = S.table(spark, d, "nation").select(k.alias("place"), (k * 37 % 1000).cast("double").alias("x"), (k * 91 % 990).cast("double").alias("y"))
    got = surface.deepest(places, S.depths(spark, d), key="place", radius=50.0, step=7.0, reach=20.0)
    return got.select("place", F.round(F.col("depth") * 1000).cast("long").alias("depth_mm"), "x", "y")


@query(
    "WITH "
    + S.DEPTHS
    + """, j AS (SELECT p.row_id, s.row_id AS target, s.depth AS imported, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) AS d FROM depths p, depths s WHERE p.row_id % 3 = 0 AND s.row_id % 3 <> 0 AND abs(p.x - s.x) <= 12 AND abs(p.y - s.y) <= 12),
b AS (SELECT row_id, target, imported, d FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, target) AS k FROM j) WHERE k = 1 AND d <= 12)
SELECT p.row_id, target, round(d * 1000)::BIGINT AS mm, round((depth - imported) * 1000)::BIGINT AS difference_mm FROM depths p LEFT JOIN b USING (row_id) WHERE p.row_id % 3 = 0"""
)
def own_against_imported(spark: SparkSession, d: str) -> DataFrame:
    p = S.depths(spark, d)
    got = surface.compared(p.where("row_id % 3 = 0"), p.where("row_id % 3 <> 0"), key="row_id", imported_key="row_id", within=12.0, cell=3.0)
    return got.select("row_id", "target", F.round(F.col("distance") * 1000).cast("long").alias("mm"), F.round(F.col("difference") * 1000).cast("long").alias("difference_mm"))


@query(
    "WITH "
    + S.DEPTHS
    + """, z AS (SELECT 25 * pow(2, k) AS size FROM range(0, 24) r(k)), n AS (SELECT size, count(DISTINCT ROW(round_even(x / size, 0), round_even(y / size, 0))) AS n FROM depths, z GROUP BY size),
f AS (SELECT min(size) AS size FROM n WHERE n <= 200), c AS (SELECT d.*, round_even(x / size, 0) AS gx, round_even(y / size, 0) AS gy FROM depths d, f)
SELECT row_id, depth FROM (SELECT *, row_number() OVER (PARTITION BY gx, gy ORDER BY CASE WHEN wet THEN -depth ELSE depth END, row_id) AS k FROM (SELECT *, bool_or(depth >= 0) OVER (PARTITION BY gx, gy) AS wet FROM c)) WHERE k = 1"""
)
def thin_to_import_cap(spark: SparkSession, d: str) -> DataFrame:
    return thin.thin_to_cap(S.depths(spark, d), "depth", "row_id", cap=200).select("row_id", "depth")


@query(
    "WITH "
    + S.DEPTHS
    + """, e AS (SELECT cell, CASE WHEN max(depth) >= 0 THEN max(depth) ELSE min(depth) END AS expected, max(depth) AS kept, count(*) AS n FROM depths GROUP BY cell) SELECT cell, n, kept, expected, kept = expected AS ok FROM e"""
)
def kept_against_rule(spark: SparkSession, d: str) -> DataFrame:
    p = S.depths(spark, d)
    return quality.kept_as_expected(p, p.groupBy("cell").agg(F.max("depth").alias("depth")), ("cell",), "depth")


@query(
    """WITH o AS (SELECT c_nationkey AS rel_id, c_custkey AS pos, (c_custkey * 37 % 100)::DOUBLE AS x, (c_custkey * 91 % 100)::DOUBLE AS y FROM customer WHERE c_custkey % 2 = 0),
i AS (SELECT c_nationkey AS rel_id, c_custkey AS pos, (c_custkey * 53 % 100) + 0.25e0 AS x, (c_custkey * 29 % 100) + 0.25e0 AS y FROM customer WHERE c_custkey % 2 = 1),
h AS (SELECT o.rel_id, o.pos, i.pos AS ipos FROM o JOIN i ON i.rel_id = o.rel_id AND i.x + 0.5e0 > o.x AND i.x + 0.5e0 < o.x + 10 AND i.y + 0.5e0 > o.y AND i.y + 0.5e0 < o.y + 10)
SELECT o.rel_id, o.pos, (1 + count(h.ipos))::INT AS n_rings, coalesce(string_agg(h.ipos, ',' ORDER BY h.ipos), '') AS holes FROM o LEFT JOIN h ON h.rel_id = o.rel_id AND h.pos = o.pos GROUP BY 1, 2"""
)
def rings_with_holes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    square = lambda x, y, side: F.array(*(F.struct((x + side * a).alias("x"), (y + side * b).alias("y")) for a, b in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0))))
    ring = F.when(k % 2 == 0, square((k * 37 % 100).cast("double"), (k * 91 % 100).cast("double"), 10.0)).otherwise(square(k * 53 % 100 + 0.25, k * 29 % 100 + 0.25, 1.0))
    m = S.table(spark, d, "customer").select(F.col("c_nationkey").alias("rel_id"), k.alias("pos"), F.when(k % 2 == 0, "outer").otherwise("inner").alias("role"), ring.alias("ring"))
    return spatial.holes_of(m, of="pos").select("rel_id", "pos", (F.size("holes") + 1).alias("n_rings"), F.array_join(F.transform("holes", lambda h: h.cast("string")), ",").alias("holes"))


@query(
    """SELECT c_custkey::INT AS fseq, trim(c_name) AS name, CASE c_custkey % 4 WHEN 0 THEN 'MNP' WHEN 1 THEN 'CPZ' WHEN 2 THEN 'HPZ' ELSE 'GUZ' END AS zt, c_custkey % 4 = 0 AS notake,
round(round((152.9e0 + c_acctbal / 7e4) * 1e5) / 1e5 * 1e5)::BIGINT AS x_e5, 4 AS n_vertices FROM customer"""
)
def zone_features(spark: SparkSession, d: str) -> DataFrame:
    k, x = F.col("c_custkey"), F.lit(152.9) + F.col("c_acctbal") / F.lit(7e4)
    kind = F.when(k % 4 == 0, " Marine National Park Zone").when(k % 4 == 1, "Conservation Park Zone ").when(k % 4 == 2, "Habitat Protection Zone").otherwise("General Use Zone")
    record = F.create_map(F.lit("zone_type"), kind, F.lit("zone_name"), F.concat(F.lit(" "), "c_name"), F.lit("zone_id"), F.concat(F.lit("Z"), k.cast("string")))
    ring = F.array(*(F.struct((x + a).alias("x"), F.lit(-27.0 + b).alias("y")) for a, b in ((0.0, 0.0), (0.1, 0.0), (0.0, 0.1))))
    r = S.table(spark, d, "customer").select(k.cast("int").alias("fseq"), record.alias("record"), F.array(ring).alias("rings"))
    f = zones.features(r, "plan", "source")
    return f.select("fseq", "name", "zt", "notake", F.round(F.col("rings")[0][0]["x"] * 1e5).cast("long").alias("x_e5"), F.size(F.col("rings")[0]).alias("n_vertices"))


@query(
    "WITH "
    + S.DEPTHS
    + """, w AS (SELECT row_id % 7 AS part, row_id, round(x * 100)::BIGINT AS x, round(y * 100)::BIGINT AS y, round(depth * 100)::BIGINT AS depth FROM depths)
SELECT part, '{"x":[' || string_agg(x, ',' ORDER BY row_id) || '],"y":[' || string_agg(y, ',' ORDER BY row_id) || '],"depth":[' || string_agg(depth, ',' ORDER BY row_id) || ']}' AS json FROM w GROUP BY part"""
)
def packed_integer_columns(spark: SparkSession, d: str) -> DataFrame:
    p = S.depths(spark, d).withColumn("part", F.col("row_id") % 7)
    return packing.integer_json(packing.columnar(p, "part", "row_id", (("x", 100), ("y", 100), ("depth", 100))), "part")
