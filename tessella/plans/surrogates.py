"""Inputs that have the shape of surveys, made from the star-schema tables: they exercise operators, not geography."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spatial import PORT_SCHEMA, PORTS, REGION_SCHEMA, REGIONS, small

ORDER = ("tile_id", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")
ZONES = (
    (1, "North Reef", "MNP", ((152.5, -27.3), (152.9, -27.25), (153.0, -26.7), (152.6, -26.6))),
    (2, "Bay", "HPZ", ((152.4, -27.5), (153.2, -27.4), (153.1, -26.2), (152.45, -26.3))),
    (3, "Spit", "XYZ", ((152.3, -26.0), (152.9, -26.05), (152.8, -25.2), (152.35, -25.1))),
    (4, "Shelf", "GUZ", ((152.3, -27.55), (153.25, -27.5), (153.3, -25.0), (152.25, -24.9))),
)
COVERAGE = ((1, "park", -27.6, 152.2, -26.0, 153.4), (2, "notloaded_north", -26.0, 152.2, -25.3, 153.4))
WAYS = ((1, 0, 0.0, 0.0), (1, 1, 400.0, 37.0), (1, 2, 700.0, 411.0), (1, 3, 1000.0, 1003.0), (2, 0, 31.0, 600.0), (2, 1, 250.0, 900.0))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def points(spark: SparkSession, d: str) -> DataFrame:
    li, s, n = (table(spark, d, t) for t in ("lineitem", "supplier", "nation"))
    tiles = s.join(small(n), s["s_nationkey"] == n["n_nationkey"]).select(F.col("s_suppkey").alias("tile_id"), F.col("n_name").alias("survey"), F.col("n_regionkey").alias("rank"), F.when(F.col("n_nationkey") % 2 == 0, 28356).otherwise(7856).alias("epsg"))
    x = F.lit(503000) + F.col("l_orderkey") * 7 % 1000 + F.lit(0.37) * F.col("l_quantity")
    y = F.lit(7052000) + F.col("l_partkey") * 13 % 1000 + F.lit(10.0) * F.col("l_discount")
    cls = F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "N", 9).otherwise(13)
    rows = li.select(F.col("l_suppkey").alias("tile_id"), "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice", cls.alias("cls"), x.alias("x"), y.alias("y"), (F.col("l_extendedprice") / F.lit(10000.0) - F.lit(3.0)).alias("z"))
    return rows.join(tiles, "tile_id")


POINTS = """pts AS (
  SELECT l_suppkey AS tile_id, n_name AS survey, n_regionkey AS rank, CASE WHEN n_nationkey % 2 = 0 THEN 28356 ELSE 7856 END AS epsg,
         CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 9 ELSE 13 END AS cls,
         503000 + l_orderkey * 7 % 1000 + 0.37e0 * l_quantity AS x, 7052000 + l_partkey * 13 % 1000 + 10e0 * l_discount AS y,
         l_extendedprice / 10000e0 - 3e0 AS z, l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def places(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("pid"), (F.lit(-27.6) + F.lit(3.0) * (k * 37 % 1000) / F.lit(1000.0)).alias("lat"), (F.lit(152.2) + F.lit(1.2) * (k * 91 % 997) / F.lit(1000.0)).alias("lng"), (F.col("c_acctbal") / F.lit(2500.0)).alias("e"))


PLACES = "places AS (SELECT c_custkey AS pid, -27.6e0 + 3e0 * (c_custkey * 37 % 1000) / 1000e0 AS lat, 152.2e0 + 1.2e0 * (c_custkey * 91 % 997) / 1000e0 AS lng, c_acctbal / 2500e0 AS e FROM customer)"


def depths(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, d, "events").select(k.alias("row_id"), (k * 7919 % 2500).alias("cell"), (F.col("value") - F.lit(40.0)).alias("depth"), (k * 37 % 1009).cast("double").alias("x"), (k * 91 % 997).cast("double").alias("y"))


DEPTHS = "depths AS (SELECT event_id AS row_id, event_id * 7919 % 2500 AS cell, value - 40e0 AS depth, (event_id * 37 % 1009)::DOUBLE AS x, (event_id * 91 % 997)::DOUBLE AS y FROM events)"


def raster(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    freq = F.when(k % 11 == 0, F.lit(float("nan"))).otherwise((F.col("value") * 100 % 100) / F.lit(100.0))
    return table(spark, d, "events").select(F.when(k % 2 == 0, "a").otherwise("b").alias("region"), k.alias("tile_seq"), (k * 13 % 40).alias("row"), (k * 29 % 50).alias("col"), freq.alias("freq"), (F.col("event_type") == "click").alias("bit"))


RASTER = "raster AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS region, event_id AS tile_seq, event_id * 13 % 40 AS row, event_id * 29 % 50 AS col, CASE WHEN event_id % 11 = 0 THEN NULL ELSE (value * 100 % 100) / 100e0 END AS freq, event_type = 'click' AS bit FROM events)"


def ports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PORTS), PORT_SCHEMA)


def regions(spark: SparkSession, rows=REGIONS) -> DataFrame:
    return spark.createDataFrame(list(rows), REGION_SCHEMA)


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, n, z, [[(float(x), float(y)) for x, y in r]]) for s, n, z, r in ZONES], "zseq int, name string, zt string, rings array<array<struct<x: double, y: double>>>")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}e0" if isinstance(v, float) else str(v) for v in r) + ")" for r in rows)


PORT_VALUES = f"ports(seq, port, plat, plng, hat, b1, b2) AS (VALUES {_values(PORTS)})"
REGION_VALUES = f"regions(rseq, region, s, w, n, e) AS (VALUES {_values(REGIONS)})"
COVERAGE_VALUES = f"cover(rseq, region, s, w, n, e) AS (VALUES {_values(COVERAGE)})"
EDGES = "edges(zseq, zt, name, x1, y1, x2, y2) AS (VALUES " + _values((s, z, n, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for s, n, z, r in ZONES for a, b in zip(r, (*r[1:], r[0]), strict=True)) + ")"
WAY_VALUES = f"ways(way_id, pos, x, y) AS (VALUES {_values(WAYS)})"
