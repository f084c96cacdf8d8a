"""Audits of misclassified cells: adjacency and density tests, tile status, examples, summaries, checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.columns import GRID_M, centre_floor

CELL_KM2 = GRID_M * GRID_M / 1e6


def adjacent(c9: int = 20, c2: int = 100, gap: float = 0.5) -> Column:
    """A cell with enough water and ground returns at nearly one height."""
    return (F.col("c9") >= c9) & (F.col("c2") >= c2) & (F.abs(F.col("z2") - F.col("z9")) <= gap)


def dense(c2: int = 1500, height: float = 1.5) -> Column:
    """A cell with implausibly many low ground returns."""
    return (F.col("c2") >= c2) & (F.col("z2") <= height)


def tile_status(cells: DataFrame, suspicious: Column, *, need_water: bool = True) -> DataFrame:
    """Per tile: status, class counts, suspicious cells, and the largest and the (truncated) mean ground count of these."""
    s = cells.withColumn("sus", F.coalesce(suspicious, F.lit(False)))
    hit = F.when(F.col("sus"), F.col("c2"))
    t = s.groupBy("tile_id", "survey").agg(F.sum("c2").alias("n2"), F.sum("c9").alias("n9"), F.count_if("sus").alias("sus_cells"), F.max(hit).alias("max_density"), (F.sum(hit) / F.count(hit)).cast("long").alias("mean_density"))
    absent = (F.col("n2") == 0) | ((F.col("n9") == 0) if need_water else F.lit(False))
    return t.select("tile_id", "survey", F.when(absent, "clean_by_absence").when(F.col("sus_cells") == 0, "clean").otherwise("HIT").alias("status"), "n2", "n9", "sus_cells", "max_density", "mean_density", (F.col("sus_cells") * F.lit(CELL_KM2)).alias("area_km2"))


def top_examples(cells: DataFrame, suspicious: Column, most: int = 3) -> DataFrame:
    """Each tile's suspicious cells with the most ground returns, at their centres; ties by cell."""
    w = W.partitionBy("tile_id").orderBy(F.col("c2").desc(), "cx", "cy")
    return cells.where(suspicious).withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select("tile_id", "place", "cx", "cy", centre_floor("cx").alias("x"), centre_floor("cy").alias("y"), "c2", "c9", "z2", "z9")


def survey_summary(results: DataFrame, least: int = 50) -> DataFrame:
    """Per survey and in total (survey null, is_total 1): tiles, hits, hits of at least `least` cells and their area."""
    hit = F.col("status") == "HIT"
    big = hit & (F.coalesce("sus_cells", F.lit(0)) >= least)
    return results.rollup("survey").agg(F.grouping("survey").cast("int").alias("is_total"), F.count("*").alias("n_tiles"), F.count_if(hit).alias("n_hit"), F.count_if(big).alias("n_artifact"), F.coalesce(F.sum(F.when(big, F.col("sus_cells"))), F.lit(0)).alias("artifact_cells")).withColumn("artifact_km2", F.col("artifact_cells") * F.lit(CELL_KM2))


def running_total(results: DataFrame, tiles: int = 192, km2: float = 13.61, least: int = 50) -> DataFrame:
    """Earlier totals, given, plus what results add."""
    big = (F.col("status") == "HIT") & (F.coalesce("sus_cells", F.lit(0)) >= least)
    got = results.agg(F.count_if(big).alias("new_tiles"), F.coalesce(F.sum(F.when(big, F.col("sus_cells"))), F.lit(0)).alias("cells"))
    return got.select("new_tiles", (F.col("cells") * F.lit(CELL_KM2)).alias("new_km2"), (F.col("new_tiles") + tiles).alias("total_tiles"), (F.col("cells") * F.lit(CELL_KM2) + F.lit(km2)).alias("total_km2"))


def merge_results(old: DataFrame, new: DataFrame, key: str = "name", group: str = "group") -> DataFrame:
    """old and new together; raises if old was merged before (has a method), or if a new row of group A repeats an old key.

    Rows of other groups may repeat one: they were audited by another rule. Without a group column all rows are of group A.
    """
    if "method" in old.columns and not old.where("method IS NOT NULL").isEmpty():
        raise ValueError("results were merged before")
    guarded = new.where(F.col(group) == "A") if group in new.columns else new
    if not guarded.join(old, key, "left_semi").isEmpty():
        raise ValueError("new results repeat old ones")
    return old.unionByName(new, allowMissingColumns=True)


def top_tiles(results: DataFrame, most: int = 2, order: str = "tile_id") -> DataFrame:
    """Each survey's tiles with the most suspicious cells; ties in input order."""
    w = W.partitionBy("survey").orderBy(F.col("sus_cells").desc(), order)
    return results.where("status = 'HIT'").withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def membership(examples: DataFrame, flagged: DataFrame) -> DataFrame:
    """Per tile: examples, and how many are among the flagged cells."""
    marked = examples.join(flagged.select("tile_id", "cx", "cy", F.lit(True).alias("hit")).distinct(), ["tile_id", "cx", "cy"], "left")
    return marked.groupBy("tile_id").agg(F.count("*").alias("n_examples"), F.count_if("hit").alias("n_found"))


def count_check(actual: DataFrame, expected: DataFrame, key: str = "tile_id") -> DataFrame:
    """n_cells against expected for each key of either side; a side that lacks it counts as null."""
    return actual.join(expected, key, "full_outer").select(key, "n_cells", "expected", F.col("n_cells").eqNullSafe(F.col("expected")).alias("matches"))


def require_match(checked: DataFrame) -> DataFrame:
    """checked, or an error if any count differs."""
    if not checked.where("NOT matches").isEmpty():
        raise ValueError("cell counts differ from what was expected")
    return checked


def group_picture(new: DataFrame, old: DataFrame, surveys: Sequence[str], group: str = "group") -> DataFrame:
    """New rows of group A with the earlier spot tiles of the same surveys: those without a method."""
    spot = old.where(F.col("survey").isin(*surveys))
    if "method" in old.columns:
        spot = spot.where("method IS NULL OR method = ''")
    return new.where(F.col(group) == "A").unionByName(spot, allowMissingColumns=True)


def displayed(summary: DataFrame) -> DataFrame:
    """survey_summary() in the order of a report: surveys by name, the total last."""
    return summary.orderBy("is_total", "survey")
