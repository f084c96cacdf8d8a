"""Gridding of points: medians by priority, by tile, by class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.columns import GRID_M, cell_floor, cell_round, exact_sum


def ground(points: DataFrame, classes: Sequence[int] = (2,), low: float = -3.0, high: float = 5.0) -> DataFrame:
    """Points of the classes with an elevation in the closed band."""
    return points.where(F.col("cls").isin(*classes) & F.col("z").between(low, high))


def rank_priority_cells(points: DataFrame, order: Sequence[str], *, size: float = GRID_M, carry: Sequence[str] = ("x", "y", "epsg")) -> DataFrame:
    """The lowest rank present takes a cell: median of its z, its first point by `order`, and its number of points.

    The cell key has no CRS. Medians are formed for each (cell, rank) with map-side partial aggregates and the winner is
    picked among those few rows, so no point is sorted and no cell's points meet in a window.
    """
    first = F.min_by(F.struct(*carry), F.struct(*order))
    by_rank = points.groupBy(cell_round("x", size).alias("ex"), cell_round("y", size).alias("ny"), "rank").agg(F.median("z").alias("z"), first.alias("first"), F.count("*").alias("n"))
    best = by_rank.groupBy("ex", "ny").agg(F.min_by(F.struct("rank", "z", "first", "n"), "rank").alias("b"))
    return best.select("ex", "ny", "b.rank", "b.z", *(F.col(f"b.first.{c}").alias(c) for c in carry), "b.n")


def hash_sample(points: DataFrame, order: Sequence[str], *, size: float = GRID_M, most: int = 15, seed: int = 42) -> DataFrame:
    """A sample of at most `most` points of each cell's winning rank, by hash order: repeatable whatever the order of
    arrival. The limit is the operator's purpose; rank_priority_cells has the exact median."""
    cells = W.partitionBy("ex", "ny")
    p = points.withColumns({"ex": cell_round("x", size), "ny": cell_round("y", size)})
    keys = F.xxhash64(F.lit(seed), *order)
    return p.withColumn("low", F.min("rank").over(cells)).where("rank = low").withColumn("place", F.row_number().over(cells.orderBy(keys, *order))).where(F.col("place") <= most).groupBy("ex", "ny", "rank").agg(F.sort_array(F.collect_list("z")).alias("z_sample"), F.max("place").cast("long").alias("n_sample"))


def two_level_median(points: DataFrame, *, size: float = GRID_M, digits: int = 6) -> DataFrame:
    """Mean of the tiles' medians in a cell, weighted by their numbers of points; summed exactly."""
    by_tile = points.groupBy("tile_id", cell_round("x", size).alias("ge"), cell_round("y", size).alias("gn")).agg(F.median("z").alias("m"), F.count("*").alias("n"))
    sums = by_tile.groupBy("ge", "gn").agg(exact_sum(F.col("m") * F.col("n"), digits).alias("s"), F.sum("n").alias("n"), F.count("*").alias("n_tiles"))
    return sums.select("ge", "gn", (F.col("s").cast("double") / F.lit(10.0**digits) / F.col("n")).alias("z"), "n", "n_tiles")


def class_cells(points: DataFrame, *, size: float = GRID_M, water: int = 9, land: int = 2) -> DataFrame:
    """Per tile and cell: counts and medians of the two classes, in one aggregate instead of a join of two."""
    w, g = F.col("cls") == water, F.col("cls") == land
    z = lambda c: F.median(F.when(c, F.col("z")))
    return points.where(w | g).groupBy("tile_id", "survey", cell_floor("x", size).alias("cx"), cell_floor("y", size).alias("cy")).agg(F.count_if(w).alias("c9"), F.count_if(g).alias("c2"), z(w).alias("z9"), z(g).alias("z2"))


def coverage(points: DataFrame, *, size: float = GRID_M) -> DataFrame:
    """Each survey's distinct cells, whichever survey wins them."""
    return points.select("survey", cell_round("x", size).alias("cx"), cell_round("y", size).alias("cy")).distinct()


def box(x: str, y: str, x1: float, x2: float, y1: float, y2: float) -> Column:
    """Inside a closed box."""
    return F.col(x).between(x1, x2) & F.col(y).between(y1, y2)


def drop_reasons(points: DataFrame, classes: Sequence[int], extent: Column, hole: Column) -> DataFrame:
    """How many points each step of the filter chain drops, in one pass; the hole counts points in the extent only."""
    wanted = F.col("cls").isin(*classes)
    return points.agg(F.count("*").alias("n_read"), F.count_if(~wanted).alias("dropped_class"), F.count_if(wanted & ~extent).alias("dropped_extent"), F.count_if(wanted & extent & hole).alias("dropped_hole"), F.count_if(wanted & extent & ~hole).alias("n_kept"))
