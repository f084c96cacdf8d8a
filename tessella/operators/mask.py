"""Masks of flagged cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import GRID_M, cell_floor


def union_of(flagged: DataFrame) -> DataFrame:
    """Distinct (epsg, cx, cy) of all tiles' flagged cells; accepts one row a cell or an array `cells` a tile."""
    if "cells" in flagged.columns:
        flagged = flagged.select("epsg", F.explode("cells").alias("c")).select("epsg", "c.cx", "c.cy")
    return flagged.select("epsg", "cx", "cy").distinct()


def drop_native(rows: DataFrame, mask: DataFrame, *, size: float = GRID_M) -> DataFrame:
    """Rows whose point (x, y) is in no masked cell of its own CRS."""
    keyed = rows.withColumns({"__cx": cell_floor("x", size), "__cy": cell_floor("y", size)})
    m = mask.select(F.col("epsg").alias("__epsg"), F.col("cx").alias("__mx"), F.col("cy").alias("__my"))
    return keyed.join(m, (keyed["epsg"] == m["__epsg"]) & (keyed["__cx"] == m["__mx"]) & (keyed["__cy"] == m["__my"]), "left_anti").drop("__cx", "__cy")


def drop_any(rows: DataFrame, mask: DataFrame, coordinates: Sequence[tuple[int, str, str]], *, size: float = GRID_M) -> DataFrame:
    """Rows that are in no masked cell of any CRS; coordinates names (epsg, x column, y column) for each."""
    for epsg, x, y in coordinates:
        m = mask.where(F.col("epsg") == epsg).select(F.col("cx").alias("__mx"), F.col("cy").alias("__my"))
        rows = rows.join(m, (cell_floor(x, size) == m["__mx"]) & (cell_floor(y, size) == m["__my"]), "left_anti")
    return rows
