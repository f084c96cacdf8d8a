"""Thinning to one point a cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.columns import cell_round
from ..storage import stored


def conditional_argmax(points: DataFrame, cell: Sequence[str], value: str, order: str) -> DataFrame:
    """Each cell's deepest point if any is under water, else its most drying one; ties to the first by `order`.

    Both candidates come from one aggregate with map-side partial results; no window holds a cell's points.
    """
    everything = F.struct(*points.columns)
    best = points.groupBy(*cell).agg(F.bool_or(F.col(value) >= 0).alias("wet"), F.min_by(everything, F.struct(-F.col(value), F.col(order))).alias("deep"), F.min_by(everything, F.struct(F.col(value), F.col(order))).alias("dry"))
    return best.select(F.when(F.col("wet"), F.col("deep")).otherwise(F.col("dry")).alias("p")).select("p.*")


def rule_differences(points: DataFrame, cell: Sequence[str], value: str, order: str) -> DataFrame:
    """How the conditional rule differs from the plain largest and the largest magnitude: cells, differences, sign flips."""
    v = F.col(value)
    pick = lambda key: F.min_by(v, F.struct(key, F.col(order)))
    kept = points.groupBy(*cell).agg(F.bool_or(v >= 0).alias("wet"), pick(-v).alias("signed"), pick(-F.abs(v)).alias("magnitude"), pick(v).alias("low")).withColumn("kept", F.when(F.col("wet"), F.col("signed")).otherwise(F.col("low")))
    flip = lambda c: F.count_if((F.col(c) >= 0) != (F.col("kept") >= 0))
    return kept.agg(F.count("*").alias("n_cells"), F.count_if(F.col("signed") != F.col("kept")).alias("differs_signed"), F.count_if(F.col("magnitude") != F.col("kept")).alias("differs_magnitude"), flip("signed").alias("flips_signed"), flip("magnitude").alias("flips_magnitude"))


def candidate_counts(points: DataFrame, sizes: Sequence[float] = (150, 175, 180, 200), target: float = 19_000) -> DataFrame:
    """Distinct cells at each size, in one pass, and the size that would meet the target."""
    each = points.select("x", "y", F.explode(F.array(*(F.lit(float(s)) for s in sizes))).alias("size"))
    n = each.groupBy("size").agg(F.count_distinct(F.rint(F.col("x") / F.col("size")), F.rint(F.col("y") / F.col("size"))).alias("n_cells"))
    return n.select("size", "n_cells", (F.col("size") * F.sqrt(F.col("n_cells") / F.lit(target))).alias("suggested"))


def spaced_picks(cells: DataFrame, order: str, picks: int = 5, least: int = 3) -> DataFrame:
    """Evenly spaced cells among those with enough points, first and last included.

    Cells are sorted once over all tasks; a count for each part says which parts hold a pick, and only these are ranked.
    """
    some = stored(cells.where(F.col("n") >= least).repartitionByRange(order).withColumn("__part", F.spark_partition_id()))
    counts = sorted(some.groupBy("__part").agg(F.count("*"), F.min(order).alias("first")).collect(), key=lambda r: r["first"])  # one row a task
    total, begin, wanted = sum(r[1] for r in counts), 0, []
    places = sorted({int(k * (total - 1) / max(picks - 1, 1)) for k in range(picks)}) if total else []
    for r in counts:
        wanted += [(r[0], p - begin, p) for p in places if begin <= p < begin + r[1]]
        begin += r[1]
    which = cells.sparkSession.createDataFrame(wanted, "__part int, __at int, place int")
    ranked = some.where(F.col("__part").isin(*{w[0] for w in wanted}) if wanted else F.lit(False)).withColumn("__at", F.row_number().over(W.partitionBy("__part").orderBy(order)) - 1)
    return ranked.join(F.broadcast(which), ["__part", "__at"]).drop("__part", "__at")  # as many rows as picks


def thin_to_cap(points: DataFrame, value: str, order: str, cap: int = 25_000, size: float = 25.0, doublings: int = 24) -> DataFrame:
    """points, or if they are more than cap one a cell by conditional_argmax() on the finest grid, of cells of size, twice
    that and so on, that leaves no more than cap."""
    if points.count() <= cap:
        return points
    sizes = [size * 2**k for k in range(doublings)]
    counts = {r["size"]: r["n_cells"] for r in candidate_counts(points, sizes).collect()}
    fit = [s for s in sizes if counts[s] <= cap]
    if not fit:
        raise ValueError(f"no grid up to {sizes[-1]} leaves {cap} points")
    gridded = points.withColumns({"__ge": cell_round("x", fit[0]), "__gn": cell_round("y", fit[0])})
    return conditional_argmax(gridded, ("__ge", "__gn"), value, order).drop("__ge", "__gn")


def grid(points: DataFrame, size: float) -> DataFrame:
    return points.withColumns({"ge": cell_round("x", size), "gn": cell_round("y", size)})
