"""Tiles taken in as they arrive: an extension of the batch operators on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import GRID_M, cell_round, exact_sum


def tile_medians(points: DataFrame, *, size: float = GRID_M) -> DataFrame:
    """A batch's median and number of points for each tile and cell."""
    return points.groupBy("tile_id", cell_round("x", size).alias("ge"), cell_round("y", size).alias("gn")).agg(F.median("z").alias("m"), F.count("*").alias("n"))


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, *, size: float = GRID_M, files_per_batch: int = 16) -> None:
    """Take in all new files of source (Parquet points, whole tiles) and stop.

    Each batch writes its tiles' medians below target/batch=<id>, replacing what a failed attempt left: a batch counts
    once. The file source's checkpoint remembers what was read.
    """

    def write(batch: DataFrame, k: int) -> None:
        tile_medians(batch, size=size).write.mode("overwrite").parquet(f"{target}/batch={k}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def cells(spark: SparkSession, target: str, digits: int = 6) -> DataFrame:
    """Cell values out of all tiles taken in so far: the tiles' medians weighted by their points."""
    s = spark.read.parquet(target).groupBy("ge", "gn").agg(exact_sum(F.col("m") * F.col("n"), digits).alias("s"), F.sum("n").alias("n"))
    return s.select("ge", "gn", (F.col("s").cast("double") / F.lit(10.0**digits) / F.col("n")).alias("z"), "n")


def unprocessed(tiles: DataFrame, done: DataFrame, key: str = "tile_id") -> DataFrame:
    return tiles.join(done, key, "left_anti")
