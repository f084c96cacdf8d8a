"""Rasters in long form (region, row, col, value): mosaic, thresholds, boolean combination, coast side, run lengths."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.columns import cross_side
from .spatial import nearest_neighbour

WET, OPEN_WATER = 0.2, 0.9


def valid(freq: str = "freq") -> Column:
    """The value, or null where it is not a number."""
    return F.when(~F.isnan(freq), F.col(freq))


def mosaic(parts: DataFrame, keys: tuple[str, ...] = ("region", "row", "col")) -> DataFrame:
    """Overlapping tiles as one raster: of the tiles with a number the last by tile_seq wins."""
    return parts.groupBy(*keys).agg(F.max_by(valid(), F.when(valid().isNotNull(), F.col("tile_seq"))).alias("freq"))


def wet(freq: str = "freq", least: float = WET) -> Column:
    return F.coalesce(valid(freq), F.lit(0.0)) >= least


def combine(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("region", "row", "col")) -> DataFrame:
    """Both rasters' bits, their AND and their OR; a cell that one lacks is false there."""
    both = a.select(*keys, F.col("bit").alias("a")).join(b.select(*keys, F.col("bit").alias("b")), list(keys), "full_outer")
    x, y = (F.coalesce(c, F.lit(False)) for c in ("a", "b"))
    return both.select(*keys, (x & y).alias("both"), (x | y).alias("either"))


def share_true(bits: DataFrame, bit: str = "bit") -> DataFrame:
    return bits.groupBy("region").agg(F.avg(F.col(bit).cast("double")).alias("share"), F.count("*").alias("n_cells"))


def densify(ways: DataFrame, step: float) -> DataFrame:
    """Points along each way's segments, at most `step` apart, with their segment's ends; a segment's end is the next's start."""
    w = W.partitionBy("way_id").orderBy("pos")
    s = ways.withColumns({"bx": F.lead("x").over(w), "by": F.lead("y").over(w)}).where("bx IS NOT NULL")
    n = F.greatest(F.lit(1), (F.hypot(F.col("bx") - F.col("x"), F.col("by") - F.col("y")) / step).cast("int"))
    s = s.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    t = F.col("k") / F.col("n")
    return s.select("way_id", "pos", "k", (F.col("x") + t * (F.col("bx") - F.col("x"))).alias("x"), (F.col("y") + t * (F.col("by") - F.col("y"))).alias("y"), F.col("x").alias("ax"), F.col("y").alias("ay"), "bx", "by")


def sea_side(cells: DataFrame, ways: DataFrame, *, key: str, step: float, cell: float, reach: int = 64) -> DataFrame:
    """Whether each cell lies on the sea side (the right) of its nearest coast point's segment; null without a coast in reach."""
    coast = densify(ways, step).withColumn("cid", F.struct("way_id", "pos", "k"))
    near = nearest_neighbour(cells, coast, key=key, target_key="cid", cell=cell, reach=reach)
    met = near.join(cells.select(key, F.col("x").alias("px"), F.col("y").alias("py")), key).join(coast.select(F.col("cid").alias("target"), "ax", "ay", "bx", "by"), "target", "left")
    return met.select(key, "distance", (cross_side("px", "py", "ax", "ay", "bx", "by") < 0).alias("sea"))


def run_lengths(bits: DataFrame, order: str = "i", group: str = "region") -> DataFrame:
    """Runs of equal bits in order: start and length, by gaps and islands. `order` counts without gaps from any start."""
    w = W.partitionBy(group, "bit").orderBy(order)
    return bits.withColumn("island", F.col(order) - F.row_number().over(w)).groupBy(group, "bit", "island").agg(F.min(order).alias("start"), F.count("*").alias("length")).drop("island")


def varint_hex(v: Column) -> Column:
    """An unsigned number as LEB128, in hexadecimal: groups of seven bits, low ones first, all but the last marked."""
    groups = F.ceil(F.greatest(F.lit(1), F.length(F.bin(v))) / 7).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), groups - 1), lambda k: F.lpad(F.hex(F.call_function("shiftrightunsigned", v.cast("long"), 7 * k).bitwiseAND(F.lit(127)).bitwiseOR(F.when(k < groups - 1, 128).otherwise(0))), 2, "0")), "")


def encode(runs: DataFrame, group: str = "region") -> DataFrame:
    """Run lengths as base64 of unsigned LEB128 numbers, zeros first: a raster that begins with ones has an empty first run."""
    lists = runs.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("start", "length", "bit"))).alias("r"))
    lengths = F.concat(F.when(F.get("r", F.lit(0))["bit"], F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<bigint>")), F.transform("r", lambda x: x["length"]))
    packed = F.unhex(F.array_join(F.transform(lengths, varint_hex), ""))
    return lists.select(group, F.regexp_replace(F.base64(packed), r"\s", "").alias("rle"), F.size(lengths).alias("n_runs"))


def varints(values) -> bytes:
    """The numbers as varint_hex() writes them, outside Spark."""
    out = bytearray()
    for v in map(int, values):
        while v > 0x7F:
            out.append(v & 0x7F | 0x80)
            v >>= 7
        out.append(v)
    return bytes(out)


def bits_of(data: bytes) -> Iterator[bool]:
    """The bits that encode() packed."""
    value, shift, bit = 0, 0, False
    for b in data:
        value |= (b & 0x7F) << shift
        shift += 7
        if not b & 0x80:
            yield from (bit for _ in range(value))
            value, shift, bit = 0, 0, not bit
