"""Whole sets of points as columns of numbers: integer JSON, 32- and 16-bit columns, zigzag deltas as varints.

A packed set is one value by its format, so one task gathers a group's points; groups are data sets, not tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .raster import varint_hex

# Fixed values of the formats: points a degree, points a metre.
DEGREES, METRES = 1_000_000, 100
COLUMNS = (("lat", DEGREES), ("lng", DEGREES), ("depth", METRES))


def whole(points: DataFrame, columns: Sequence[tuple[str, int]] = COLUMNS) -> DataFrame:
    """points with the columns as whole numbers, rounded half away from zero."""
    return points.withColumns({c: F.round(F.col(c) * F.lit(float(s)), 0).cast("long") for c, s in columns})


def columnar(points: DataFrame, group: str, order: str, columns: Sequence[tuple[str, int]] = COLUMNS) -> DataFrame:
    """(group, n, one array of whole numbers for each column), points in order."""
    names = [c for c, _ in columns]
    rows = whole(points, columns).groupBy(group).agg(F.sort_array(F.collect_list(F.struct(order, *names))).alias("r"))
    return rows.select(group, F.size("r").alias("n"), *(F.col(f"r.{c}").alias(c) for c in names))


def integer_json(columns: DataFrame, group: str) -> DataFrame:
    """(group, json): the arrays of columnar() as one compact object."""
    return columns.select(group, F.to_json(F.struct(*(c for c in columns.columns if c not in (group, "n")))).alias("json"))


def _bytes(values: str, size: int) -> Column:
    """Numbers as little-endian two's complement of `size` bytes, in hexadecimal."""
    part = lambda v, k: F.lpad(F.hex(F.call_function("shiftrightunsigned", v.cast("long"), F.lit(8 * k)).bitwiseAND(F.lit(255))), 2, "0")
    return F.array_join(F.transform(values, lambda v: F.concat(*(part(v, k) for k in range(size)))), "")


def fixed(columns: DataFrame, group: str, sizes: Sequence[int] = (4, 4, 2)) -> DataFrame:
    """(group, packed): the arrays one after the other, in 4, 4 and 2 bytes a number; a number that does not fit is an error."""
    names = [c for c in columns.columns if c not in (group, "n")]
    good = F.lit(True)
    for c, s in zip(names, sizes, strict=True):
        bound = 1 << 8 * s - 1
        good = good & (F.coalesce(F.array_min(c), F.lit(0)) >= -bound) & (F.coalesce(F.array_max(c), F.lit(0)) < bound)
    body = F.concat(*(_bytes(c, s) for c, s in zip(names, sizes, strict=True)))
    return columns.select(group, F.when(good, F.unhex(body)).otherwise(F.raise_error(F.lit("a number does not fit its bytes")).cast("binary")).alias("packed"))


def delta_varints(columns: DataFrame, group: str) -> DataFrame:
    """(group, packed): each array's differences, zigzag (0, -1, 1, -2, ...), as varints, one array after the other."""

    def deltas(c: str) -> Column:
        before = F.concat(F.array(F.lit(0).cast("long")), F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))))
        return F.transform(F.zip_with(c, before, lambda a, b: a - b), lambda d: F.shiftleft(d, 1).bitwiseXOR(F.shiftright(d, 63)))

    names = [c for c in columns.columns if c not in (group, "n")]
    body = F.concat(*(F.array_join(F.transform(deltas(c), varint_hex), "") for c in names))
    return columns.select(group, F.unhex(body).alias("packed"))


def relative(columns: DataFrame, group: str) -> DataFrame:
    """(group, low, high, packed): each array scaled from its own bounds to 16 bits, which loses what is finer."""
    names = [c for c in columns.columns if c not in (group, "n")]
    low, high = F.array(*(F.array_min(c) for c in names)), F.array(*(F.array_max(c) for c in names))
    ready = columns.withColumns({"low": low, "high": high})

    def share(c: str, k: int) -> Column:
        at, span = F.col("low")[k], F.greatest(F.lit(1), F.col("high")[k] - F.col("low")[k])
        return F.transform(c, lambda v: F.round((v - at) * F.lit(65535.0) / span, 0).cast("long"))

    scaled = ready.withColumns({c: share(c, k) for k, c in enumerate(names)})
    return scaled.select(group, "low", "high", F.unhex(F.concat(*(_bytes(c, 2) for c in names))).alias("packed"))


def numbers_of(data: bytes) -> list[int]:
    """The differences that delta_varints() packed, zigzag undone; a reader sums each column's n of them up."""
    out, value, shift = [], 0, 0
    for b in data:
        value |= (b & 0x7F) << shift
        shift += 7
        if not b & 0x80:
            out.append(value >> 1 ^ -(value & 1))
            value, shift = 0, 0
    return out
