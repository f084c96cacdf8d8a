"""Zone features: from records to rounded, simplified rings with checked codes, and to GeoJSON."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the domain.
ZONE_CODES = {"Marine National Park Zone": "MNP", "Conservation Park Zone": "CPZ", "Habitat Protection Zone": "HPZ", "General Use Zone": "GUZ"}
NO_TAKE = "MNP"
SIMPLIFY_DEGREES = 0.0001
RING_DIGITS = 5
RINGS = "array<array<struct<x: double, y: double>>>"
_ARROW_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def code_of(name: str, codes: dict[str, str] | None = None) -> Column:
    """A zone type's code, white space around it aside; an unknown type is an error."""
    out = F.raise_error(F.concat(F.lit("unknown zone type "), F.coalesce(F.col(name), F.lit("null"))))
    for text, code in (codes or ZONE_CODES).items():
        out = F.when(F.trim(name) == text, code).otherwise(out)
    return out


def no_take(code: str = "zt") -> Column:
    return F.col(code) == NO_TAKE


def tag(tags: str, key: str, default: str | None = None) -> Column:
    """A tag's value in a map, or the default."""
    return F.coalesce(F.element_at(tags, F.lit(key)), F.lit(default))


def rounded(rings: str = "rings", digits: int = RING_DIGITS) -> Column:
    r = lambda v: F.round(v, digits)
    return F.transform(rings, lambda ring: F.transform(ring, lambda v: F.struct(r(v["x"]).alias("x"), r(v["y"]).alias("y"))))


def _crosses_itself(p: np.ndarray) -> bool:
    """Whether two segments of a closed ring that are not neighbours meet."""
    a, b = p[:-1], p[1:]
    n = len(a)
    side = lambda o, d, q: (d[:, None, 0] - o[:, None, 0]) * (q[None, :, 1] - o[:, None, 1]) - (d[:, None, 1] - o[:, None, 1]) * (q[None, :, 0] - o[:, None, 0])
    c, d = side(a, b, a), side(a, b, b)
    apart = (c * d < 0) & (c * d < 0).T
    k = np.arange(n)
    near = (np.abs(k[:, None] - k[None, :]) <= 1) | (np.abs(k[:, None] - k[None, :]) == n - 1)
    return bool((apart & ~near).any())


def _kept(p: np.ndarray, tolerance: float) -> np.ndarray:
    """The vertices of a line that no chord between kept ones passes within the tolerance."""
    keep = np.zeros(len(p), bool)
    keep[[0, -1]] = True
    todo = [(0, len(p) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        v, q = p[j] - p[i], p[i + 1 : j] - p[i]
        size = float(v @ v)
        t = np.clip(q @ v / size, 0, 1) if size else np.zeros(len(q))
        far = np.hypot(*(q - t[:, None] * v).T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return keep


def simplified(tolerance: float = SIMPLIFY_DEGREES):
    """A function of rings: closed rings without vertices nearer than the tolerance to the line between their neighbours. A
    ring that would cross itself or have fewer than four vertices is halved in tolerance until it does not, then left."""

    @F.arrow_udf(RINGS)
    def run(column: pa.Array) -> pa.Array:
        def one(ring) -> list:
            p = np.array([(v["x"], v["y"]) for v in ring], float).reshape(-1, 2)
            size = tolerance
            for _ in range(6):
                if len(p) < 5:
                    break
                far = 1 + int(np.hypot(*(p[1:-1] - p[0]).T).argmax())  # a ring is two lines between its first vertex and the farthest
                keep = np.concatenate([_kept(p[: far + 1], size)[:-1], _kept(p[far:], size)])
                if keep.sum() >= 4 and not _crosses_itself(p[keep]):
                    p = p[keep]
                    break
                size /= 2
            return [{"x": x, "y": y} for x, y in p.tolist()]

        return pa.array([None if rings is None else [one(r) for r in rings] for rings in column.to_pylist()], _ARROW_RINGS)

    return run


def repaired():
    """A function of rings: vertices that repeat the one before go, open rings are closed, rings of fewer than four
    vertices go. Rings that cross themselves are left; valid() tells them."""

    @F.arrow_udf(RINGS)
    def run(column: pa.Array) -> pa.Array:
        def one(ring) -> list | None:
            p = [(v["x"], v["y"]) for v in ring if v is not None and v["x"] is not None and v["y"] is not None]
            p = [q for k, q in enumerate(p) if k == 0 or q != p[k - 1]]
            p += [p[0]] if p and p[0] != p[-1] else []
            return [{"x": x, "y": y} for x, y in p] if len(p) >= 4 else None

        return pa.array([None if rings is None else [r for r in map(one, rings) if r] for rings in column.to_pylist()], _ARROW_RINGS)

    return run


def valid():
    """A function of rings: whether there is a ring and all are closed, have four vertices and do not cross themselves."""

    @F.arrow_udf("boolean")
    def run(column: pa.Array) -> pa.Array:
        def one(ring) -> bool:
            p = np.array([(v["x"], v["y"]) for v in ring], float).reshape(-1, 2)
            return len(p) >= 4 and bool((p[0] == p[-1]).all()) and not _crosses_itself(p)

        return pa.array([rings is not None and len(rings) > 0 and all(map(one, rings)) for rings in column.to_pylist()], pa.bool_())

    return run


def features(records: DataFrame, plan: str, source: str, *, kind: str = "zone_type", name: str = "zone_name", zid: str = "zone_id") -> DataFrame:
    """(fseq, name, zt, zid, notake, plan, src, rings) out of records (fseq, record map, rings), repaired, simplified and
    rounded; white space around texts goes."""
    r = records.select("fseq", *(F.col("record")[c].alias(c) for c in (kind, name, zid)), "rings")
    out = r.select("fseq", F.trim(name).alias("name"), code_of(kind).alias("zt"), F.trim(zid).alias("zid"), simplified()(repaired()("rings")).alias("rings"))
    return out.select("fseq", "name", "zt", "zid", no_take().alias("notake"), F.lit(plan).alias("plan"), F.lit(source).alias("src"), rounded().alias("rings"))


def dedupe(zones: DataFrame, order: str = "fseq") -> DataFrame:
    """The first feature of each plan, id and name."""
    return zones.groupBy("plan", "zid", "name").agg(F.min_by(F.struct(*zones.columns), order).alias("r")).select("r.*")
