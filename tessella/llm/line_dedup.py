"""Line deduplication by a segment-partition edit join.

Equal lines are one class from the start, by a 128-bit digest; what follows sees each distinct line once. Two lines within
T edits share one of T + 1 segments of the shorter, up to where it lies: a line of each length is cut into T + 1 segments,
and a line probes the index of lines up to T shorter with the substrings that can line up with a segment. Keys are hashes
of length, segment and substring; they travel packed and meet in numpy, shard by shard. Pairs that share a key are verified
by a banded bit-parallel edit distance, each only under the first segment that its shorter line shares with the other.

A key that many lines have never becomes a list of pairs: its lines are dealt into blocks, every two blocks meet in one task
of bounded size, and what comes out is a count of links for each line and the links that join components, so the rows are in
proportion to the lines. Where links need not be counted, lines are first linked with one line of their key, keys whose
lines are all in one component are finished, and pairs within a component are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, components, mix, powers, release, remove_but, shared_dir, slices, stored, string_buffers

EDITS = 2
#: Shorter lines recur rightly ("Yes.", a heading): removal leaves them alone.
MIN_CHARS = 24
#: Lines of fewer code points for each edit are linked only if equal; the edits are a fifth of a line at most.
CHARS_PER_EDIT = 5
#: Pairs of one key that a shard writes out itself; the lines of a key with more are compared in blocks.
OWN_PAIRS = 4096
#: Lines of one key in one slice beyond which they skip the key's shard and are dealt over all shards.
LOCAL_MANY = 256
#: A block's lines and bytes, about.
BLOCK_LINES = 256
BLOCK_BYTES = 1 << 20
#: Pairs of a block that are verified at once.
PAIRS_AT_ONCE = 4096
#: Rounds that link the lines of a key with one of them, where links need not be counted.
STAR_ROUNDS = 2
#: Ids that are broadcast at most, by count; beyond it a join shuffles.
BROADCAST_IDS = 1 << 20
SHARDS_PER_PARTITION = 6
#: Codec of the table of distinct lines, which is about as large as the input: it saves disk and takes memory of its own.
CODEC = "zstd"
#: Bytes of lines whose keys are made and packed at once.
KEY_BYTES = 1 << 20
_ONE = np.uint64(1)
_MARK = np.uint64(0xFFFFFFFFFFFFFFFF)
_ENTRY = np.dtype([("line", "<u8"), ("key", "<u4"), ("sign", "<u4"), ("role", "u1")])


# ---------------------------------------------------------------- lines and keys


def split_lines(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Row, number in the row, first byte, end and code points of the lines that have `least` code points, and the bytes."""
    buf = data[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]
    breaks = np.flatnonzero(buf == 10)
    owner, rows = np.searchsorted(at, breaks, "right") - 1, np.arange(len(at) - 1)
    starts, ends = np.concatenate([at[:-1], breaks + 1]), np.concatenate([at[1:], breaks])
    row = np.concatenate([rows, owner])
    order = np.lexsort((starts, row))
    starts, ends, row = starts[order], ends[np.lexsort((ends, row))], row[order]
    number = np.arange(len(row)) - np.searchsorted(row, row)
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    keep = chars >= least
    return row[keep], number[keep], starts[keep], ends[keep], chars[keep], buf


def digests(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    view, blake = memoryview(buf.tobytes()), hashlib.blake2b
    return [blake(view[s:e], digest_size=16).digest() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def segment(length, i: int, count: int) -> tuple:
    """Where segment i (from 0) of `count` begins in a line of the length, and how long it is."""
    first = length * i // count
    return first, length * (i + 1) // count - first


def reach(length, size, i: int, count: int) -> tuple:
    """The first and the last place in a line of `size` code points, at most count - 1 more than `length`, where segment i of
    a line of the length can stand within count - 1 edits, if no earlier segment does."""
    first, width = segment(length, i, count)
    less, after = size - length, count - 1 - i
    return np.maximum(np.maximum(0, first - i), first + less - after), np.minimum(np.minimum(size - width, first + i), first + less + after)


class Lines:
    """Code points, prefix hashes and bounds of a slice of rows that are one line each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        buf = data[offsets[0] : offsets[-1]]
        place = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # code points before each byte
        bounds = place[offsets - offsets[0]]
        self.starts, self.ends = bounds[:-1], bounds[1:]
        self.points = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
        p, self.inverse = powers(len(self.points))
        self.sums = np.zeros(len(self.points) + 1, np.uint64)
        np.cumsum((self.points.astype(np.uint64) + _ONE) * p[: len(self.points)], out=self.sums[1:])

    def part(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return (self.sums[e] - self.sums[s]) * self.inverse[s]

    def counts(self) -> np.ndarray:
        """Eight numbers of four bits for each line: how many of its code points fall into each of eight classes, modulo
        16. An edit changes at most two of them by one."""
        kind = (mix(np.arange(256, dtype=np.uint64)) & np.uint64(7)).astype(np.uint8)[self.points & np.uint32(255)]
        out = np.zeros(len(self.starts), np.uint32)
        for k in range(8):
            sums = np.zeros(len(kind) + 1, np.uint32)
            np.cumsum(kind == k, out=sums[1:])
            out |= ((sums[self.ends] - sums[self.starts]) & np.uint32(15)) << np.uint32(4 * k)
        return out

    def keys(self, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, the line's place, role): role 0 is the index and a probe of equal length, else 1 + how much longer the
        probing line is. The key's lowest five bits are the segment."""
        start, size, line = self.starts, self.ends - self.starts, np.arange(len(self.starts))
        keys, lines, roles = [], [], []
        count = edits + 1

        def add(length: np.ndarray, i: int, s: np.ndarray, width: np.ndarray, who: np.ndarray, role: int) -> None:
            made = mix(self.part(s, s + width) ^ mix(length.astype(np.uint64) * np.uint64(64) + np.uint64(i)))
            keys.append((made & ~np.uint64(31 << 32)) | np.uint64(i << 32))
            lines.append(who)
            roles.append(np.full(len(s), role, np.uint8))

        for i in range(count):
            first, width = segment(size, i, count)
            add(size, i, start + first, width, line, 0)
        for less in range(edits + 1):
            some = size - less >= count
            s, n, who, length = start[some], size[some], line[some], size[some] - less
            for i in range(count):
                first, width = segment(length, i, count)
                low, high = reach(length, n, i, count)
                for step in range(2 * edits + 1):
                    here = (low + step <= high) & ((low + step != first) | (less > 0))
                    if here.any():
                        add(length[here], i, (s + low + step)[here], width[here], who[here], 1 + less)
        return np.concatenate(keys), np.concatenate(lines), np.concatenate(roles)


def first_shared(x: str, y: str, count: int) -> int:
    """The first segment of x that y has where it can stand; x is not the longer one; count if there is none."""
    for i in range(count):
        first, width = segment(len(x), i, count)
        low, high = reach(len(x), len(y), i, count)
        if low <= high and y.find(x[first : first + width], int(low), int(high) + width) >= 0:
            return i
    return count


def edit_distances(xs: list[np.ndarray], ys: list[np.ndarray], edits: int) -> np.ndarray:
    """Edit distance of each pair, or edits + 1 where it is larger: bit vectors of vertical differences in a band of
    2 * edits + 1 cells that slides down the diagonal, one word for each pair, all pairs advancing together.

    edits is at most 31. The score follows the band's lowest cell down to the last row, and then along that row.
    """
    n = len(xs)
    out = np.full(n, edits + 1, np.int64)
    lx, ly = (np.array([len(t) for t in ts], np.int64) for ts in (xs, ys))
    todo = np.flatnonzero((np.abs(lx - ly) <= edits) & (lx > edits))
    for k in np.flatnonzero((np.abs(lx - ly) <= edits) & (lx <= edits)):  # too short for a band
        row = list(range(int(ly[k]) + 1))
        for i, c in enumerate(xs[k].tolist(), 1):
            last, row[0] = row[0], i
            for j, d in enumerate(ys[k].tolist(), 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        out[k] = min(row[-1], edits + 1)
    order = todo[np.argsort(-ly[todo], kind="stable")]
    if not len(order):
        return out
    m, size, band = lx[order], ly[order], 2 * edits + 1
    a = np.full((len(order), int(size.max()) + 2 * edits + 1), 0xFFFFFFFF, np.uint32)  # no code point
    b = np.full((len(order), int(size.max())), 0xFFFFFFFE, np.uint32)
    for k, p in enumerate(order):
        a[k, edits : edits + lx[p]] = xs[p]
        b[k, : ly[p]] = ys[p]
    weights = _ONE << np.arange(63 - 2 * edits, 64, dtype=np.uint64)
    up = np.full(len(order), np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(63 - edits), np.uint64)
    down = np.zeros(len(order), np.uint64)
    score = np.full(len(order), edits, np.int64)
    for i in range(int(size.max())):
        live = int(np.searchsorted(-size, -i, "left"))
        p, q = up[:live], down[:live]
        x = ((a[:live, i : i + band] == b[:live, i, None]) * weights).sum(axis=1, dtype=np.uint64)
        diagonal = (((x & p) + p) ^ p) | x | q
        right, left = q | ~(diagonal | p), diagonal & p
        along = i - (m[:live] - edits)  # columns since the band's lowest cell met the last row
        bit = _ONE << np.clip(62 - along, 0, 62).astype(np.uint64)
        score[:live] += np.where(along < 0, (diagonal >> np.uint64(63) == 0).astype(np.int64), ((right & bit) != 0).astype(np.int64) - ((left & bit) != 0))
        up[:live], down[:live] = left | ~((diagonal >> _ONE) | right), (diagonal >> _ONE) & right
    out[order] = np.minimum(score, edits + 1)
    return out


# ---------------------------------------------------------------- the join


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, copy (a hash of the text, which tells rows that share an id apart) and text."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select("id", F.xxhash64("text").alias("copy"), "text")


def lines_of(slim: DataFrame, least: int, bodies_from: int | None = None) -> DataFrame:
    """(id, copy, line, h, chars) of every line of at least `least` code points, where h is its digest; and body, its bytes,
    once in a slice, for lines of at least bodies_from code points."""
    names = ["id", "copy", "line", "h", "chars", *(["body"] if bodies_from is not None else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            data, at = string_buffers(b.column("text"))
            for i, j in slices(at):
                row, number, starts, ends, chars, buf = split_lines(data, at[i : j + 1], least)
                h = digests(buf, starts, ends)
                take = pa.array(row + i)
                columns = [b.column("id").take(take), b.column("copy").take(take), pa.array(number.astype(np.int32)), pa.array(h, pa.binary()), pa.array(chars.astype(np.int32))]
                if bodies_from is not None:
                    body: list[bytes | None] = [None] * len(h)
                    for k in {x: k for k, x in enumerate(h)}.values():
                        if chars[k] >= bodies_from:
                            body[k] = buf[starts[k] : ends[k]].tobytes()
                    columns.append(pa.array(body, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = (slim.schema["id"].dataType, T.LongType(), T.IntegerType(), T.BinaryType(), T.IntegerType(), T.BinaryType())
    return slim.mapInArrow(run, T.StructType([T.StructField(c, k) for c, k in zip(names, kinds, strict=False)]))


def distinct_lines(slim: DataFrame, least: int, bodies_from: int, path: str, codec: str) -> DataFrame:
    """(lid, h, first, n, body): each distinct line, numbered, with its first place and how often it occurs."""
    every = lines_of(slim, least, bodies_from)
    found = every.groupBy("h").agg(F.min(F.struct("id", "copy", "line")).alias("first"), F.count("*").alias("n"), F.first("body", ignorenulls=True).alias("body"))
    return stored(found.withColumn("lid", F.monotonically_increasing_id()), path, codec)


def _counts_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least sum of differences of counts() that two lines can have, as the counts are known modulo 16."""
    out = np.zeros(np.broadcast(x, y).shape, np.int64)
    for k in range(8):
        d = ((x >> np.uint32(4 * k)) - (y >> np.uint32(4 * k))) & np.uint32(15)
        out += np.minimum(d, np.uint32(16) - d)
    return out


def _possible(line: np.ndarray, role: np.ndarray, sign: np.ndarray, x: np.ndarray, y: np.ndarray, edits: int) -> np.ndarray:
    """Whether x indexes and y probes, so that a pair is looked at from one side only, and whether their counts allow so few edits."""
    return (role[x] == 0) & ((role[y] > 1) | (line[x] < line[y])) & (_counts_apart(sign[x], sign[y]) <= 2 * edits)


def candidates(lines: DataFrame, edits: int) -> DataFrame:
    """Of lines (lid, body): pairs (seg, a, b) under keys with few pairs, a indexing and b probing, with k null; and the
    entries (k, seg, a, sign, role) of keys with more."""
    shards = max(32, SHARDS_PER_PARTITION * lines._jdf.queryExecution().toRdd().getNumPartitions())
    names = ["k", "seg", "a", "b", "sign", "role"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        dealt = 0
        for b in batches:
            data, at = string_buffers(b.column("body").cast(pa.string()))
            lids = b.column("lid").to_numpy().astype(np.uint64)
            for i, j in slices(at, KEY_BYTES):
                found = Lines(data, at[i : j + 1])
                keys, place, role = found.keys(edits)
                made = np.zeros(len(keys), _ENTRY)
                made["line"], made["key"], made["sign"], made["role"] = lids[i:j][place], keys >> np.uint64(32), found.counts()[place], role
                shard = (keys % np.uint64(shards)).astype(np.int64)
                order = np.lexsort((made["key"], shard))
                made, shard = made[order], shard[order]
                new = np.concatenate([[True], (shard[1:] != shard[:-1]) | (made["key"][1:] != made["key"][:-1])])
                begins = np.flatnonzero(new)
                sizes = np.diff(np.append(begins, len(made)))
                out: list[tuple[int, int, bytes]] = []
                if (sizes > LOCAL_MANY).any():  # a mark goes to the key's shard, the entries to any
                    for s, n in zip(begins[sizes > LOCAL_MANY].tolist(), sizes[sizes > LOCAL_MANY].tolist(), strict=True):
                        dealt += 1
                        out.append((int(mix(made["line"][s : s + 1] + np.uint64(dealt))[0] % np.uint64(shards)), int(shard[s]), made[s : s + n].tobytes()))
                    marks = made[begins[sizes > LOCAL_MANY]]
                    marks["line"], marks["role"] = _MARK, 255
                    few = np.repeat(sizes <= LOCAL_MANY, sizes)
                    made, shard = np.concatenate([made[few], marks]), np.concatenate([shard[few], shard[begins[sizes > LOCAL_MANY]]])
                    order = np.argsort(shard, kind="stable")
                    made, shard = made[order], shard[order]
                some, begins = np.unique(shard, return_index=True)
                out += [(int(k), -1, made[s:e].tobytes()) for k, s, e in zip(some, begins, np.append(begins[1:], len(made)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["shard", "home", "piece"])

    def rows(k, seg, a, b, sign, role) -> pa.RecordBatch:
        n = len(a)
        column = lambda x, t: pa.nulls(n, t) if x is None else pa.array(x, t)
        return pa.RecordBatch.from_arrays([column(x, t) for x, t in zip((k, seg, a, b, sign, role), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=names)

    def entries(made: np.ndarray, home: int) -> pa.RecordBatch:
        key = made["key"].astype(np.int64)
        return rows(key * shards + home, (key & 31).astype(np.int32), made["line"].astype(np.int64), None, made["sign"].astype(np.int64), made["role"].astype(np.int32))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for shard, home, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                made = np.frombuffer(piece, _ENTRY)
                if home >= 0:
                    yield entries(made, home)
                else:
                    held.setdefault(shard, []).append(made)
        for shard in sorted(held):
            made = np.concatenate(held.pop(shard))
            made = made[np.lexsort((made["line"], made["role"], made["key"]))]
            fresh = np.ones(len(made), bool)
            fresh[1:] = made[1:] != made[:-1]
            made = made[fresh]
            line, role, sign = made["line"], made["role"], made["sign"]
            begins = np.flatnonzero(np.concatenate([[True], made["key"][1:] != made["key"][:-1]]))
            ends = np.append(begins[1:], len(made))
            plain = np.add.reduceat((role == 0).astype(np.int64), begins)
            marked = role[ends - 1] == 255
            few = ~marked & (plain > 0) & (ends - begins > 1) & (plain * (ends - begins) <= OWN_PAIRS)
            pairs = [np.zeros((2, 0), np.int64)]
            for s, e, n in zip(begins[few].tolist(), ends[few].tolist(), plain[few].tolist(), strict=True):
                x, y = np.repeat(np.arange(s, s + n), e - s), np.tile(np.arange(s, e), n)
                near = _possible(line, role, sign, x, y, edits)
                pairs.append(np.stack([x[near], y[near]]))
            x, y = np.concatenate(pairs, axis=1)
            yield rows(None, (made["key"][x] & np.uint32(31)).astype(np.int32), line[x].astype(np.int64), line[y].astype(np.int64), None, None)
            many = np.repeat(marked | (plain * (ends - begins) > OWN_PAIRS), ends - begins) & (role != 255)
            if many.any():
                yield entries(made[many], shard)

    pieces = lines.select("lid", "body").mapInArrow(make, "shard int, home int, piece binary").repartitionById(shards, "shard")
    return pieces.mapInArrow(meet, "k long, seg int, a long, b long, sign long, role int")


def bodies(lids: DataFrame, lines: DataFrame, path: str) -> DataFrame:
    """(lid, body) of the lines numbered in lids (one column, lid)."""
    need = stored(lids.distinct(), f"{path}-need")
    return stored(lines.select("lid", "body").join(F.broadcast(need) if need.count() <= BROADCAST_IDS else need, "lid"), f"{path}-bodies")


def _close(xs: list[str], ys: list[str], segs: list[int] | None, edits: int) -> np.ndarray:
    """Whether each pair is within the edits and, where segs is given, first shares that segment."""
    out = np.zeros(len(xs), bool)
    some = [k for k in range(len(xs)) if segs is None or first_shared(xs[k], ys[k], edits + 1) == segs[k]]
    at = np.concatenate([[0], np.cumsum([4 * len(ys[k]) for k in some])]).astype(np.int64)
    points = lambda t: np.frombuffer(t.encode("utf-32-le"), np.uint32)
    for i, j in slices(at):
        part = some[i:j]
        out[part] = edit_distances([points(xs[k]) for k in part], [points(ys[k]) for k in part], edits) <= edits
    return out


def verified(pairs: DataFrame, lines: DataFrame, edits: int, path: str) -> DataFrame:
    """(a, b) of the pairs (seg, a, b) that are within `edits` edits, each pair under one segment only; with seg null under any."""
    found = bodies(pairs.select(F.explode(F.array("a", "b")).alias("lid")), lines, path)
    both = pairs.join(found.select(F.col("lid").alias("a"), F.col("body").alias("x")), "a").join(found.select(F.col("lid").alias("b"), F.col("body").alias("y")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            x, y = ([t.decode() for t in b.column(c).to_pylist()] for c in ("x", "y"))
            segs = b.column("seg").to_pylist()
            keep = pa.array(_close(x, y, None if segs and segs[0] is None else segs, edits))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return both.select("seg", "a", "b", "x", "y").mapInArrow(check, "a long, b long")


def in_blocks(entries: DataFrame, lines: DataFrame, edits: int, count: bool, path: str) -> DataFrame:
    """For the entries (k, seg, a, sign, role, root) of keys with many lines: links (a, b) that join components, and with
    `count` rows (a, null, n) of how many links a line has in a task.

    A key's lines are dealt into blocks of bounded lines and bytes, and every two blocks meet in one task. Without `count`
    pairs of one component are passed over.
    """
    found = bodies(entries.select(F.col("a").alias("lid")), lines, path)
    members = entries.join(found, F.col("a") == F.col("lid"))
    sizes = members.groupBy("k").agg(F.greatest(F.count("*") / BLOCK_LINES, F.sum(F.length("body")) / BLOCK_BYTES).cast("int").alias("last"), F.min("role").alias("least"))
    dealt = members.join(sizes.where("least = 0").select("k", "last"), "k").withColumn("at", F.pmod(F.xxhash64("a"), F.col("last") + 1).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    dealt = dealt.select("k", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "at", "seg", "a", "sign", "role", "root", "body")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["a", "role"]).sort_values(["role", "a"], ignore_index=True)
        line, role, sign, at, root = (part[c].to_numpy() for c in ("a", "role", "sign", "at", "root"))
        sign, text, seg = sign.astype(np.uint32), [t.decode() for t in part["body"]], int(part["seg"].iat[0])
        across = part["i"].iat[0] != part["j"].iat[0]
        parent = {r: r for r in root.tolist()}
        links, degree = [], np.zeros(len(part), np.int64)

        def find(r: int) -> int:
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        pairs: list[tuple[int, int]] = []

        def verify() -> None:
            xs, ys = [text[x] for x, _ in pairs], [text[y] for _, y in pairs]
            for k in np.flatnonzero(_close(xs, ys, [seg] * len(pairs) if count else None, edits)).tolist():
                x, y = pairs[k]
                degree[x] += 1
                degree[y] += 1
                r, q = find(int(root[x])), find(int(root[y]))
                if r != q:
                    parent[max(r, q)] = min(r, q)
                    links.append((int(line[x]), int(line[y]), 0))
            pairs.clear()

        for x in range(int((role == 0).sum())):
            near = _possible(line, role, sign, np.full(len(part), x), np.arange(len(part)), edits)
            if across:
                near &= at != at[x]
            ys = np.flatnonzero(near)
            if not count:
                mine = find(int(root[x]))
                ys = np.array([y for y in ys.tolist() if find(int(root[y])) != mine], np.int64)
            pairs += [(x, y) for y in ys.tolist()]
            if len(pairs) >= (PAIRS_AT_ONCE if count else 1):
                verify()
        verify()
        if count:
            links += [(int(line[k]), None, int(degree[k])) for k in np.flatnonzero(degree)]
        return pd.DataFrame({"a": pd.array([x[0] for x in links], "Int64"), "b": pd.array([x[1] for x in links], "Int64"), "n": pd.array([x[2] for x in links], "Int64")})

    # Dealt by key alone, as the join leaves them, all blocks of a key would be one task's.
    return dealt.repartition("k", "i", "j").groupBy("k", "i", "j").applyInPandas(compare, "a long, b long, n long")


def linked(lines: DataFrame, edits: int, count: bool, path: str) -> tuple[DataFrame, DataFrame | None]:
    """(id, root) of the lines that links join, and with `count` (lid, n_links) of those that have links."""
    met = stored(candidates(lines, edits), f"{path}/met")
    links = stored(verified(met.where("k IS NULL").select("seg", "a", "b"), lines, edits, f"{path}/few"), f"{path}/links")
    degree = links.select(F.explode(F.array("a", "b")).alias("lid"), F.lit(1).cast("long").alias("n")) if count else None
    joined, roots = links, components(links, f"{path}/components")
    many = met.where("k IS NOT NULL").select("k", "seg", "a", "sign", "role")
    if many.isEmpty():
        return roots, degree.groupBy("lid").agg(F.sum("n").alias("n_links")) if count else None

    def rooted() -> DataFrame:
        return many.join(roots, F.col("a") == F.col("id"), "left").select("k", "seg", "a", "sign", "role", F.coalesce("root", "a").alias("root"))

    for k in range(0 if count else STAR_ROUNDS):  # each line with one line of its key
        now, least = stored(rooted(), f"{path}/star{k}"), F.min if k % 2 == 0 else F.max
        reps = now.groupBy("k").agg(least(F.when(F.col("role") == 0, F.struct("a", "root"))).alias("rep"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high AND rep IS NOT NULL")
        star = now.join(reps.select("k", "rep"), "k").where("root <> rep.root").select(F.lit(None).cast("int").alias("seg"), F.col("rep.a").alias("a"), F.col("a").alias("b")).distinct()
        joined = joined.unionByName(stored(verified(stored(star, f"{path}/star{k}-pairs"), lines, edits, f"{path}/star{k}"), f"{path}/star{k}-links"))
        roots = components(joined, f"{path}/star{k}-components")
    now = rooted()
    if not count:
        mixed = now.groupBy("k").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("k")
        now = now.join(mixed, "k")
    dense = stored(in_blocks(stored(now, f"{path}/dense"), lines, edits, count, f"{path}/dense"), f"{path}/dense-links")
    joined = joined.unionByName(dense.where("b IS NOT NULL").select("a", "b"))
    roots = components(joined, f"{path}/dense-components")
    if count:
        degree = degree.unionByName(dense.where("b IS NULL").select(F.col("a").alias("lid"), "n")).groupBy("lid").agg(F.sum("n").alias("n_links"))
    return roots, degree


def _classes(docs: DataFrame, id_col: str, text_col: str, edits: int, least: int, count: bool) -> DataFrame:
    """line_classes() and the lines' code points; n_links is null without `count`."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = shared_dir(spark)
    linked_from = max(least, CHARS_PER_EDIT * edits, 1)
    slim = _slim(docs, id_col, text_col)
    lines = distinct_lines(slim, least, linked_from, f"{path}/distinct", CODEC if count else "snappy")  # a removal runs beside other stages' heaps
    roots, degree = linked(lines.where("body IS NOT NULL").select("lid", "body"), edits, count, path)
    some = lines.select("lid", "h", "first").join(roots.withColumnRenamed("id", "lid"), "lid")
    some = some.join(degree, "lid", "left") if count else some.withColumn("n_links", F.lit(None).cast("long"))
    some = stored(some, f"{path}/linked")
    best = some.groupBy("root").agg(F.min("first").alias("best"))
    some = some.join(best, "root").select("h", "best", F.coalesce("n_links", F.lit(0) if count else F.lit(None)).cast("long").alias("n_links"))
    # Lines that occur once and have no link are their own class.
    known = lines.where("n > 1").select("h", "first").join(some, "h", "full").select("h", F.coalesce("best", "first").alias("first"), "n_links")
    known = stored(known, f"{path}/known")
    remove_but(spark, path, "known")
    out = lines_of(slim, least).join(known, "h", "left")
    out = out.withColumn("first", F.coalesce("first", F.struct("id", "copy", "line")))
    kept = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("copy") == F.col("first.copy")) & (F.col("line") == F.col("first.line"))
    return out.select(F.col("id").alias(id_col), "copy", "line", F.col("first.id").alias("class_id"), F.col("first.line").alias("class_line"), F.coalesce("n_links", F.lit(0)).alias("n_links"), kept.alias("kept"), "chars")


def line_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """Per line of at least `least` code points, 1 for every line that is not empty: id_col, copy, line, class_id,
    class_line, n_links, kept.

    line counts from 0 between line breaks. Lines that links of up to `edits` edits reach are a class, named by its first
    line (smallest id, then copy, then line), the only one kept; n_links is the number of different lines linked with
    it. Lines of fewer than CHARS_PER_EDIT code points for each edit are a class only with their equals. copy is a hash of
    the text: rows with one id and different texts are told apart, equal rows count as one. A null id sorts first. Null and
    empty texts and an empty table have no lines; only the id and the text are read, so other columns cannot clash.
    """
    return _classes(docs, id_col, text_col, edits, least, True).drop("chars")


def without_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with all its columns, each text without the lines of at least min_chars code points that its class keeps
    elsewhere; shorter lines are in classes too.

    Rows whose text loses every line that has a word go; rows that had none stay as they are. Equal rows of one id count
    as one and lose the same lines. A column n_chars becomes the new text's length in code points. Null ids, null and empty
    texts and an empty table are as in line_classes(); other columns pass through whatever their names.
    """
    drop = _classes(docs, id_col, text_col, edits, 1, False).where(~F.col("kept") & (F.col("chars") >= min_chars)).groupBy(F.col(id_col).alias("__id"), F.col("copy").alias("__copy")).agg(F.collect_set("line").alias("__lines"))
    joined = docs.join(drop, docs[id_col].eqNullSafe(drop["__id"]) & (F.xxhash64(docs[text_col].cast("string")) == drop["__copy"]), "left")

    @F.pandas_udf("string")
    def left_of(text: pd.Series, lines: pd.Series) -> pd.Series:
        def one(t: str | None, gone) -> str | None:
            if t is None or gone is None:
                return t
            gone = set(gone)
            return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)

        return pd.Series([one(t, g) for t, g in zip(text, lines, strict=True)], dtype=object)

    # Else the filter would run it again, in further workers.
    text = F.when(F.col("__lines").isNull(), F.col(text_col)).otherwise(left_of.asNondeterministic()(F.col(text_col).cast("string"), F.col("__lines")))
    new = joined.withColumn(text_col, text).where(F.col("__lines").isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("__lines").isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType))
    return new.select(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), least=1).drop("copy")


#: One-byte letters for the letters of a pair of lines: the edit distance there counts bytes.
_LETTERS = "".join(map(chr, range(35, 127))).replace("'", "")
OP1_SQL = rf"""
WITH RECURSIVE t AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(range(0, len(l)))::INT AS line, unnest(l) AS x FROM t),
a AS (SELECT doc_id, line, x FROM u WHERE x <> ''),
f AS (SELECT x, length(x) AS n, min(ROW(doc_id, line)) AS first, row_number() OVER (ORDER BY x) AS k, list_transform(range(0, 8), lambda c: len(list_filter(string_split(x, ''), lambda y: unicode(y) % 8 = c))) AS v FROM a GROUP BY x),
p AS (SELECT f.k AS a, g.k AS b, f.x, g.x AS y, list_distinct(string_split(f.x || g.x, '')) AS cs FROM f JOIN f g ON f.k < g.k AND f.n >= 10 AND g.n >= 10 AND abs(f.n - g.n) <= 2
  WHERE abs(f.v[1] - g.v[1]) + abs(f.v[2] - g.v[2]) + abs(f.v[3] - g.v[3]) + abs(f.v[4] - g.v[4]) + abs(f.v[5] - g.v[5]) + abs(f.v[6] - g.v[6]) + abs(f.v[7] - g.v[7]) + abs(f.v[8] - g.v[8]) <= 4),
e AS (SELECT a, b FROM p WHERE levenshtein(translate(x, array_to_string(cs, ''), substr('{_LETTERS}', 1, len(cs))), translate(y, array_to_string(cs, ''), substr('{_LETTERS}', 1, len(cs)))) <= 2),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(k, root) AS (SELECT k, k FROM f UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.k),
m AS (SELECT k, min(root) AS root FROM r GROUP BY k),
c AS (SELECT root, min(first) AS first FROM m JOIN f USING (k) GROUP BY root),
n AS (SELECT a AS k, count(*) AS n FROM l GROUP BY a)
SELECT doc_id, line, c.first[1] AS class_id, c.first[2] AS class_line, coalesce(n.n, 0)::BIGINT AS n_links, ROW(doc_id, line) = c.first AS kept
FROM a JOIN f USING (x) JOIN m USING (k) JOIN c USING (root) LEFT JOIN n USING (k)
"""
