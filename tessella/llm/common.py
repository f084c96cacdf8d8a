"""What the text operators share: storage, word arrays over Arrow batches, connected components."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass handles; a longer single text is a pass of its own.
SLICE_BYTES = 1 << 20

#: Bytes of an Arrow batch, checked as rows are added; the default bounds rows alone, whatever their length.
BATCH_BYTES = 4 << 20

#: Session setting: seconds after which stored() relieves the executors again; unset: never.
RELIEF_KEY = "tessella.relief.seconds"
_relieved = 0.0

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}
_PRIME = (1 << 31) - 1
_residues: list[np.ndarray] = []


# ---------------------------------------------------------------- storage


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors see; a temporary one only where that is unset and all
    runs on one machine."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", top)
        spark.sparkContext.setCheckpointDir(top)
    return f"{top.rstrip('/')}/tessella-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, codec: str = "snappy") -> DataFrame:
    """df written as Parquet and read again: lineage ends in files that every executor sees."""
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    every = df.sparkSession.conf.get(RELIEF_KEY, None)
    if every is not None and time.monotonic() - _relieved >= float(every):
        relieve(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart: the id, which may be null or repeated, and a hash of the text. A join on it keeps null ids."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("copy"))


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, so that long texts do not add up, unless the session sets a bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def remove_but(spark: SparkSession, path: str, *names: str) -> None:
    """Remove a folder's members but for the names: the tables that nothing needs any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in fs.listStatus(at):
        if s.getPath().getName() not in names:
            fs.delete(s.getPath(), True)


def forget(spark: SparkSession) -> None:
    """Let go of the plans of queries that are done, which Python's cycles hold in the driver's JVM, and of their shuffle files:
    many queries in a row would grow its heap to the limit, and it gives memory back only when it is collected as a whole."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def relieve(spark: SparkSession) -> None:
    """Have the executors collect their heaps as a whole, one task a core: a heap that many queries in a row have grown to its
    limit is given back only then, and Python workers need room beside it."""
    global _relieved
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')").alias("x")).write.format("noop").mode("overwrite").save()
    _relieved = time.monotonic()


def local_path(path: str) -> str:
    """The path that a process opens for a shared folder; only mounted folders can be memory-mapped."""
    if "://" not in path and not path.startswith("file:"):
        return path
    if path.startswith("file:"):
        return "/" + path[len("file:") :].lstrip("/")
    raise ValueError(f"memory-mapped arrays need a mounted spark.checkpoint.dir, not {path}")


# ---------------------------------------------------------------- tables of a worker

_tables: dict[tuple[str, str], object] = {}
_last: str | None = None


def release(kind: str | None = None) -> None:
    """Drop the tables that other operators left in this process, and give freed memory back: workers are used again by
    later stages, beside a heap that leaves them little."""
    global _last
    if kind is not None and kind == _last:
        return
    for key in [k for k in _tables if k[0] != kind]:
        del _tables[key]
    _powers.clear()
    _residues.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    _last = kind


def table(kind: str, key: str, make: Callable[[str], object]) -> object:
    """make(key), once for each process while no other operator runs in it."""
    release(kind)
    if (kind, key) not in _tables:
        _tables[kind, key] = make(key)
        gc.collect()  # what making it took
    return _tables[kind, key]


# ---------------------------------------------------------------- word arrays


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base and its inverse modulo 2^64, to the powers 0 to n."""
    if _powers.get(0) is None or len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def residues(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Another hash base and its inverse modulo a prime below 2^31, to the powers 0 to n."""
    if not _residues or len(_residues[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        _residues.clear()
        for base in (1_234_567_891, pow(1_234_567_891, -1, _PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), _PRIME)) % np.uint64(_PRIME)])
            _residues.append(p[:size])
    return _residues[0], _residues[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (len + 1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of anything but ASCII white space, A-Z lower-cased) and each row's number of them.

    A polynomial modulo 2^64 alone has known texts that collide at any base; one modulo a prime is mixed in.
    """
    buf = data[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]
    if not len(buf):
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    white = _WHITE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[at] = True
    first, last = ~white, ~white
    first[1:] &= white[:-1] | edge[1:-1]
    last[:-1] &= white[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    p, q = powers(len(buf))
    letters = (_LOWER[buf] if lower else buf).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(letters * p[: len(buf)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * q[starts]
    p, q = residues(len(buf))
    letters *= p[: len(buf)]
    if len(buf) >= 1 << 24:  # else sums stay below 2^64
        letters %= np.uint64(_PRIME)
    np.cumsum(letters, out=sums[1:])
    prime = np.uint64(_PRIME)
    return mix(hashes ^ mix((sums[ends] - sums[starts]) % prime * q[starts] % prime + np.uint64(1))), np.diff(np.searchsorted(starts, at))


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's windows of `width` words (the whole row if it has fewer) and their number by row."""
    ends = np.cumsum(counts)
    begins = ends - counts
    number = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    n = int(number.sum())
    where = np.repeat(begins - (np.cumsum(number) - number), number) + np.arange(n)
    stop = np.repeat(ends, number)
    out = np.zeros(n, np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for k in range(width):
        word = np.where(where + k < stop, padded[where + k], np.uint64(0))
        out = mix(out * _BASE + word + np.uint64(k + 1))
    return out, number


def distinct_sets(values: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values, sorted and without repeats, and how many are left."""
    row = np.repeat(np.arange(len(number)), number)
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[keep], np.bincount(row[keep], minlength=len(number))


# ---------------------------------------------------------------- connected components


#: Links whose components one task finds, by count: it holds two numbers for each.
ONE_TASK_LINKS = 1 << 18


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, root) of all ids in the links (a, b) of one task."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a), parent.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    ids = list(parent)
    for k in range(0, len(ids), 10_000):
        some = ids[k : k + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([find(x) for x in some], pa.int64())], names=["id", "root"])


def components(edges: DataFrame, path: str, rounds: int = 60) -> DataFrame:
    """(id, root) for every id in edges (a, b), two longs: root is the smallest id that links reach.

    Up to ONE_TASK_LINKS different links one task unites; beyond it large-star and small-star steps alternate, each round
    is written to the shared folder and the number of rounds grows with the logarithm of the longest path. Only counts
    come to the driver. Rows with a null end or a = b link nothing. A hub's links are never gathered in one task: a step
    is a minimum for each id (summed before the shuffle) and a join that adaptive execution can split.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{path}/cc0")
    if now.count() <= ONE_TASK_LINKS:
        return stored(now.coalesce(1).mapInArrow(_united, "id long, root long"), f"{path}/cc")
    before = None
    for k in range(1, rounds + 1):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        after = stored(small, f"{path}/cc{k}")
        mark = after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if before == mark:
            return after.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(after.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
        now, before = after, mark
    raise RuntimeError("components did not settle")
