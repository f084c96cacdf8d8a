"""An interpolated modified Kneser-Ney bigram model, counted in Spark and scored from memory-mapped arrays.

Counting: each task counts the words (then the word pairs) of its documents in numpy and sends one sorted, packed piece
to each shard; a shard adds its pieces up and writes its sorted keys and counts as plain arrays into the shared folder,
under a final name only when complete, so a repeated task overwrites nothing half done. Words are sharded by the top
bits of their hash, so the shards in order are one sorted hash array and a word's place in it is its number. Pairs are
keyed by both numbers and sharded by a hash of the pair, so a frequent word's pairs spread over all shards. What
discounting needs of each word (how often it is a history, with how many different successors of count 1, 2, 3 or more,
and how many different words precede it) is added up the same way, sharded by ranges of word numbers.
Scoring: workers map the arrays, a bounded number of files at a time, and look a batch's distinct words and pairs up by
binary search.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import local_path, mix, remove, shared_dir, slices, string_buffers, words

#: Text bytes that a task counts before it sends pieces on.
COUNT_BYTES = 16 << 20
SCORE_BYTES = 4 << 20
#: Shards for each partition of the input: a shard's arrays stay a few megabytes at any size of the input.
SHARDS_PER_PARTITION = 6
#: Files that a process maps at once; the one that was looked at longest ago goes.
HELD_MAPS = 2048
#: A pair's key holds two numbers of words of 32 bits each.
MOST_WORDS = 1 << 32
#: Counts up to this one are stored in 32 bits; larger ones in a list beside them.
_LARGE = np.uint64((1 << 32) - 1)
_END = np.uint64(0x5D1A7E5E9D0F3B21)
_ONE = np.uint64(1)


# ---------------------------------------------------------------- pieces and files


def _planes(values: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane without the empty upper planes, so that a block compressor sees them."""
    top = int(values.max()) if len(values) else 0
    size = max(1, (top.bit_length() + 7) // 8)
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size]
    return struct.pack("<BQ", size, len(values)) + np.ascontiguousarray(raw.T).tobytes()


def _unplanes(data: memoryview, at: int) -> tuple[np.ndarray, int]:
    size, n = struct.unpack_from("<BQ", data, at)
    at += 9
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T
    return out.view("<u8").ravel(), at + n * size


def _piece(keys: np.ndarray, columns: list[np.ndarray]) -> bytes:
    return b"".join(_planes(x) for x in (np.diff(keys, prepend=np.uint64(0)), *columns))


def _unpiece(data: bytes, columns: int) -> list[np.ndarray]:
    view, at, out = memoryview(data), 0, []
    for k in range(columns + 1):
        x, at = _unplanes(view, at)
        out.append(np.cumsum(x, dtype=np.uint64) if k == 0 else x)
    return out


def _added_up(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], [np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns]


def _save(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Arrays as one file that appears under its name only when complete."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).tobytes())
    os.replace(part, f"{folder}/{name}")


def pair_arrays(keys: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """What a file of pairs holds: the number of keys and of large counts, keys, large counts' places and values, counts."""
    large = np.flatnonzero(counts >= _LARGE)
    return [np.array([len(keys), len(large)], "<u8"), keys.astype("<u8"), large.astype("<u8"), counts[large].astype("<u8"), np.minimum(counts, _LARGE).astype("<u4")]


class Pairs:
    """A mapped file of pairs."""

    def __init__(self, raw: np.ndarray):
        n, m = raw[:16].view("<u8").tolist() if len(raw) else (0, 0)
        at = np.cumsum([16, 8 * n, 8 * m, 8 * m]).tolist()
        self.keys, self.place, self.large = (raw[s:e].view("<u8") for s, e in zip(at, at[1:], strict=False))
        self.counts = raw[at[-1] : at[-1] + 4 * n].view("<u4")

    def count(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        if len(self.keys):
            where = np.searchsorted(self.keys, keys)
            where[where == len(self.keys)] = 0
            found = self.keys[where] == keys
            out[found] = self.counts[where[found]]
            for k in np.flatnonzero(out == int(_LARGE)):
                out[k] = self.large[np.searchsorted(self.place, where[k])]
        return out


class _Maps:
    """Files of a folder as arrays of bytes, a bounded number mapped at a time; an absent file is empty."""

    def __init__(self, folder: str):
        self.folder, self.held = folder, OrderedDict()

    def get(self, name: str) -> np.ndarray:
        got = self.held.get(name)
        if got is None:
            path = f"{self.folder}/{name}"
            got = self.held[name] = np.memmap(path, np.uint8, "r") if os.path.exists(path) and os.path.getsize(path) else np.zeros(0, np.uint8)
            if len(self.held) > HELD_MAPS:
                self.held.popitem(last=False)
        else:
            self.held.move_to_end(name)
        return got


def _sharded(batches: Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    """(shard, key, columns) sets, sorted by shard and key, as one row for each shard."""
    for shard, keys, columns in batches:
        at = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else np.zeros(1, np.int64)
        rows = [(int(shard[s]), _piece(keys[s:e], [c[s:e] for c in columns])) for s, e in zip(at[:-1], at[1:], strict=True)]
        for k in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[k : k + 256]], pa.int32()), pa.array([r[1] for r in rows[k : k + 256]], pa.binary())], names=["shard", "piece"])


def _by_shard(pieces: DataFrame, shards: int, columns: int, finish, schema: str) -> DataFrame:
    """finish(shard, keys, columns) for every shard that got pieces, with its keys distinct, sorted and added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[list[np.ndarray]]] = {}
        for b in batches:
            for shard, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                mine = held.setdefault(shard, [])
                mine.append(_unpiece(piece, columns))
                if len(mine) >= 24:
                    keys, sums = _added_up(np.concatenate([m[0] for m in mine]), [np.concatenate([m[k + 1] for m in mine]) for k in range(columns)])
                    mine[:] = [[keys, *sums]]
        for shard, mine in sorted(held.items()):
            yield from finish(shard, *_added_up(np.concatenate([m[0] for m in mine]), [np.concatenate([m[k + 1] for m in mine]) for k in range(columns)]))

    return pieces.repartitionById(shards, "shard").mapInArrow(run, schema)


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    folder: str  # files words/, pairs/ and stats/ by shard, and starts, the first word's number of each shard
    shards: int
    size: int  # different words
    total: int
    discounts: list[float]  # of pair counts 1, 2, 3 and more
    lower_discounts: list[float]  # of the number of preceding words
    lower_total: int
    lower_kept: float  # what discounting the unigrams leaves for all words alike


class _Lookup:
    """The mapped arrays of a model, in one process."""

    def __init__(self, model: Model):
        self.model, self.shards = model, model.shards
        self.starts = np.fromfile(f"{model.folder}/starts", "<i8")
        self.bits = np.uint64(64 - self.shards.bit_length() + 1)
        self.maps = _Maps(model.folder)

    def word_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        at = np.searchsorted(hashes >> self.bits, np.arange(self.shards + 1, dtype=np.uint64))
        for k in np.flatnonzero(np.diff(at)):
            keys, c = self.maps.get(f"words/{k}").view("<u8").reshape(2, -1)
            some = hashes[at[k] : at[k + 1]]
            where = np.searchsorted(keys, some)
            where[where == len(keys)] = 0
            found = keys[where] == some if len(keys) else np.zeros(len(some), bool)
            ids[at[k] : at[k + 1]][found] = where[found] + self.starts[k]
            counts[at[k] : at[k + 1]][found] = c[where[found]]
        return ids, counts

    def stats(self, ids: np.ndarray) -> np.ndarray:
        """Rows of (total as history, successors of count 1, 2, 3+, preceding words) for sorted word numbers."""
        out = np.zeros((len(ids), 5), np.int64)
        at = np.searchsorted(ids, self.starts)
        for k in np.flatnonzero(np.diff(at)):
            some = ids[at[k] : at[k + 1]] - self.starts[k]
            table = self.maps.get(f"stats/{k}").view("<i8").reshape(-1, 5)
            if len(table):  # a shard whose words are in no pair has no file
                out[at[k] : at[k + 1]] = table[some]
        return out

    def pair_count(self, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct pair keys, in any order."""
        shards = self.shards
        shard = pair_shard(keys, shards)
        order = np.lexsort((keys, shard))
        out = np.zeros(len(keys), np.int64)
        at = np.searchsorted(shard[order], np.arange(shards + 1))
        for k in np.flatnonzero(np.diff(at)):
            some = order[at[k] : at[k + 1]]
            out[some] = Pairs(self.maps.get(f"pairs/{k}")).count(keys[some])
        return out


def pair_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) % np.uint64(shards)).astype(np.int64)


_lookups: dict[str, _Lookup] = {}


def lookup(model: Model) -> _Lookup:
    if model.folder not in _lookups or _lookups[model.folder].model != model:  # a reused worker may hold an unfinished one
        _lookups.clear()
        _lookups[model.folder] = _Lookup(model)
    return _lookups[model.folder]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each row, each row closed by an end token, and the rows' number of tokens."""
    hashes, counts = words(data, offsets)
    hashes[hashes == _END] ^= _ONE
    return np.insert(hashes, np.cumsum(counts), _END), counts + 1


def discounts_of(counts: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3+ from how many n-grams have the counts 1 to 4."""
    n1, n2, n3, n4 = counts
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]  # too few n-grams to estimate
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return [min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d, strict=True)]


def fit(texts: DataFrame, *, text_col: str = "text", folder: str | None = None) -> Model:
    """Count all rows of texts. A null or empty text is one end token.

    folder is a place in spark.checkpoint.dir, by default a fresh one; it must be mounted on all machines, as the arrays
    are memory-mapped. The driver gets one short row for each shard. Pairs do not cross documents; the first word of a
    text follows an end token.
    """
    spark = texts.sparkSession
    slim = texts.select(F.col(text_col).cast("string").alias("text"))
    folder = local_path(folder or f"{shared_dir(spark)}/model")
    parts = slim._jdf.queryExecution().toRdd().getNumPartitions()
    shards = 1 << max(5, (SHARDS_PER_PARTITION * max(1, parts) - 1).bit_length())
    bits = np.uint64(64 - shards.bit_length() + 1)

    def batched(batches: Iterator[pa.RecordBatch], count) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """count(data, offsets) -> keys, summed over about COUNT_BYTES of text."""
        held, size = [], 0
        for b in batches:
            data, at = string_buffers(b.column(0))
            for i, j in slices(at):
                keys, n = np.unique(count(data, at[i : j + 1]), return_counts=True)
                held.append((keys, n.astype(np.uint64)))
                size += int(at[j] - at[i])
                if size >= COUNT_BYTES:
                    yield _added_up(np.concatenate([h[0] for h in held]), [np.concatenate([h[1] for h in held])])
                    held, size = [], 0
        if held:
            yield _added_up(np.concatenate([h[0] for h in held]), [np.concatenate([h[1] for h in held])])

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sharded(((keys >> bits).astype(np.int64), keys, c) for keys, c in batched(batches, lambda d, o: tokens(d, o)[0]))

    def write_words(shard: int, keys: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _save(f"{folder}/words", str(shard), [keys.astype("<u8"), columns[0].astype("<u8")])
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([int(columns[0].sum())], pa.int64())], names=["shard", "n", "total"])

    got = _by_shard(slim.mapInArrow(count_words, "shard int, piece binary"), shards, 1, write_words, "shard int, n long, total long").collect()
    word_counts, total = [0] * shards, 0
    for r in got:
        word_counts[r[0]], total = r[1], total + r[2]
    if sum(word_counts) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} different words")
    starts = np.concatenate([[0], np.cumsum(word_counts)]).astype("<i8")
    _save(folder, "starts", [starts])
    model = Model(folder, shards, int(starts[-1]), total, [], [], 0, 0.0)
    del word_counts, got, starts  # tasks read them from the folder

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = lookup(model)

        def keys(d: np.ndarray, o: np.ndarray) -> np.ndarray:
            return pair_keys(words_of, *tokens(d, o))[0]

        def parts() -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
            for k, c in batched(batches, keys):
                shard = pair_shard(k, shards)
                order = np.argsort(shard, kind="stable")
                yield shard[order], k[order], [c[0][order]]

        return _sharded(parts())

    def write_pairs(shard: int, keys: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        c = columns[0]
        _save(f"{folder}/pairs", str(shard), pair_arrays(keys, c))
        counts = [int((c == k).sum()) for k in (1, 2, 3, 4)]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((shard, None, len(keys), *counts), (pa.int32(), pa.binary(), *[pa.int64()] * 5), strict=True)], names=names)
        left, right = (keys >> np.uint64(32)), keys & np.uint64(0xFFFFFFFF)
        zero = np.zeros(len(keys), np.uint64)
        ids, sums = _added_up(np.concatenate([left, right]), [np.concatenate(x) for x in ((c, zero), ((c == 1).astype(np.uint64), zero), ((c == 2).astype(np.uint64), zero), ((c > 2).astype(np.uint64), zero), (zero, zero + _ONE))])
        home = np.searchsorted(lookup(model).starts, ids.astype(np.int64), "right") - 1
        for b in _sharded(iter([(home, ids, sums)])):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.nulls(b.num_rows, pa.int64())] * 5], names=names)

    names = ["shard", "piece", "n", "n1", "n2", "n3", "n4"]
    counted = _by_shard(slim.mapInArrow(count_pairs, "shard int, piece binary"), shards, 1, write_pairs, "shard int, piece binary, n long, n1 long, n2 long, n3 long, n4 long")
    path = f"{folder}/history"
    counted.write.mode("overwrite").parquet("file://" + path)
    counted = spark.read.schema(counted.schema).parquet("file://" + path)
    counts = [x or 0 for x in counted.where("n IS NOT NULL").agg(*(F.sum(f"n{k}") for k in (1, 2, 3, 4))).first()]
    model.discounts = discounts_of(counts)

    def write_stats(shard: int, ids: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        starts = lookup(model).starts
        table = np.zeros((int(starts[shard + 1] - starts[shard]), 5), "<i8")
        table[ids.astype(np.int64) - starts[shard]] = np.stack(columns, axis=1)
        _save(f"{folder}/stats", str(shard), [table])
        before = table[:, 4]
        values = [shard, int(before.sum()), *(int((before == k).sum()) for k in (1, 2, 3, 4)), int((before > 2).sum())]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in values], names=["shard", "total", "n1", "n2", "n3", "n4", "more"])

    rows = _by_shard(counted.where("piece IS NOT NULL").select("shard", "piece"), shards, 5, write_stats, "shard long, total long, n1 long, n2 long, n3 long, n4 long, more long").agg(*(F.sum(c) for c in ("total", "n1", "n2", "n3", "n4", "more"))).first()
    remove(spark, "file://" + path)
    sums = [x or 0 for x in rows]
    model.lower_total, model.lower_discounts = sums[0], discounts_of(sums[1:5])
    d = model.lower_discounts
    model.lower_kept = (d[0] * sums[1] + d[1] * sums[2] + d[2] * sums[5]) / sums[0] if sums[0] else 1.0
    return model


def pair_keys(words_of: _Lookup, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of (word before, word) for each token (the end token stands before a row), and the tokens' distinct hashes'
    numbers, counts and places; a key with an unknown word is meaningless."""
    distinct, place = np.unique(hashes, return_inverse=True)
    ids, known = words_of.word_ids(distinct)
    mine = ids[place]
    before = np.empty_like(mine)
    before[1:] = mine[:-1]
    if len(mine):
        before[np.cumsum(counts) - counts] = words_of.word_ids(np.array([_END]))[0][0]
    return (before.astype(np.uint64) << np.uint64(32)) | (mine.astype(np.uint64) & np.uint64(0xFFFFFFFF)), mine, before, known[place]


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """Per row: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    base_score is the add-one unigram log10 probability, score the model's. A null or empty text is its end token.
    Repeated rows are scored one by one; only the id is carried over, so other columns cannot clash; an empty table gives
    an empty one. Without training tokens every word is as likely as every other.
    """
    slim = docs.select(F.col(id_col).alias("id"), (held_out if held_out is not None else F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def discounted(c: np.ndarray, d: list[float]) -> np.ndarray:
        return np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, size, total = lookup(model), model.size, model.total
        for b in batches:
            data, at = string_buffers(b.column("text"))
            for i, j in slices(at, SCORE_BYTES):
                hashes, counts = tokens(data, at[i : j + 1])
                keys, mine, before, known = pair_keys(arrays, hashes, counts)
                ids = np.unique(np.concatenate([mine, before]))
                stats = arrays.stats(ids[ids >= 0])
                stats = np.concatenate([np.zeros((len(ids) - len(stats), 5), np.int64), stats])
                lower = discounted(stats[:, 4], model.lower_discounts) / max(model.lower_total, 1) + model.lower_kept / (size + 1)
                d = model.discounts
                history = np.maximum(stats[:, 0], 1)
                back = np.where(stats[:, 0] > 0, (d[0] * stats[:, 1] + d[1] * stats[:, 2] + d[2] * stats[:, 3]) / history, 1.0)
                now, then = np.searchsorted(ids, mine), np.searchsorted(ids, before)
                chance = back[then] * lower[now]
                good = np.flatnonzero((mine >= 0) & (before >= 0))
                distinct, place = np.unique(keys[good], return_inverse=True)
                chance[good] += discounted(arrays.pair_count(distinct), d)[place] / history[then[good]]
                first = np.cumsum(counts) - counts
                base = np.add.reduceat(np.log10((known + 1.0) / (total + size + 1.0)), first)
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i), b.column("held_out").slice(i, j - i), pa.array(counts), pa.array(np.add.reduceat((known > 0).astype(np.int64), first)), pa.array(np.full(j - i, total, np.int64)), pa.array(base), pa.array(np.add.reduceat(np.log10(chance), first))], names=names)

    kinds = (slim.schema["id"].dataType, T.BooleanType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType())
    out = slim.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))).withColumnRenamed("id", id_col)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out_of = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(True))
    return score(docs, fit(docs.where(~out_of)), held_out=out_of)
