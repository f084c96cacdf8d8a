"""Token ids in a binary file format of patched frame-of-reference blocks.

A block is 128 ids: its minimum is subtracted, the differences are packed at the width that a percentile of them needs,
and those that are wider go to an exception list. An index of block starts lets any block be read alone. Blocks, the
index and the documents' lengths of a few hundred thousand ids make one record; records are rows of Parquet files, so
Spark's commit protocol decides what counts as written, whichever executors are lost.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_dir, slices, string_buffers, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK = 128
PERCENTILE = 90
#: A record is closed once it has this many ids; a single longer document is a record of its own.
RECORD_IDS = 1 << 18
#: Words, and bytes of words with what the table spends on each, that a worker remembers; beyond either the table starts
#: anew, so between slices memory is bounded, and within one by the slice's own words.
REMEMBERED = 1_000_000
REMEMBERED_BYTES = 160 << 20
WORD_BYTES = 140
_HEADER = struct.Struct("<4sIQ")
_MAGIC = b"PFB1"
#: The vocabulary's pre-split pattern over lower-case text below U+0180, classes written out, commonest first.
_L, _N, _S = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾", "\t-\r \u0085 "
_PIECES = re.compile(f"[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_N}]|[^{_S}{_L}{_N}]+")
_LIBRARY_ONLY = re.compile("[\x1c-\x1fİƀ-\U0010ffff]|<\\|")


# ---------------------------------------------------------------- blocks


def _widths(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """ids (below 2^32) as header, minima, widths, exception counts, block starts, packed bits, exceptions."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    x = np.zeros(blocks * BLOCK, np.uint32)
    x[:n] = ids
    if n % BLOCK:
        x[n:] = x[n - 1]
    x = x.reshape(blocks, BLOCK)
    low = x.min(axis=1) if blocks else np.zeros(0, np.uint32)
    x = x - low[:, None]
    need = _widths(x)
    width = np.partition(need, BLOCK * PERCENTILE // 100, axis=1)[:, BLOCK * PERCENTILE // 100] if blocks else np.zeros(0, np.uint8)
    odd = need > width[:, None]
    where = np.argwhere(odd)
    size = width.astype(np.int64) * (BLOCK // 8)
    starts = np.concatenate([[0], np.cumsum(size)]).astype(np.uint64)
    packed = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            kind = "<u2" if w <= 16 else "<u4"  # exceptions lose bits here, and are listed whole
            raw = x[rows].astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
            bits = np.unpackbits(raw, axis=1, bitorder="little")[:, : int(w)]
            body = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            packed[(starts[rows].astype(np.int64)[:, None] + np.arange(body.shape[1])).ravel()] = body.ravel()
    parts = (low.astype("<u4"), width, odd.sum(axis=1).astype(np.uint8), starts.astype("<u8"), packed, where[:, 1].astype(np.uint8), x[odd].astype("<u4"))
    return _HEADER.pack(_MAGIC, blocks, n) + b"".join(p.tobytes() for p in parts)


class Blocks:
    """A packed record, read in place."""

    def __init__(self, data: bytes):
        magic, blocks, self.n = _HEADER.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a record of packed ids")
        at = _HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.low, self.width, self.odd, self.starts = take("<u4", blocks), take("u1", blocks), take("u1", blocks), take("<u8", blocks + 1)
        self.packed = take("u1", int(self.starts[-1]) if blocks else 0)
        total = int(self.odd.sum(dtype=np.int64))
        self.odd_at, self.odd_value = take("u1", total), take("<u4", total)

    def read(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of blocks first to last (exclusive)."""
        last = len(self.low) if last is None else last
        width = self.width[first:last]
        out = np.zeros((last - first, BLOCK), np.uint32)
        for w in np.unique(width):
            if w:
                rows = np.flatnonzero(width == w)
                body = self.packed[self.starts[first + rows].astype(np.int64)[:, None] + np.arange(int(w) * BLOCK // 8)]
                kind = "<u2" if w <= 16 else "<u4"
                bits = np.zeros((len(rows) * BLOCK, 8 * np.dtype(kind).itemsize), np.uint8)
                bits[:, : int(w)] = np.unpackbits(body, axis=1, bitorder="little").reshape(-1, int(w))
                out[rows] = np.packbits(bits, axis=1, bitorder="little").view(kind).reshape(len(rows), BLOCK)
        skip = int(self.odd[:first].sum(dtype=np.int64))
        count = self.odd[first:last].astype(np.int64)
        row = np.repeat(np.arange(last - first), count)
        some = slice(skip, skip + int(count.sum()))
        out[row, self.odd_at[some]] = self.odd_value[some]
        out += self.low[first:last, None]
        return out.ravel()[: max(0, self.n - first * BLOCK)]


# ---------------------------------------------------------------- encoding


def _needs_library(text: str) -> bool:
    """_LIBRARY_ONLY.search(), by faster scans for the commonest texts."""
    if "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return True
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _LIBRARY_ONLY.search(text) is not None
    return False


class Encoder:
    """The library's encoding, with the ids of words remembered: its pre-split never joins what white space parts.

    Fresh words are encoded together, one space between two; each split piece ends in the only token of it that ends a
    word, which tells the words' ids apart. A text with a letter above U+017F, a control character that some count as
    white space or a special token's opening goes to the library as a whole, as its normalisation may join letters.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_piece[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.held = 0
        self.at: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _places(self, words: list[str]) -> np.ndarray:
        """The words' places in the table, which learns those that it lacks; if it begins anew for them, it learns all."""
        places = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        lacking = np.flatnonzero(places < 0)
        if not len(lacking):
            return places
        fresh = list({words[k] for k in lacking.tolist()})
        size = sum(map(len, fresh)) + WORD_BYTES * len(fresh)
        if self.at and (len(self.at) + len(fresh) > REMEMBERED or self.held + size > REMEMBERED_BYTES):
            self._reset()
            return self._places(words)
        self.held += size
        self._learn(fresh)
        places[lacking] = [self.at[words[k]] for k in lacking.tolist()]
        return places

    def _learn(self, fresh: list[str]) -> None:
        chunks = [fresh[k : k + 2000] for k in range(0, len(fresh), 2000)]
        got = np.concatenate([np.array(self.library.encode_batch_fast([" ".join(c)], add_special_tokens=False)[0].ids, np.uint32) for c in chunks])
        piece_ends = np.flatnonzero(self.ends_piece[got]) + 1
        # Letters alone are one piece.
        ends = self.ends[-1] + piece_ends[np.cumsum([1 if w.isalpha() else len(_PIECES.findall(w)) for w in fresh]) - 1]
        self.at.update(zip(fresh, range(len(self.at), len(self.at) + len(fresh)), strict=True))
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(int(ends[-1]), len(self.ids)), np.uint32)])
        self.ids[int(self.ends[-1]) : int(ends[-1])] = got
        self.ends = np.concatenate([self.ends, ends])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and the number for each."""
        whole = {k: t for k, t in enumerate(texts) if _needs_library(t)}
        split = [[] if k in whole else t.lower().split() for k, t in enumerate(texts)]
        flat = list(chain.from_iterable(split))
        known = self._places(flat)
        size = np.diff(self.ends)[known] if len(flat) else np.zeros(0, np.int64)
        last = np.cumsum(size)
        ids = self.ids[np.repeat(self.ends[known] - (last - size), size) + np.arange(int(last[-1]) if len(last) else 0)]
        ends = np.concatenate([[0], last])[np.cumsum([len(s) for s in split])] if split else np.zeros(0, np.int64)
        number = np.diff(np.concatenate([[0], ends])).astype(np.int64)
        if whole:
            parts = np.split(ids, ends[:-1])
            for k, e in zip(whole, self.library.encode_batch(list(whole.values()), add_special_tokens=False), strict=True):
                parts[k] = np.array(e.ids, np.uint32)
                number[k] = len(e.ids)
            ids = np.concatenate(parts)
        return ids, number


def encoder(path: str) -> Encoder:
    return table("token_file", path, Encoder)


# ---------------------------------------------------------------- files

RECORD = T.StructType([T.StructField(c, k) for c, k in (("shard", T.IntegerType()), ("record", T.IntegerType()), ("before", T.LongType()), ("n_ids", T.LongType()), ("first_id", T.LongType()), ("doc_ids", T.BinaryType()), ("lengths", T.BinaryType()), ("blocks", T.BinaryType()))])


def write(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int | None = END_ID) -> None:
    """Encode every text, append end_id, and write the ids below path in ascending id_col order.

    Range partitions of the ids are the shards, in order; rows of one id are ordered by text. A null or empty text is
    the end id alone, a null id sorts first and is stored as the least long. An empty table writes no record. Only the
    id and the text are read, so other columns cannot clash. A worker holds one record and a bounded table of pieces.
    """
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, make = TaskContext.get().partitionId(), encoder(vocabulary)
        held, docs_held, lengths, count, before, record = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, docs_held, lengths, count, before, record
            who, size, ids = np.concatenate(docs_held), np.concatenate(lengths), np.concatenate(held)
            values = (shard, record, before, len(ids), int(who[0]), who.astype("<i8").tobytes(), size.astype("<u8").tobytes(), pack(ids))
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=RECORD.names)
            before, record = before + len(ids), record + 1
            held, docs_held, lengths, count = [], [], [], 0
            return out

        for b in batches:
            _, at = string_buffers(b.column("text"))
            for i, j in slices(at, 1 << 20):
                texts = [t or "" for t in b.column("text").slice(i, j - i).to_pylist()]
                ids, number = make.encode(texts)
                if end_id is not None:
                    ids, number = np.insert(ids, np.cumsum(number), np.uint32(end_id)), number + 1
                held.append(ids)
                lengths.append(number)
                docs_held.append(b.column("id").slice(i, j - i).to_numpy(zero_copy_only=False))
                count += len(ids)
                if count >= RECORD_IDS:
                    yield close()
        if held:
            yield close()

    slim.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(run, RECORD).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Only one total for each shard comes to the driver; shards are as many as the partitions that wrote them.
    """
    records = spark.read.schema(RECORD).parquet(path)
    totals = sorted(records.groupBy("shard").agg(F.min("first_id"), F.sum("n_ids")).collect(), key=lambda r: (r[1], r[0]))
    offsets = np.concatenate([[0], np.cumsum([r[2] for r in totals], dtype=np.int64)])
    base = {r[0]: int(offsets[k]) for k, r in enumerate(totals)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = Blocks(r["blocks"]).read().astype("<u4")
                who, size = np.frombuffer(r["doc_ids"], "<i8"), np.frombuffer(r["lengths"], "<u8").astype(np.int64)
                ends = np.cumsum(size)
                starts = ends - size
                crc = [zlib.crc32(memoryview(ids[s:e]).cast("B")) if e > s else 0 for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64(), mask=who == -(1 << 63)), pa.array(starts + base[r["shard"]] + r["before"]), pa.array(size), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return records.select("shard", "before", "doc_ids", "lengths", "blocks").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/ids"
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read(spark, path)
