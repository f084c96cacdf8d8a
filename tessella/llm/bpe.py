"""Byte-level BPE by an automaton over tokens.

Each merge (u, v) -> w is a gadget on a deterministic automaton whose arcs are tokens: every state with an arc u into a
state with an arc v gets an arc w to where u v led, and the state behind u is copied without the arc v. After all merges
the automaton's paths are exactly the tokenizations that the merges make. All arcs with one token lead to one state, so
a state is a token, and a state is stored as what its copying steps took away: the state of w starts as that of v, minus
arcs removed later. An arc w is there if, when its merge was added, the state still had the arc of its left part. What a
state lost, and when, is one table over (state, left part), compiled once; an arc is a few look-ups in it.
Each prefix of a word has one path, so one state: encoding goes through a word's bytes once, follows the labels that begin
at each place by a table of bytes, and enters the state of each prefix when the arc into it is met; the path is read off
backwards. A batch's distinct words go together, in numpy. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, release, slices, string_buffers, table

VOCABULARY = "byte_bpe_50k.json"
#: The public pre-split pattern of this vocabulary.
PATTERN = public_tokenizers.PATTERN
#: Bytes that a worker's table of known words may take, by estimate; beyond it the table begins anew.
REMEMBERED_BYTES = 96 << 20
#: What a word's entry takes besides its text and its ids' text.
ENTRY_BYTES = 330
#: Longer words are encoded one by one, with the labels of so many bytes looked up at once.
LONG_WORD = 256
WORD_BYTES = 4096
#: Bytes of text whose distinct words are learnt at once.
LEARN_BYTES = 4 << 20
_NEVER = np.int32(2**31 - 1)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


#: PATTERN for texts below U+0180, by a faster matcher: the classes are written out, and the commonest alternative is
#: first (no text starts matches of two alternatives before it and after it).
_L, _N, _S = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \u0085\u00a0"
PLAIN = re.compile(f" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_ABOVE = re.compile("[\u0180-\U0010ffff]")


class Table:
    """Numbers by non-negative 64-bit keys, by open addressing; look-ups go over whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        slot, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        slot = self._home(keys)
        have = self.keys[slot]
        out = np.where(have == keys, self.values[slot], np.int32(default))
        todo = np.flatnonzero((have != keys) & (have >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            have = self.keys[slot[todo]]
            hit = have == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (have >= 0)]
        return out


class Automaton:
    """The merges of a vocabulary file, compiled. States and arcs are token ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ids = spec["model"]["vocab"]
        self.label = {i: as_bytes(s) for s, i in ids.items()}
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self._split = regex.compile(PATTERN)
        never = int(_NEVER)
        removed: list[tuple[int, int]] = []  # by step: the state behind u lost the arc v
        #: Tokens whose states a token's state was copied from, and the step until which it inherits their removals.
        inherits: dict[int, tuple[tuple[int, int], ...]] = {i: ((i, never),) for i, b in self.label.items() if len(b) == 1}
        #: A token's left parts, and the step before which a missing arc to one keeps the token's arc from being made.
        needs: dict[int, tuple[tuple[int, int], ...]] = dict(inherits)
        for step, pair in enumerate(spec["model"]["merges"]):
            u_text, v_text = pair.split(" ") if isinstance(pair, str) else pair
            u, v, w = ids[u_text], ids[v_text], ids[u_text + v_text]
            if w not in inherits:
                inherits[w] = ((w, never), *((x, min(s, step)) for x, s in inherits[v]))
                # A step that copies the state behind u = v makes no arc w from the copy.
                made = step + 1 if u == v else step
                needs[w] = ((w, never), *((x, min(s, made)) for x, s in needs[u]))
            removed.append((u, v))
        self.width = max(self.label) + 1

        # lost: (state, arc of a left part) -> the first step at which the state, or one that it was copied from before, lost it.
        heirs: dict[int, list[tuple[int, int]]] = {}
        for state, chain in inherits.items():
            for x, until in chain:
                heirs.setdefault(x, []).append((state, until))
        heirs = {x: np.array(pairs, np.int64).T for x, pairs in heirs.items()}
        keys, steps = [], []
        for step, (u, v) in enumerate(removed):
            states, until = heirs[u]
            states = states[until > step]
            keys.append(states * self.width + v)
            steps.append(np.full(len(states), step, np.int64))
        keys, steps = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, steps))
        order = np.lexsort((steps, keys))
        keys, steps = keys[order], steps[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        self.lost = Table(keys[first], steps[first].astype(np.int32))

        #: By token: its left parts and their steps, padded by steps that nothing comes before.
        deep = max(map(len, needs.values()))
        self.parts, self.before = np.zeros((self.width, deep), np.int64), np.zeros((self.width, deep), np.int32)
        for t, chain in needs.items():
            self.parts[t, : len(chain)], self.before[t, : len(chain)] = [x for x, _ in chain], [s for _, s in chain]

        # A trie of the arcs' labels: (node, byte) -> node, and the token that ends at a node.
        edges: dict[int, int] = {}
        ends: dict[int, int] = {}
        for t in needs:
            node = 0
            for c in self.label[t]:
                node = edges.setdefault(node * 256 + c, len(edges) + 1)
            ends[node] = t
        self.ends = np.full(len(edges) + 1, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())
        self.walk = Table(np.array(list(edges), np.int64), np.array(list(edges.values()), np.int32))
        self.size = np.zeros(self.width, np.int64)
        self.size[list(self.label)] = [len(b) for b in self.label.values()]
        self._reset()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"held": 0, "_words": {}}

    def _reset(self) -> None:
        self.held = 0
        self._words: dict[str, tuple[int, str, bytes]] = {}

    def arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether each state has the arc: it is there unless the arc of one of its left parts was lost before its step."""
        there, todo = np.ones(len(states), bool), np.arange(len(states))
        for k in range(self.parts.shape[1]):
            gone = self.lost.get(states[todo] * self.width + self.parts[tokens[todo], k], _NEVER) < self.before[tokens[todo], k]
            there[todo[gone]] = False
            todo = todo[~gone]
            if k + 1 < self.parts.shape[1]:
                todo = todo[self.before[tokens[todo], k + 1] > 0]
            if not len(todo):
                break
        return there

    def _labels_at(self, data: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, token) of all labels in data that begin from first to last (exclusive)."""
        begin = np.arange(first, last)
        node, at, found = np.zeros(len(begin), np.int64), begin.copy(), []
        while len(begin):
            node = self.walk.get(node * 256 + data[at], -1)
            on = node >= 0
            begin, at, node = begin[on], at[on] + 1, node[on].astype(np.int64)
            t = self.ends[node]
            found.append(np.stack([begin[t >= 0], at[t >= 0], t[t >= 0]]))
            on = at < len(data)
            begin, at, node = begin[on], at[on], node[on]
        found = np.concatenate(found, axis=1)
        return tuple(found[:, np.lexsort((found[1], found[0]))])

    def encode_word(self, word: bytes) -> list[int]:
        """The path whose labels spell the word; state[k] is that of its first k bytes. Arcs between labels that meet are
        looked up WORD_BYTES bytes at a time."""
        data, size, longest = np.frombuffer(word, np.uint8), len(word), int(self.size.max())
        state = array("i", [-1]) * (size + 1)
        for first in range(0, size, WORD_BYTES):
            last = min(size, first + WORD_BYTES)
            begin, end, token = self._labels_at(data, max(0, first - longest), last)
            new = np.flatnonzero(begin >= first)
            by_end = np.argsort(end, kind="stable")
            low, high = np.searchsorted(end[by_end], begin[new], "left"), np.searchsorted(end[by_end], begin[new], "right")
            many = high - low
            left = by_end[np.repeat(high - np.cumsum(many), many) + np.arange(int(many.sum()))]
            keys = np.unique(token[left] * self.width + np.repeat(token[new], many))
            there = set(keys[self.arcs(keys // self.width, keys % self.width)].tolist())
            for i, k, t in zip(begin[new].tolist(), end[new].tolist(), token[new].tolist(), strict=True):
                if state[k] < 0 and (i == 0 or state[i] * self.width + t in there):
                    state[k] = t
        out, at = [], size
        while at:
            out.append(state[at])
            at -= len(self.label[state[at]])
        return out[::-1]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """encode_word() of each word, all words a byte at a time together."""
        size = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        data = np.frombuffer(b"".join(words[k] for k in order), np.uint8)
        base = np.cumsum(size) - size
        place = base + np.arange(len(words))  # of a word's empty prefix
        state = np.full(len(data) + len(words), -1, np.int64)
        longer = np.searchsorted(-size, -np.arange(int(size[0]) + 1 if len(size) else 1), "left")  # words of more than k bytes
        for i in range(int(size[0]) if len(size) else 0):
            who = np.arange(longer[i])
            u, node, k = state[place[who] + i], np.zeros(len(who), np.int64), i
            while len(who):
                node = self.walk.get(node * 256 + data[base[who] + k], -1)
                on = node >= 0
                who, u, node = who[on], u[on], node[on].astype(np.int64)
                k += 1
                t = self.ends[node]
                new = np.flatnonzero((t >= 0) & (state[place[who] + k] < 0))
                if i:
                    new = new[self.arcs(u[new], t[new])]
                state[place[who[new]] + k] = t[new]
                on = np.searchsorted(who, longer[k]) if k < len(longer) else 0
                who, u, node = who[:on], u[:on], node[:on]
        out: list[list[int]] = [[] for _ in words]
        at, who = size.copy(), np.flatnonzero(size)
        while len(who):
            t = state[place[who] + at[who]]
            for w, x in zip(order[who].tolist(), t.tolist(), strict=True):
                out[w].append(x)
            at[who] -= self.size[t]
            who = who[at[who] > 0]
        for x in out:
            x.reverse()
        return out

    def split(self, text: str) -> list[str]:
        return PLAIN.findall(text) if text.isascii() or not _ABOVE.search(text) else self._split.findall(text)

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """Pre-split words, and whether each is a special token."""
        if self.special_split is None or "<|" not in text:
            for w in self.split(text):
                yield w, False
            return
        for part in self.special_split.split(text):
            if part in self.special:
                yield part, True
            elif part:
                for w in self.split(part):
                    yield w, False

    def learn(self, words: set[str], most: int = REMEMBERED_BYTES) -> None:
        """Make sure that the table has all the words; it may begin anew, so learn all of a text's words at once."""
        fresh = [w for w in words if w not in self._words]
        if self._words and self.held + ENTRY_BYTES * len(fresh) > most:
            self._reset()
            fresh = list(words)
        raw = [w.encode() for w in fresh]
        short = [k for k, b in enumerate(raw) if len(b) <= LONG_WORD]
        paths = dict(zip(short, self.encode_words([raw[k] for k in short]), strict=True))
        for k, w in enumerate(fresh):
            ids = paths[k] if k in paths else self.encode_word(raw[k])
            joined = ",".join(map(str, ids))
            self._words[w] = (len(ids), joined, b"".join(map(self.label.__getitem__, ids)))
            self.held += ENTRY_BYTES + 2 * len(raw[k]) + len(joined)

    def encode(self, text: str) -> list[int]:
        return [i for w, special in self.pieces(text) for i in ([self.special[w]] if special else self.encode_word(w.encode()))]

    def decode(self, ids: list[int]) -> str:
        names = {i: s for s, i in self.special.items()}
        out, run = [], []
        for i in ids:
            if i in names:
                out += [b"".join(run).decode(errors="replace"), names[i]]
                run = []
            else:
                run.append(self.label[i])
        return "".join([*out, b"".join(run).decode(errors="replace")])

    def digests(self, texts: list[str], most: int = REMEMBERED_BYTES) -> Iterator[tuple[int, str, bytes]]:
        """For each text the number of ids, the ids as decimals joined by commas, and their labels' bytes."""
        marked = [self.special_split is not None and "<|" in t for t in texts]
        split = [list(self.pieces(t)) if m else self.split(t) for t, m in zip(texts, marked, strict=True)]
        wanted: set[str] = set()
        for words, m in zip(split, marked, strict=True):
            wanted.update((w for w, special in words if not special) if m else words)
        self.learn(wanted, most)
        known = self._words
        for words, m in zip(split, marked, strict=True):
            if m:
                found = [(1, str(self.special[w]), w.encode()) if special else known[w] for w, special in words]
            else:
                found = [known[w] for w in words]
            if found:
                n, ids, labels = zip(*found, strict=True)
                yield sum(n), ",".join(ids), b"".join(labels)
            else:
                yield 0, "", b""

    def digest(self, text: str) -> tuple[int, str, bytes]:
        return next(self.digests([text]))


def automaton(path: str | None = None) -> Automaton:
    """The compiled automaton, kept by the process."""
    return table("bpe", path or public_tokenizers.path(VOCABULARY), Automaton)


def round_trip(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, remembered: int = REMEMBERED_BYTES, learnt: int = LEARN_BYTES) -> DataFrame:
    """Per row: id_col, n_tokens, ids_sha256, decoded_sha256, intact (the decoded text is the text).

    Null and empty texts have no tokens. Repeated rows are encoded one by one; only the id is carried over, so other
    columns cannot clash; an empty table gives an empty one. No shuffle. The automaton is compiled once and broadcast: its
    size is the vocabulary's. A worker holds a slice's pieces (or one longer text's), the automaton and a table of known
    words of `remembered` bytes but for the slice's own, where a slice is `learnt` bytes of text.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    compiled = docs.sparkSession.sparkContext.broadcast(automaton(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("bpe")
        machine, sha = compiled.value, hashlib.sha256
        for b in batches:
            _, at = string_buffers(b.column("text"))
            for i, j in slices(at, learnt):
                n, ids, texts, same = [], [], [], []
                every = [t or "" for t in b.column("text").slice(i, j - i).to_pylist()]
                for text, (k, joined, labels) in zip(every, machine.digests(every, remembered), strict=True):
                    n.append(k)
                    ids.append(sha(joined.encode()).hexdigest())
                    raw = labels.decode(errors="replace")
                    texts.append(sha(raw.encode()).hexdigest())
                    same.append(raw == text)
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(same, pa.bool_())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "intact"])

    schema = T.StructType([slim.schema["id"], *(T.StructField(c, t) for c, t in (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("intact", T.BooleanType())))])
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
