"""Personal data: fixed patterns, and a linear-chain conditional random field for secrets.

The field labels tokens O, B or I from the word shapes of a token and its two neighbours. It is trained here on a small
labelled table made by a rule, and decoded by Viterbi over numpy batches. A token whose score for O exceeds any gain a
path could make through another label is O on every best path, so it parts the text; only what lies between such tokens
is decoded, and that is exact.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _LOWER, _WHITE, bound_batches, mix, powers, slices, string_buffers

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: From a digit inside a run of digits no match can begin that its first digit does not begin: each run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPACE_SIGNS = str.maketrans("", "", " -().+")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of all pattern matches, sorted."""
    out, bound, at = [], 0, text.find("@")
    while at >= 0:
        start = bound + len(text[bound:at].rstrip(_LOCAL))
        bound = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            bound = m.end()
        at = text.find("@", bound)
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].translate(_SPACE_SIGNS)
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(m[0].translate(_SPACE_SIGNS)) <= 15]
    return sorted(out)


# ---------------------------------------------------------------- word shapes

CUES = ("password", "passwd", "pwd", "token", "secret", "key", "apikey", "api_key", "access_key", "bearer")
_DIGIT, _UPPER, _SMALL = (np.zeros(256, bool) for _ in range(3))
_DIGIT[48:58] = _UPPER[65:91] = _SMALL[97:123] = True
_SMALL[128:] = True
#: Bits of a shape: what a token has. Codes are all combinations.
FEATURES = ("digit", "digits_3", "upper", "upper_5", "small", "sign", "equals", "quote", "long_12", "long_16", "mixed", "cue", "dotted")


def token_bounds(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the runs of anything but ASCII white space; none spans two rows."""
    white = _WHITE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[at] = True
    first, last = ~white, ~white
    if len(buf):
        first[1:] &= white[:-1] | edge[1:-1]
        last[:-1] &= white[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _cue_hashes() -> np.ndarray:
    return np.sort(np.array([_hash_of(c.encode()) for c in CUES], np.uint64))


def _hash_of(word: bytes) -> int:
    p, _ = powers(len(word))
    return int(mix(((np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1)) * p[: len(word)]).sum(keepdims=True))[0])


def shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each token's shape code."""

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(mask, out=sums[1:])
        return sums[ends] - sums[starts]

    digit, upper, small = count(_DIGIT[buf]), count(_UPPER[buf]), count(_SMALL[buf])
    length = ends - starts
    sign = length - digit - upper - small
    odd = (digit > 0) | (sign > 0)
    equals, quote, dots = (np.zeros(len(starts), bool) for _ in range(3))
    if odd.any():
        equals = (count(buf == 0x3D) > 0) | (count(buf == 0x3A) > 0)
        quote = (count(buf == 0x22) > 0) | (count(buf == 0x27) > 0)
        dots = count((buf == 0x2E) | (buf == 0x40)) > 1
    cue = np.zeros(len(starts), bool)
    # A cue may end in a sign, as in "password=..." or "token:"; its letters are the token's first.
    near = np.flatnonzero((length >= 3) & (small >= 3) & ((sign > 0) | (length <= 10)))
    if len(near):
        letters = _SMALL[buf] | _UPPER[buf] | (buf == 0x5F)
        stops = np.append(np.flatnonzero(~letters), len(buf))
        stop = np.minimum(stops[np.searchsorted(stops, starts[near])], ends[near])
        p, q = powers(len(buf))
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((_LOWER[buf].astype(np.uint64) + np.uint64(1)) * p[: len(buf)], out=sums[1:])
        cue[near] = np.isin(mix((sums[stop] - sums[starts[near]]) * q[starts[near]]), _cue_hashes())
    flags = (digit > 0, digit >= 3, upper > 0, upper >= 5, small > 0, sign > 0, equals, quote, length >= 12, length >= 16, (digit >= 2) & (upper + small >= 2), cue, dots)
    code = np.zeros(len(starts), np.int32)
    for k, f in enumerate(flags):
        code |= f.astype(np.int32) << k
    return code


# ---------------------------------------------------------------- the field


class Field:
    """Weights of a linear chain over labels O, B, I: emission by shape code at offsets -1, 0, 1, and transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        bits = (np.arange(1 << len(FEATURES))[:, None] >> np.arange(len(FEATURES))) & 1
        table = np.concatenate([np.ones((len(bits), 1)), bits], axis=1)
        self.by_code = np.einsum("cf,ofl->ocl", table, weights)
        #: No change of one label to O costs a path more than this in its two transitions.
        self.bound = 2 * float(moves.max() - moves.min())

    def emissions(self, codes: np.ndarray, row: np.ndarray) -> np.ndarray:
        before, now, after = self.by_code
        out = now[codes]
        if len(codes) > 1:
            same = (row[1:] == row[:-1])[:, None]
            out[1:] += before[codes[:-1]] * same
            out[:-1] += after[codes[1:]] * same
        return out

    def decode(self, codes: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The best labels of the sequences that row numbers part."""
        labels = np.zeros(len(codes), np.int8)
        if not len(codes):
            return labels
        scores = self.emissions(codes, row)
        free = scores[:, 0] - scores[:, 1:].max(axis=1) <= self.bound
        places = np.flatnonzero(free)
        if not len(places):
            return labels
        cut = np.concatenate([[True], (np.diff(places) > 1) | (row[places[1:]] != row[places[:-1]])])
        begins = places[cut]
        sizes = np.diff(np.append(np.flatnonzero(cut), len(places)))
        for size in np.unique(sizes):
            some = begins[sizes == size]
            left = (some > 0) & (row[np.maximum(some - 1, 0)] == row[some])
            last = some + size - 1
            right = (last + 1 < len(codes)) & (row[np.minimum(last + 1, len(codes) - 1)] == row[last])
            best = scores[some] + np.where(left[:, None], self.moves[0], 0)
            back = np.zeros((size, len(some), 3), np.int8)
            for k in range(1, size):
                paths = best[:, :, None] + self.moves
                back[k] = paths.argmax(axis=1)
                best = paths.max(axis=1) + scores[some + k]
            now = (best + np.where(right[:, None], self.moves[:, 0], 0)).argmax(axis=1)
            for k in range(size - 1, -1, -1):
                labels[some + k] = now
                now = np.take_along_axis(back[k], now[:, None].astype(np.int64), axis=1)[:, 0]
        return labels


def labelled_table(rows: int = 300, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Sentences made by a rule and the labels of their words: secrets of several forms among words and numbers."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("th", "er", "on", "an", "re", "ti", "es", "en", "at", "ed", "la", "que", "der", "und", "ción", "é", "ü")) for _ in range(r.randint(1, 5)))
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    big = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))

    def secret() -> tuple[list[str], list[int]]:
        cue = r.choice(CUES)
        form = r.randrange(5)
        if form == 0:
            return [f"{cue}={hexes(r.randint(12, 32))}"], [1]
        if form == 1:
            return [cue, "=", f'"{hexes(r.randint(20, 44))}"'], [0, 0, 1]
        if form == 2:
            return ["AKIA" + big(16) + r.choice(("", ".", ","))], [1]
        if form == 3:
            return [f"{cue}:", hexes(r.randint(16, 40))], [0, 1]
        return [cue, "=", f'"{hexes(16)}', f'{hexes(16)}"'], [0, 0, 1, 2]

    def plain() -> str:
        form = r.randrange(40)
        some = ("2.0.", "4.0.", "3.", f"{r.randint(1, 255)}.{r.randint(1, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}", f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", str(r.randint(10**15, 10**16)), f"{word()}{r.randint(1, 99)}@{word()}.example.com", word().upper() + "!!", word() + "***", "|", "=", "{", "}", "CC", "BY-NC", r.choice(CUES), str(r.randint(1, 9999)), f'"{word()}"', f"https://{word()}.example.org/{r.randint(1, 999)}", "".join(word() for _ in range(4)), "".join(word() for _ in range(4)).upper() + "!!", f"{word()}: {word()}", f"{word()}-{word()}")
        return some[form] if form < len(some) else r.choice((word(), word().capitalize(), word() + ",", word() + "."))

    out = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(r.randint(3, 14)):
            if r.random() < 0.12:
                w, y = secret()
            else:
                w = plain().split()
                y = [0] * len(w)
            words += w
            labels += y
        out.append((" ".join(words), labels))
    return out


def train(table: list[tuple[str, list[int]]], rounds: int = 80, penalty: float = 1e-3, rate: float = 0.4) -> Field:
    """Maximum likelihood with a quadratic penalty by AdaGrad; all sequences at once, padded."""
    n, size = len(table), max(len(y) for _, y in table)
    bits = np.zeros((n, size + 2, 1 + len(FEATURES)))
    gold, live = np.zeros((n, size), int), np.zeros((n, size), bool)
    for k, (text, y) in enumerate(table):
        buf = np.frombuffer(text.encode(), np.uint8)
        codes = shapes(buf, *token_bounds(buf, np.array([0, len(buf)])))
        bits[k, 1 : len(y) + 1] = np.concatenate([np.ones((len(y), 1)), (codes[:, None] >> np.arange(len(FEATURES))) & 1], axis=1)
        gold[k, : len(y)], live[k, : len(y)] = y, True
    x = np.stack([bits[:, :-2], bits[:, 1:-1], bits[:, 2:]])  # offset, sequence, place, feature
    weights, moves = np.zeros((3, bits.shape[2], 3)), np.zeros((3, 3))
    sums = [np.full(weights.shape, 1e-8), np.full(moves.shape, 1e-8)]
    one = np.eye(3)[gold] * live[:, :, None]
    pair_live = live[:, 1:] & live[:, :-1]
    gold_moves = np.einsum("nti,ntj->ij", one[:, :-1] * pair_live[:, :, None], one[:, 1:])
    soft = lambda a, axis: np.log(np.exp(a - a.max(axis=axis, keepdims=True)).sum(axis=axis)) + a.max(axis=axis)
    for _ in range(rounds):
        score = np.einsum("ontf,ofl->ntl", x, weights)
        ahead, behind = np.zeros((n, size, 3)), np.zeros((n, size, 3))
        ahead[:, 0] = score[:, 0]
        for t in range(1, size):
            ahead[:, t] = np.where(live[:, t, None], score[:, t] + soft(ahead[:, t - 1, :, None] + moves, 1), ahead[:, t - 1])
        for t in range(size - 2, -1, -1):
            behind[:, t] = np.where(live[:, t + 1, None], soft(moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2), 0)
        whole = soft(ahead[:, -1], 1)
        marginal = np.exp(ahead + behind - whole[:, None, None]) * live[:, :, None]
        pairs = np.exp(ahead[:, :-1, :, None] + moves + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]) * pair_live[:, :, None, None]
        steps = (np.einsum("ontf,ntl->ofl", x, one - marginal) - penalty * n * weights, gold_moves - pairs.sum(axis=(0, 1)) - penalty * n * moves)
        for value, step, total in zip((weights, moves), steps, sums, strict=True):
            total += step**2
            value += rate * step / np.sqrt(total)
    return Field(weights, moves)


_fields: dict[int, Field] = {}


def default_field() -> Field:
    if 0 not in _fields:
        _fields[0] = train(labelled_table())
    return _fields[0]


# ---------------------------------------------------------------- the operator

_STRIP = "\"'`.,;:!?()[]{}<>"
_LOOK = np.zeros(256, bool)
_LOOK[[*range(48, 58), 0x40]] = True


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """Per row: id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_spans (of all kinds).

    Spans are kind:start:end in code points, by start, then kind; a secret that overlaps a pattern's span is left out.
    Null and empty texts have none, an empty table gives an empty one. Repeated rows are searched one by one; only the id
    is carried over, so other columns cannot clash. A worker holds a few megabytes of text at a time, or one longer text.
    """
    field = field or default_field()
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for b in batches:
            column = b.column("text")
            data, at = string_buffers(column)
            for i, j in slices(at):
                n = j - i
                buf, rows = data[at[i] : at[j]], at[i : j + 1] - at[i]
                starts, ends = token_bounds(buf, rows)
                row = np.searchsorted(rows, starts, "right") - 1
                labels = field.decode(shapes(buf, starts, ends), row)
                hits = np.flatnonzero(labels)
                look = np.zeros(len(buf) + 1, np.int64)
                np.cumsum(_LOOK[buf], out=look[1:])
                todo = set(np.flatnonzero(look[rows[1:]] > look[rows[:-1]]).tolist()) | set(row[hits].tolist())
                by_row: dict[int, list[int]] = {}
                for h in hits.tolist():
                    by_row.setdefault(int(row[h]), []).append(h)
                counts = np.zeros((5, n), np.int64)
                digests, spans = [nothing] * n, [""] * n
                for k in todo:
                    raw = buf[rows[k] : rows[k + 1]].tobytes()
                    text = raw.decode()
                    base = base_spans(text)
                    every = list(base)
                    runs: list[list[int]] = []
                    for h in by_row.get(k, ()):  # B opens a span, I goes on with it
                        if labels[h] == 2 and runs and runs[-1][1] == h - 1:
                            runs[-1][1] = h
                        else:
                            runs.append([h, h])
                    for first, last in runs:
                        s, e = starts[first] - rows[k], ends[last] - rows[k]
                        body = raw[s:e].decode()
                        left = body.lstrip(_STRIP)
                        s = len(raw[:s].decode()) + len(body) - len(left)
                        e = s + len(left.rstrip(_STRIP))
                        if e > s and not any(x < e and s < y for x, _, y in base):
                            every.append((s, 4, e))
                    joined = lambda found: ",".join(f"{KINDS[kind]}:{s}:{e}" for s, kind, e in found)
                    for _, kind, _ in every:
                        counts[kind, k] += 1
                    digests[k], spans[k] = hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(every))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, n), *(pa.array(counts[x]) for x in range(4)), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(counts[4])], names=names)

    names = ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret"]
    schema = T.StructType([slim.schema["id"], *(T.StructField(c, T.StringType() if c in ("base_sha256", "spans") else T.LongType()) for c in names[1:])])
    found = slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return found.withColumn("n_spans", F.expr("n_email + n_ip + n_card + n_phone + n_secret"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
