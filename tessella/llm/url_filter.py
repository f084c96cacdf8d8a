"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed into one multiword Shift-And machine: each pattern character is a bit, a star is a
self-loop on the bit before it. A batch of URLs advances one character at a time, all URLs and all rules at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with the rule's.
HOST_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Globs over host + path that block; `*` is any run of characters, `?` any one character.
GLOBS = ("*spam-farm*", "*cheap-pills*", "*casino*/*", "*/ads/*", "*/track?r/*", "*.exe", "*free-money*")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class GlobMachine:
    """Globs as bit masks; matches(texts) says for each UTF-8 text whether any glob fits the whole of it."""

    def __init__(self, globs: Sequence[str]):
        bits: list[int] = []  # the byte each bit reads, or -1 for any
        self.loop_bits, self.first, self.final = [], [], []
        for glob in globs:
            # A bit before the first character holds "nothing read yet".
            start = len(bits)
            bits.append(-2)
            self.first.append(start)
            for c in glob.encode():
                if c == ord("*"):
                    self.loop_bits.append(len(bits) - 1)
                else:
                    bits.append(-1 if c == ord("?") else c)
            self.final.append(len(bits) - 1)
        self.words = max(1, -(-len(bits) // 64))
        self.reads = np.zeros((256, self.words), np.uint64)
        for k, c in enumerate(bits):
            if c >= -1:
                self.reads[slice(None) if c == -1 else c, k // 64] |= np.uint64(1 << (k % 64))
        self.loops, self.begin, self.end = (self._mask(x) for x in (self.loop_bits, self.first, self.final))

    def _mask(self, positions: Sequence[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for k in positions:
            out[k // 64] |= np.uint64(1 << (k % 64))
        return out

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        out = np.zeros(len(texts), bool)
        if not len(self.final):
            return out
        length = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-length, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        at = (np.cumsum(length) - length)[order]
        length = length[order]
        state = np.broadcast_to(self.begin, (len(texts), self.words)).copy()
        alive = len(texts)
        for k in range(int(length[0]) + 1 if len(length) else 0):
            still = int(np.searchsorted(-length, -k, "right"))  # texts of at least k characters
            done = slice(int(np.searchsorted(-length, -k, "left")), still)
            out[order[done]] = ((state[done] & self.end) != 0).any(axis=1)
            alive = int(np.searchsorted(-length, -k, "left"))
            if not alive:
                break
            s = state[:alive]
            moved = s << np.uint64(1)
            moved[:, 1:] |= s[:, :-1] >> np.uint64(63)
            state[:alive] = (moved & self.reads[data[at[:alive] + k]]) | (s & self.loops)
        return out


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", host_rules: Sequence[tuple[str, str, str]] = HOST_RULES, globs: Sequence[str] = GLOBS) -> DataFrame:
    """Verdict for each URL: the longest host rule that fits, else block if any glob fits host + path, else allow.

    Returns id_col, host, path, rule, verdict, blocked_by_glob; other columns are left out, so names cannot clash.
    A null URL or one without `://` has an empty host and path: no rule fits and, with no glob for the empty text,
    it is allowed. Repeated rows are judged one by one; an empty table gives an empty one. Lengths are not bounded:
    a batch holds its URLs and one state per URL. Of host rules equally long, the first listed wins.
    """
    url = F.col(url_col).cast("string")
    host = F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))

    def fits(h: str, p: str):
        return ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)

    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(reversed(host_rules), key=lambda r: len(r[1] + r[2])):  # the last that fits stands
        rule, verdict = F.when(fits(h, p), F.lit(h + p)).otherwise(rule), F.when(fits(h, p), F.lit(v)).otherwise(verdict)

    machine = GlobMachine(globs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, p = (b.column(k).to_pylist() for k in ("host", "path"))
            hit = machine.matches([(x + y).encode() for x, y in zip(h, p, strict=True)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hit)], names=[*b.schema.names, "blocked_by_glob"])

    found = parts.mapInArrow(run, T.StructType([*parts.schema.fields, T.StructField("blocked_by_glob", T.BooleanType())]))
    return found.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("blocked_by_glob"), "block").otherwise("allow")).alias("verdict"), "blocked_by_glob")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP7_SQL = r"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(v, h, q) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
g(pat) AS (VALUES ('.*spam-farm.*'), ('.*cheap-pills.*'), ('.*casino.*/.*'), ('.*/ads/.*'), ('.*/track.r/.*'), ('.*\.exe'), ('.*free-money.*')),
j AS (
  SELECT p.*,
    (SELECT arg_max(h || q, length(h || q)) FROM r WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q)) AS rule,
    (SELECT arg_max(v, length(h || q)) FROM r WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q)) AS ruled,
    (SELECT coalesce(bool_or(regexp_full_match(p.host || p.path, g.pat, 's')), false) FROM g) AS blocked_by_glob
  FROM p)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN blocked_by_glob THEN 'block' ELSE 'allow' END) AS verdict, blocked_by_glob FROM j
"""
