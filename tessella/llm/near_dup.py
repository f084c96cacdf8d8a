"""Near-duplicates by a chosen-path set similarity join.

Every distinct set of word shingles gets minwise tokens under a family of hash functions. In each of several independent
trees a node chooses some of the functions, each with probability 1 / (similarity x functions), and passes a set on to
one child for each chosen function, named by the set's minwise token under it. Sets that are alike stay together on some
path with a probability that repeated trees raise to the target recall; sets that are not part quickly. Small nodes are
compared exhaustively, large ones branch on. A pair is looked at only while its sets are not known to be in one
component, and nodes within one component are finished: this loses no component and keeps large groups of copies from
costing the square of their size. Sketches of the minwise tokens drop hopeless pairs; links are confirmed on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, components, distinct_sets, forget, mix, release, remove, remove_but, row_key, shared_dir, shingles, slices, stored, string_buffers, words

FUNCTIONS = 128
RECALL = 0.9999
#: Depth at which all sets' paths begin; nodes above it are never small in a large corpus.
FIRST_DEPTH = 2
#: Deepest node; sets that still share large nodes there are compared exhaustively, block by block.
LAST_DEPTH = 4
#: Sets and bytes of text of a block, about.
BLOCK_SETS = 1024
BLOCK_BYTES = 4 << 20
#: Sets whose paths are followed at once.
PATH_SETS = 200
#: A node with at most this many sets is compared exhaustively.
SMALL_NODE = 24
#: Trees whose nodes are gathered at once.
TREES_AT_ONCE = 13
#: Trees of each round that compares a node's sets with one of them only.
STAR_TREES = 5
STAR_ROUNDS = 3
#: Ids that are broadcast at most; beyond it the texts are shuffled.
BROADCAST_IDS = 1 << 20
_LOW_BITS = 0x5555555555555555
SKETCH = tuple(f"k{k + 1}" for k in range(FUNCTIONS // 32))


def _family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32))
    return x[:n], x[n:] | np.uint64(1)


def trees_for(recall: float = RECALL, depth: int = LAST_DEPTH) -> int:
    """Trees so that a pair just at the threshold shares a node at the depth with the probability recall."""
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(-(1 - lost))
    return math.ceil(math.log(1 - recall) / math.log(lost))


def sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, copy (hash of the text), n (size of its set), h1 and h2 (hashes of the set), minwise (tokens, 4 bytes each), k1 to k4 (sketch: two bits of each token)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select("id", F.xxhash64("text").alias("copy"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        xors, factors = _family(FUNCTIONS, 1)
        for b in batches:
            data, at = string_buffers(b.column("text"))
            for i, j in slices(at):
                values, n = distinct_sets(*shingles(*words(data, at[i : j + 1]), width))
                some = np.flatnonzero(n)
                first = (np.cumsum(n) - n)[some]
                h = np.zeros((2, j - i), np.uint64)
                tokens = np.zeros((j - i, FUNCTIONS), np.uint32)
                if len(some):
                    for k in range(2):
                        h[k, some] = mix(np.add.reduceat(mix(values ^ xors[k]), first) + n[some].astype(np.uint64))
                    for k in range(FUNCTIONS):
                        least = np.minimum.reduceat((values ^ xors[k]) * factors[k], first)
                        tokens[some, k] = (mix(least) >> np.uint64(32)).astype(np.uint32)
                two = (tokens & np.uint32(3)).astype(np.uint64) << (np.arange(FUNCTIONS, dtype=np.uint64) % np.uint64(32) * np.uint64(2))
                sketch = [np.bitwise_or.reduce(two[:, k : k + 32], axis=1) for k in range(0, FUNCTIONS, 32)]
                raw = [tokens[k].tobytes() if n[k] else None for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("id", "copy")), pa.array(n.astype(np.int64)), *(pa.array(x.view(np.int64)) for x in h), pa.array(raw, pa.binary()), *(pa.array(k.view(np.int64)) for k in sketch)], names=names)

    names = ["id", "copy", "n", "h1", "h2", "minwise", *SKETCH]
    kinds = (slim.schema["id"].dataType, *[T.LongType()] * 4, T.BinaryType(), *[T.LongType()] * len(SKETCH))
    return slim.mapInArrow(run, T.StructType([T.StructField(c, k) for c, k in zip(names, kinds, strict=True)]))


_ENTRY = "node long, cid long"


def _chosen(paths: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(path's place, function) of the functions that each path chooses."""
    draw = mix(paths[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, FUNCTIONS + 1, dtype=np.uint64))
    return np.nonzero(draw < np.uint64(int(share * 2.0**64)))


def _children(paths: np.ndarray, tokens: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The places that go on and the children's paths."""
    place, function = _chosen(paths, share)
    return place, mix(mix(paths[place] + function.astype(np.uint64) + np.uint64(1)) + tokens[place, function].astype(np.uint64))


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, FUNCTIONS)


def entries(reps: DataFrame, trees: range, share: float) -> DataFrame:
    """The nodes at FIRST_DEPTH that each set of reps (cid, minwise) belongs to, in the trees given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            for i in range(0, b.num_rows, PATH_SETS):
                part = b.slice(i, PATH_SETS)
                tokens = _tokens(part.column("minwise"))
                place = np.tile(np.arange(part.num_rows), len(trees))
                paths = mix(np.repeat(np.array(trees, np.uint64) + np.uint64(1 << 40), part.num_rows))
                for _ in range(FIRST_DEPTH):
                    at, paths = _children(paths, tokens[place], share)
                    place = place[at]
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), part.column("cid").take(pa.array(place))], names=["node", "cid"])

    return reps.select("cid", "minwise").mapInArrow(run, _ENTRY)


def branches(large: DataFrame, share: float) -> DataFrame:
    """The children of large nodes (node, cid, minwise)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            for i in range(0, b.num_rows, PATH_SETS):
                part = b.slice(i, PATH_SETS)
                at, paths = _children(part.column("node").to_numpy().view(np.uint64), _tokens(part.column("minwise")), share)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), part.column("cid").take(pa.array(at))], names=["node", "cid"])

    return large.select("node", "cid", "minwise").mapInArrow(run, _ENTRY)


def _least(percent: int) -> int:
    """Tokens whose two bits must agree: four standard deviations fewer than sets just at the similarity show."""
    share = percent / 100 + (1 - percent / 100) / 4
    return math.floor(FUNCTIONS * share - 4 * math.sqrt(FUNCTIONS * share * (1 - share)))


def _agreement(x: str, y: str):
    apart = F.lit(0)
    for k in SKETCH:
        d = F.col(x + k).bitwiseXOR(F.col(y + k))
        apart = apart + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(_LOW_BITS)))
    return F.lit(FUNCTIONS) - apart


def _alike(percent: int, x: str, y: str):
    """Whether two sets' sizes and sketches leave the similarity possible."""
    n, m = F.col(x + "n"), F.col(y + "n")
    return (100 * n >= percent * m) & (100 * m >= percent * n) & (_agreement(x, y) >= _least(percent))


def in_blocks(members: DataFrame, texts: DataFrame, width: int, percent: int, path: str) -> DataFrame:
    """Links (a, b) that join the components of each group's members (grp, cid, root, n, sketch).

    A group is dealt into blocks of bounded sets and bytes, and every two blocks meet in one task, whatever the group's
    size. There, pairs of sets in one component, by then, are passed over; the rest of those that sizes and
    sketches allow are confirmed on their full sets.
    """
    whole = stored(members.join(texts, "cid"), path)
    sizes = whole.groupBy("grp").agg(F.greatest(F.count("*") / BLOCK_SETS, F.sum(F.octet_length("text")) / BLOCK_BYTES).cast("int").alias("last"))
    dealt = whole.join(sizes, "grp").withColumn("at", F.pmod(F.xxhash64("cid"), F.col("last") + 1).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    dealt = dealt.select("grp", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "at", "cid", "root", "n", "text", *SKETCH)
    least, popcount = _least(percent), np.bitwise_count

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("cid", ignore_index=True)
        at, n, root = part["at"].to_numpy(), part["n"].to_numpy(), part["root"].tolist()
        data, offsets = string_buffers(pa.array(part["text"], pa.large_string()))
        values, count = distinct_sets(*shingles(*words(data, offsets), width))
        full = np.split(values, np.cumsum(count)[:-1])
        sketch = part[list(SKETCH)].to_numpy().view(np.uint64)
        parent = {r: r for r in root}

        def find(r: int) -> int:
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        links = []
        across = part["i"].iat[0] != part["j"].iat[0]
        cid = part["cid"].tolist()
        for x in range(len(part)):
            rest = slice(x + 1, None)
            d = sketch[rest] ^ sketch[x]
            agree = FUNCTIONS - popcount((d | (d >> np.uint64(1))) & np.uint64(_LOW_BITS)).sum(axis=1)
            near = (agree >= least) & (100 * n[rest] >= percent * n[x]) & (100 * n[x] >= percent * n[rest])
            if across:
                near &= at[rest] != at[x]
            places = np.flatnonzero(near)
            for y in (places[np.argsort(-agree[places].astype(np.int64), kind="stable")] + x + 1).tolist():
                r, q = find(root[x]), find(root[y])
                if r != q:
                    common = len(np.intersect1d(full[x], full[y], assume_unique=True))
                    if 100 * common >= percent * (count[x] + count[y] - common):
                        parent[max(r, q)] = min(r, q)
                        links.append((cid[x], cid[y]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    # Dealt by group alone, as the join leaves them, all blocks of a group would be one task's.
    return dealt.repartition("grp", "i", "j").groupBy("grp", "i", "j").applyInPandas(compare, "a long, b long")


def texts_of(need: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """(cid, text) of the sets in need, by id (null too) and text hash; these are broadcast where they are few enough, by count."""
    who = stored(reps.select("cid", F.col("holder.id").alias("who"), F.col("holder.copy").alias("whose")).join(need, "cid"), path)
    if who.count() <= BROADCAST_IDS:
        who = F.broadcast(who)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.join(who, F.col("id").eqNullSafe(F.col("who")) & (F.xxhash64("text") == F.col("whose"))).select("cid", "text")


def confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, width: int, percent: int, id_col: str, text_col: str, path: str) -> DataFrame:
    """The pairs (a, b) of sets with 100 x intersection >= percent x union, counted on the full sets of the texts."""
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), docs, reps, id_col, text_col, f"{path}-ids")
    both = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("cid").alias("b"), F.col("text").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            (dx, ox), (dy, oy) = string_buffers(batch.column("x")), string_buffers(batch.column("y"))
            for i, j in slices(ox + oy):
                x, nx = distinct_sets(*shingles(*words(dx, ox[i : j + 1]), width))
                y, ny = distinct_sets(*shingles(*words(dy, oy[i : j + 1]), width))
                row = np.concatenate([np.repeat(np.arange(j - i), nx), np.repeat(np.arange(j - i), ny)])
                values = np.concatenate([x, y])
                order = np.lexsort((values, row))
                values, row = values[order], row[order]
                same = (values[1:] == values[:-1]) & (row[1:] == row[:-1])
                common = np.bincount(row[1:][same], minlength=j - i)
                keep = pa.array((100 * common >= percent * (nx + ny - common)) & (common > 0))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, recall: float) -> DataFrame:
    """Per row: id, copy, n, component and the component's leader, its first row (null_id, id, copy); null where n is 0."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = shared_dir(spark)
    share = 1 / (percent / 100 * FUNCTIONS)
    trees = trees_for(recall)
    rows = stored(sets(docs, width, id_col, text_col), f"{path}/sets")
    same = [F.first(c).alias(c) for c in ("n", "minwise", *SKETCH)]
    reps = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.min(F.struct(F.col("id").isNull().alias("null_id"), "id", "copy")).alias("holder"), F.count("*").alias("copies"), *same)
    reps = stored(reps.withColumn("cid", F.monotonically_increasing_id()), f"{path}/reps")
    looks = {x: reps.select(F.col("cid").alias(x), *(F.col(k).alias(x + k) for k in ("n", *SKETCH))) for x in "ab"}
    roots, links = None, None

    def rooted(level: DataFrame, name: str) -> DataFrame:
        """level with each set's component so far."""
        out = level.withColumn("root", F.col("cid")) if roots is None else level.join(roots, level["cid"] == roots["id"], "left").select("node", "cid", F.coalesce("root", "cid").alias("root"))
        return stored(out, f"{path}/{name}")

    def add(pairs: DataFrame, name: str) -> None:
        """Confirm pairs and join the components that they link."""
        join(confirmed(stored(pairs, f"{path}/{name}-pairs"), docs, reps, width, percent, id_col, text_col, f"{path}/{name}"), name)

    def join(found: DataFrame, name: str) -> None:
        nonlocal roots, links
        more = stored(found, f"{path}/{name}-links")
        if links is None or not more.isEmpty():
            links = more if links is None else links.unionByName(more)
            roots = stored(components(links, f"{path}/{name}"), f"{path}/{name}-roots")

    # A few trees first, each set of a node with one set of it, and of these partners only the most alike: groups of copies become
    # components at a cost in proportion to their rows.
    for k in range(STAR_ROUNDS):
        least = F.min if k % 2 == 0 else F.max
        few = rooted(entries(reps, range(trees + k * STAR_TREES, trees + (k + 1) * STAR_TREES), share), f"few{k}")
        nodes = few.groupBy("node").agg(least("cid").alias("a"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("node", "a")
        star = few.join(nodes, "node").where(F.col("a") != F.col("cid")).select("a", F.col("cid").alias("b"), F.col("root").alias("broot")).distinct()
        if roots is not None:
            star = star.join(roots.select(F.col("id").alias("a"), F.col("root").alias("aroot")), "a", "left").where(F.coalesce("aroot", "a") != F.col("broot"))
        near = star.select("a", "b").join(looks["a"], "a").join(looks["b"], "b").where(_alike(percent, "a", "b"))
        add(near.groupBy("b").agg(F.max_by("a", _agreement("a", "b")).alias("a")).select("a", "b"), f"star{k}")
        remove(spark, f"{path}/few{k}")
        forget(spark)

    # All trees, a few at a time: pairs of sets that are not yet in one component.
    found, deep = [], []
    for first in range(0, trees, TREES_AT_ONCE):
        level = entries(reps, range(first, min(first + TREES_AT_ONCE, trees)), share)
        for depth in range(FIRST_DEPTH, LAST_DEPTH + 1):
            name = f"{first}-{depth}"
            known = rooted(level, f"level{name}")
            mixed = known.groupBy("node").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("node", "size")
            mixed = stored(known.join(mixed, "node").select("node", "cid", "root", "size"), f"{path}/mixed{name}")
            remove(spark, f"{path}/level{name}")
            small = stored(mixed.where(F.col("size") <= SMALL_NODE).join(reps.select("cid", "n", *SKETCH), "cid"), f"{path}/small{name}")
            x, y = (small.select("node", F.col("cid").alias(c), F.col("root").alias(c + "root"), *(F.col(k).alias(c + k) for k in ("n", *SKETCH))) for c in "ab")
            pairs = x.join(y, (x["node"] == y["node"]) & (F.col("a") < F.col("b")) & (F.col("aroot") != F.col("broot")) & _alike(percent, "a", "b")).select("a", "b").distinct()
            found.append(stored(pairs, f"{path}/pairs{name}"))
            remove(spark, f"{path}/small{name}")
            large = mixed.where(F.col("size") > SMALL_NODE)
            if depth == LAST_DEPTH or large.isEmpty():
                break
            level = branches(large.join(reps.select("cid", "minwise"), "cid"), share)
        deep.append(large.select("node", "cid"))
        forget(spark)
    add(reduce(DataFrame.unionByName, found).distinct(), "all")

    # What is left in large nodes: sets that share such nodes form groups, each compared as a whole.
    rest = rooted(reduce(DataFrame.unionByName, deep), "rest")
    mixed = rest.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("node")
    rest = stored(rest.join(mixed, "node"), f"{path}/rest-mixed")
    if not rest.isEmpty():
        groups = components(rest.select(F.col("node").alias("a"), F.col("cid").alias("b")), f"{path}/groups").withColumnRenamed("root", "grp")
        members = rest.select("cid", "root").distinct().join(groups, F.col("cid") == F.col("id")).select("grp", "cid", "root").join(reps.select("cid", "n", *SKETCH), "cid")
        members = stored(members, f"{path}/members")
        join(in_blocks(members, texts_of(members.select("cid"), docs, reps, id_col, text_col, f"{path}/member-ids"), width, percent, f"{path}/member-texts").distinct(), "blocks")

    linked = reps.select("cid", "h1", "h2", "id", "holder").join(roots.select(F.col("id").alias("cid"), "root"), "cid")
    linked = linked.join(linked.groupBy("root").agg(F.min("id").alias("component"), F.min("holder").alias("leader")), "root").select("h1", "h2", "component", "leader")
    # Sets that occur once and have no link are components of their own.
    known = reps.where("copies > 1").select("h1", "h2", "id", "holder").join(linked, ["h1", "h2"], "full").select("h1", "h2", F.coalesce("component", "id").alias("component"), F.coalesce("leader", "holder").alias("leader"))
    known = stored(known, f"{path}/components")
    remove_but(spark, path, "sets", "components")
    out = rows.select("id", "copy", "n", *(F.when(F.col("n") > 0, F.col(c)).alias(c) for c in ("h1", "h2"))).join(known, ["h1", "h2"], "left")
    own = F.when(F.col("n") > 0, F.struct(F.col("id").isNull().alias("null_id"), "id", "copy"))
    return out.select("id", "copy", "n", F.coalesce("component", "id").alias("component"), F.coalesce("leader", own).alias("leader"))


def similar_sets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, recall: float = RECALL) -> DataFrame:
    """Per row: id_col, n_shingles, component_id, kept.

    Rows whose sets of `width`-word shingles have 100 x intersection >= percent x union are linked; component_id is the
    smallest id that links reach. A text with fewer words is one shingle; a null or empty text has none and links with
    nothing. Rows with equal sets are one class from the start and links are sought between classes, so copies cost one
    comparison. Repeated ids are rows of their own. A null id takes part, but is never the smallest. An empty table
    gives an empty one. Only the id and the text are read, so other columns cannot clash. A pair just at the threshold
    is found with probability `recall` in nodes of any depth; a more similar one is missed still more rarely. Equal sets are
    those whose two 64-bit hashes are equal.
    """
    out = _grouped(docs, id_col, text_col, width, percent, recall)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, recall: float = RECALL) -> DataFrame:
    """docs, with all their columns, but for all rows of each component except its first, by id (nulls last), then by a
    hash of the text; of rows equal in both any one stays. Rows without words are all left. A row goes for its own text
    alone, whatever rows share its id."""
    rows = stored(_grouped(docs, id_col, text_col, width, percent, recall).where("leader IS NOT NULL"), f"{shared_dir(docs.sparkSession)}/grouped")
    first = (F.col("leader.copy") == F.col("copy")) & F.col("leader.id").eqNullSafe(F.col("id"))
    key = F.struct("id", "copy")

    def listed(some: DataFrame, name: str) -> DataFrame:
        some = stored(some, f"{shared_dir(docs.sparkSession)}/{name}")
        return F.broadcast(some) if some.count() <= BROADCAST_IDS else some

    gone = listed(rows.where(~first).select(key.alias("__gone")).distinct(), "gone")
    left = docs.join(gone, row_key(id_col, text_col) == F.col("__gone"), "left_anti")
    twice = rows.where(first).groupBy(key.alias("__twice")).agg(F.count("*").alias("__n")).where("__n > 1").select("__twice")
    twice = listed(twice, "twice")
    if twice.isEmpty():
        return left
    same = row_key(id_col, text_col) == F.col("__twice")
    once = left.join(twice, same).dropDuplicates(["__twice"]).select(*(left["`" + c.replace("`", "``") + "`"] for c in docs.columns))
    return left.join(twice, same, "left_anti").unionByName(once)


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, percent=85)


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT doc_id, n AS n_shingles, root AS component_id, doc_id = root AS kept FROM n JOIN m ON m.id = doc_id
"""
