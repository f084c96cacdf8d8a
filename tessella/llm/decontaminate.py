"""Benchmark decontamination by SimHash over item-sized windows.

A window of a document with as many words as a benchmark item gets a 64-bit SimHash of its five-word shingles. A
multi-index of Hamming blocks finds every window within RADIUS bits of an item: of BLOCKS blocks at least one differs in
at most RADIUS // BLOCKS bits, and the index holds all such neighbours of each block. Candidates are verified by the
exact weighted similarity, the sum of the smaller over the sum of the larger shingle counts. A window reaches the
similarity with an item only if enough of its places hold shingles of items of its length, in whatever order: every window
that covers so many is fingerprinted, and no other could be found. Which items a window is near is for the Hamming index
to say. All of it is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remove_but, row_key, shared_dir, stored
from .quality import let

WIDTH = 5
PERCENT = 80
#: Sets of similarity 0.8 differ in 10 of 64 bits on average, with a deviation of 3.
RADIUS = 20
BLOCKS = 8
#: Rows of item shingles or of the index that are broadcast at most, by count; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: Ids that are broadcast at most, by count; beyond it a join shuffles.
BROADCAST_IDS = 1 << 20
_BITS = 64 // BLOCKS

_WORDS = r"array_remove(split(lower(coalesce({t}, '')), '[ \u0009-\u000D]+'), '')"
_FINGERPRINT = "aggregate(sequence(0, 63), 0L, (f, b) -> CASE WHEN 2 * aggregate({s}, 0, (n, h) -> n + CAST(shiftright(h, b) & 1 AS INT)) > size({s}) THEN f | shiftleft(1L, b) ELSE f END)"


def _shingles(o: str, m: str, k: int) -> str:
    parts = ", ".join(f"w[p + {i}]" if i else "w[p]" for i in range(k))
    return f"transform(sequence({o}, {o} + {m} - {k}), p -> xxhash64({parts}))"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


#: The sum of the smaller counts of two lists of shingles: both in one order, each value's difference added up in one pass.
_COMMON = (
    "(size({s}) + size({t}) - aggregate(array_sort(concat(transform({s}, h -> struct(h AS h, 1 AS d)), transform({t}, h -> struct(h AS h, -1 AS d)))), "
    "named_struct('h', CAST(NULL AS BIGINT), 'run', 0, 'apart', 0), (z, x) -> named_struct('h', x.h, 'run', CASE WHEN z.h = x.h THEN z.run + x.d ELSE x.d END, "
    "'apart', CASE WHEN z.h = x.h THEN z.apart ELSE z.apart + abs(z.run) END), z -> z.apart + abs(z.run))) DIV 2"
)


def _scored(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, percent: int, radius: int) -> DataFrame | None:
    """(id, item, o, similarity) of all similar windows, where id is its row_key(); None if no item has a word."""
    spark = docs.sparkSession
    path = shared_dir(spark)
    items = benchmark.select(F.col(item_col).alias("item"), F.expr(_WORDS.format(t=f"CAST({_quoted(item_text)} AS STRING)")).alias("w")).where("size(w) > 0")
    items = items.select("item", "w", F.expr("size(w)").alias("m"), F.least(F.lit(WIDTH), F.size("w")).alias("k"))
    widths = sorted(r[0] for r in items.select("k").distinct().collect())  # 1 to 5
    if not widths:
        return None
    own = F.lit(None)
    for k in widths:
        own = F.when(F.col("k") == k, F.expr(_shingles("0", "m", k))).otherwise(own)
    items = items.select("item", "m", "k", own.cast("array<bigint>").alias("s")).withColumn("f", F.expr(_FINGERPRINT.format(s="s"))).withColumn("row", F.monotonically_increasing_id())
    items = stored(items, f"{path}/items")
    grams = stored(items.select("m", "k", F.explode("s").alias("h")).distinct(), f"{path}/grams")
    n_grams = grams.count()
    words = _WORDS.format(t=f"CAST({_quoted(text_col)} AS STRING)")
    slim = docs.select(row_key(id_col, text_col).alias("id"), F.explode(F.array(F.expr(words))).alias("w"))

    # The places of a document whose shingle some item of m words has.
    hits = None
    for k in widths:
        body = let("w", "w", f"CASE WHEN size(w) < {k} THEN CAST(array() AS array<bigint>) ELSE {_shingles('0', 'size(w)', k)} END")
        found = slim.select("id", F.size("w").alias("words"), F.posexplode(F.expr(body)).alias("p", "h"))
        found = found.join(_small(grams.where(F.col("k") == k), n_grams), "h").select("id", "words", "m", "k", "p")
        hits = found if hits is None else hits.unionByName(found)

    # A window has n shingles, as many as the item or the whole document. Each run of as many places as the similarity needs
    # gives the offsets whose window covers it; those that the run before it covers too are left to that one.
    places = hits.groupBy("id", "words", "m", "k").agg(F.sort_array(F.collect_set("p")).alias("p"))
    places = places.withColumn("n", F.least("m", "words") - F.col("k") + 1)
    places = places.withColumn("need", F.greatest(F.lit(1), F.ceil((F.lit(percent) * (F.col("m") - F.col("k") + 1 + F.col("n"))) / F.lit(100 + percent)).cast("int"))).where("size(p) >= need")
    low = "greatest(0, p[i + need - 1] - n + 1, CASE WHEN i > 0 THEN p[i - 1] + 1 ELSE 0 END)"
    spans = f"filter(transform(sequence(0, size(p) - need), i -> struct({low} AS a, least(p[i], words - least(m, words)) AS b)), x -> x.a <= x.b)"
    spans = places.select("id", "m", "k", F.expr(spans).alias("spans")).where("size(spans) > 0")
    spans = stored(spans.groupBy("id").agg(F.collect_list(F.struct("m", "k", "spans")).alias("x")), f"{path}/spans")

    def texts_of(some: DataFrame) -> DataFrame:
        """some (id, x) with the words of the rows that have the ids."""
        kept = F.broadcast(some.select("id")) if some.count() <= BROADCAST_IDS else some.select("id")
        return docs.select(row_key(id_col, text_col).alias("id"), F.expr(f"CAST({_quoted(text_col)} AS STRING)").alias("t")).join(kept, "id", "left_semi").join(some, "id")

    def shingles_at(o: str, m: str, k: str) -> str:
        return "CASE " + " ".join(f"WHEN {k} = {j} THEN {_shingles(o, f'least({m}, size(w))', j)}" for j in widths) + " END"

    # The windows' fingerprints.
    each = f"transform(flatten(transform(y.spans, z -> sequence(z.a, z.b))), o -> struct(y.m AS m, y.k AS k, o AS o, {let(shingles_at('o', 'y.m', 'y.k'), 'ws', _FINGERPRINT.format(s='ws'))} AS wf))"
    prints = texts_of(spans).select("id", F.explode(F.expr(let(_WORDS.format(t="t"), "w", f"flatten(transform(x, y -> {each}))"))).alias("v")).select("id", "v.*")
    prints = stored(prints, f"{path}/prints")

    # The index: for each item and block all values that differ in few enough bits. A window meets every item of its length.
    near = radius // BLOCKS
    index = items.select("row", "m", "f", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    index = index.select("row", "m", "f", "block", F.explode(F.expr(f"filter(sequence(0, {2**_BITS - 1}), v -> bit_count(v ^ CAST(shiftrightunsigned(f, block * {_BITS}) & {2**_BITS - 1} AS INT)) <= {near})")).alias("value"))
    index = stored(index, f"{path}/index")
    probes = prints.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    probes = probes.withColumn("value", F.expr(f"CAST(shiftrightunsigned(wf, block * {_BITS}) & {2**_BITS - 1} AS INT)"))
    close = probes.join(_small(index, index.count()), ["m", "block", "value"]).where(F.bit_count(F.col("wf").bitwiseXOR(F.col("f"))) <= radius)
    close = close.groupBy("id").agg(F.collect_set(F.struct("row", "m", "k", "o")).alias("x"))
    close = stored(close, f"{path}/close")
    remove_but(spark, path, "items", "close")

    # The exact similarity of what is close.
    made = f"transform(x, y -> struct(y.row AS row, y.o AS o, {shingles_at('y.o', 'y.m', 'y.k')} AS ws))"
    both = texts_of(close).select("id", F.explode(F.expr(let(_WORDS.format(t="t"), "w", made))).alias("v")).select("id", "v.*")
    both = both.join(_small(items.select("row", "item", "s"), n_grams), "row")
    scored = both.select("id", "item", "o", F.expr(_COMMON.format(s="s", t="ws")).alias("c"), (F.size("s") + F.size("ws")).alias("n")).where(F.lit(100) * F.col("c") >= F.lit(percent) * (F.col("n") - F.col("c")))
    return scored.select("id", "item", "o", (F.col("c") / (F.col("n") - F.col("c"))).alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(id_col, item_col, first_word, similarity): each document and item with a window at least percent similar.

    The best window is given, the first of equally good ones. Words are lower-cased runs of anything but ASCII white
    space. An item of fewer than five words is one shingle; a document with fewer words than the item is one window. Null
    and empty texts have no words and match nothing. Rows with one id count as one document, so do rows with null ids; items with
    one id count as one item, so do items with null ids. Only ids and texts are read, so other columns cannot clash; either
    table may be empty.
    """
    scored = _scored(docs, benchmark, id_col, text_col, item_col, item_text, percent, radius)
    if scored is None:
        return docs.select(F.col(id_col)).join(benchmark.select(F.col(item_col)).limit(0)).limit(0).select(id_col, item_col, F.lit(0).alias("first_word"), F.lit(0.0).alias("similarity"))
    best = scored.groupBy(F.col("id.id").alias("id"), "item").agg(F.max(F.struct("similarity", (-F.col("o")).alias("o"))).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("best.o")).alias("first_word"), "best.similarity")


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark item; a row goes for its own text alone."""
    scored = _scored(docs, benchmark, id_col, text_col, item_col, item_text, percent, radius)
    if scored is None:
        return docs
    bad = stored(scored.select(F.col("id").alias("__leaked")).distinct(), f"{shared_dir(docs.sparkSession)}/leaked")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_IDS else bad
    return docs.join(bad, row_key(id_col, text_col) == F.col("__leaked"), "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS m, least(5, len(w)) AS k FROM b WHERE len(w) > 0),
ig AS (SELECT item_id, m, k, unnest(list_transform(range(1, m - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS g FROM i),
ic AS (SELECT item_id, g, count(*) AS c FROM ig GROUP BY 1, 2),
dg AS (SELECT doc_id, len(w) AS words, k, unnest(range(0, len(w) - k + 1)) AS p, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS g FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k),
hit AS (SELECT DISTINCT doc_id, words, item_id, m, dg.k, least(m, words) - dg.k + 1 AS n, p FROM dg JOIN (SELECT DISTINCT item_id, m, k, g FROM ig) g ON g.k = dg.k AND g.g = dg.g),
o AS (SELECT DISTINCT doc_id, item_id, m, k, n, unnest(range(greatest(0, p - n + 1), least(p, words - least(m, words)) + 1)) AS o FROM hit),
win AS (SELECT o.doc_id, item_id, m, o.k, n, o, g, count(*) AS c FROM o JOIN dg ON dg.doc_id = o.doc_id AND dg.k = o.k AND p BETWEEN o AND o + n - 1 GROUP BY ALL),
sim AS (SELECT doc_id, item_id, o, m - k + 1 + n AS t, sum(least(win.c, ic.c)) AS c FROM win JOIN ic USING (item_id, g) GROUP BY ALL),
best AS (SELECT doc_id, item_id, o, c / (t - c) AS similarity FROM sim WHERE 100 * c >= 80 * (t - c))
SELECT doc_id, item_id, o::INT AS first_word, similarity FROM best QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, o) = 1
"""
