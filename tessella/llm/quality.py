"""Quality rules as a short-circuit cascade of column expressions.

Each rule is a predicate that rejects. Its cost and its share of rejections are measured on a bounded sample, and the
rules are tried in the order of rejections per cost; a CASE stops at the first rule that rejects. The order changes
what a row costs, never its verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of the sample on which costs and selectivities are estimated, the only thing that is bounded.
SAMPLE_ROWS = 400
#: Code points of a sampled text that are looked at for its cost, so that the sample is bounded in bytes too.
SAMPLE_CHARS = 1 << 14
#: Times that a rule's cost is measured; the least counts.
MEASURED = 3
MIN_WORDS = 50


@dataclass(frozen=True)
class Rule:
    """name, and a SQL predicate over t (the text) and w (its words) that is true of rows to reject."""

    name: str
    rejects: str


def let(value: str, name: str, body: str) -> str:
    """SQL for body with name bound to value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


WORDS = r"array_remove(split(t, '[ \u0009-\u000D]+'), '')"
WORD_CHARS = "aggregate(w, 0L, (a, x) -> a + length(x))"
SYMBOLS = "CAST(regexp_count(t, '[#*$%&|<>]') AS BIGINT)"
LINES = r"filter(split(t, '\n'), x -> x RLIKE '[^ \u0009-\u000D]')"
DUP_LINES = let(LINES, "l", "CAST(size(l) - size(array_distinct(l)) AS BIGINT)")
_WITHIN = "CASE WHEN size(d) = 0 THEN 0L ELSE 3L + aggregate(sequence(1, size(d) - 1), 0L, (a, k) -> a + least(3, d[k] - d[k - 1])) END"


def _same_words(i: str, j: str) -> str:
    return " AND ".join(f"w[{i} {d}] = w[{j} {d}]" for d in ("- 1", "+ 0", "+ 1"))


def _places(s: str, i: str, j: str) -> str:
    return f"sort_array(array_distinct(concat(transform({s}, k -> {i}), transform({s}, k -> {j}))))"


#: Words inside three-word windows that the text has twice or more. Window hashes carry their place in the low bits and
#: are sorted as numbers: n log n for a text, without a shuffle. Neighbours with the same hash are repeats if they have the
#: same words; if any has not, the windows are sorted by their words instead.
_BY_WORDS = let(
    "sort_array(transform(sequence(1, size(w) - 2), i -> named_struct('x', w[i - 1], 'y', w[i], 'z', w[i + 1], 'i', i)))",
    "q",
    let("filter(sequence(0, size(q) - 2), k -> q[k].x = q[k + 1].x AND q[k].y = q[k + 1].y AND q[k].z = q[k + 1].z)", "r", let(_places("r", "q[k].i", "q[k + 1].i"), "d", _WITHIN)),
)
_LOW = "CAST(p[{k}] & (shiftleft(1L, b) - 1) AS INT)"
REPEAT_WORDS = "CASE WHEN size(w) < 4 THEN 0L ELSE " + let(
    "length(bin(size(w)))",
    "b",
    let(
        "sort_array(transform(sequence(1, size(w) - 2), i -> shiftleft(xxhash64(w[i - 1], w[i], w[i + 1]), b) | CAST(i AS BIGINT)))",
        "p",
        let(
            "filter(sequence(0, size(p) - 2), k -> shiftright(p[k] ^ p[k + 1], b) = 0)",
            "s",
            "CASE WHEN size(s) = 0 THEN 0L WHEN forall(s, k -> " + let(_LOW.format(k="k"), "i", let(_LOW.format(k="k + 1"), "j", _same_words("i", "j"))) + ") THEN " + let(_places("s", _LOW.format(k="k"), _LOW.format(k="k + 1")), "d", _WITHIN) + f" ELSE {_BY_WORDS} END",
        ),
    ),
) + " END"
RULES = (
    Rule("symbols", "10 * regexp_count(t, '[#*$%&|<>]') > 3 * size(w)"),
    Rule("capitals", r"10 * regexp_count(t, '[A-ZÀ-Þ]') > 4 * " + WORD_CHARS),
    Rule("digits", "10 * regexp_count(t, '[0-9]') > 4 * " + WORD_CHARS),
    Rule("repeated_lines", let(LINES, "l", "10 * (size(l) - size(array_distinct(l))) > 4 * size(l)")),
    Rule("word_length", let(WORD_CHARS, "c", "c < 2 * size(w) OR c > 15 * size(w)")),
)
BASE_RULES = (Rule("few_words", f"size(w) < {MIN_WORDS}"), Rule("repeated_words", f"100 * {REPEAT_WORDS} > 50 * size(w)"))


def _over(text: str, body: str) -> Column:
    quoted = "`" + text.replace("`", "``") + "`"
    return F.expr(let(f"coalesce(CAST({quoted} AS STRING), '')", "t", let(WORDS, "w", body)))


def order(docs: DataFrame, rules: Sequence[Rule], *, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of sample_rows rows at most (all ties: as listed)."""
    sample = docs.select(F.substring(F.col(text_col).cast("string"), 1, SAMPLE_CHARS).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(16)) == 0).limit(sample_rows)
    sample = docs.sparkSession.createDataFrame(pa.table({"text": pa.array([r[0] for r in sample.collect()], pa.string())}), "text string").repartition(1)
    sample.persist()
    try:
        sample.count()

        def run(body: str) -> tuple[float, int]:
            best, n, query = float("inf"), 0, sample.agg(F.count_if(_over("text", body)))
            for _ in range(MEASURED):
                began = time.perf_counter()
                n = query.first()[0]
                best = min(best, time.perf_counter() - began)
            return best, n

        floor = run("size(w) < 0")[0]
        found = [(r, *run(r.rejects)) for r in rules]
    finally:
        sample.unpersist()
    return [r for r, s, n in sorted(found, key=lambda x: -x[2] / max(x[1] - floor, 1e-3))]


def rejected_by(rules: Sequence[Rule], text_col: str = "text") -> Column:
    """The first rule that rejects a row, else null. CASE leaves the rules after it alone."""
    return _over(text_col, "CASE " + " ".join(f"WHEN {r.rejects} THEN '{r.name}'" for r in rules) + " ELSE CAST(NULL AS STRING) END") if rules else F.lit(None).cast("string")


def keep_good(docs: DataFrame, *, text_col: str = "text", rules: Sequence[Rule] = (*BASE_RULES, *RULES), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that no rule rejects, with all their columns; one filter, no shuffle.

    A null or empty text has no words and goes with the first rule on length. Repeated rows are judged one by one, an
    empty table stays empty, columns of any name pass through. A text's working memory is a few arrays of its words.
    """
    return docs.where(rejected_by(order(docs, rules, text_col=text_col, sample_rows=sample_rows), text_col).isNull())


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Null and empty texts count zero words and fail the base. Only the id is carried over, so other columns cannot clash.
    """
    cascade = order(docs, rules, text_col=text_col, sample_rows=sample_rows)
    verdict = "CASE " + " ".join(f"WHEN {r.rejects} THEN false" for r in cascade) + " ELSE true END"
    failed = f"(size(w) < {MIN_WORDS} OR 100 * r > 50 * size(w))"
    all_of = _over(text_col, let(REPEAT_WORDS, "r", f"named_struct('n_words', CAST(size(w) AS BIGINT), 'word_chars', {WORD_CHARS}, 'n_symbols', {SYMBOLS}, 'n_dup_lines', {DUP_LINES}, 'n_repeat_words', r, 'base_failed', {failed}, 'kept', CASE WHEN {failed} THEN false ELSE {verdict} END)"))
    got = docs.select(F.col(id_col), F.explode(F.array(all_of)).alias("found"))  # a generator: computed once for each row
    return got.select(id_col, "found.n_words", "found.word_chars", "found.n_symbols", "found.n_dup_lines", "found.n_repeat_words", "found.base_failed", "found.kept")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS l FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM w WHERE len(w) >= 3),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win) WHERE k > 1) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(t, '[^A-ZÀ-Þ]', '', 'g')) AS capitals, length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * capitals > 4 * word_chars OR 10 * digits > 4 * word_chars
            OR 10 * n_dup_lines > 4 * n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM b
"""
