"""A corpus made ready for training: five stages, each over all rows that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import bpe, decontaminate, line_dedup, near_dup, quality
from tessella.llm.common import RELIEF_KEY, relieve, remove_but, shared_dir, stored

#: Bytes of a worker's table of words and of a slice in the last stage: less than a lone query takes, as the heaps that the
#: stages before it have grown stand beside.
WORD_BYTES = 40 << 20
SLICE_BYTES = 1 << 20
#: Seconds of a stage after which its next write has the executors give back what their heaps have grown by.
RELIEF_SECONDS = 5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def relieved(stage: Stage) -> Stage:
    """The stage, begun on heaps that the stages before it have not left grown, and relieved as it goes."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(RELIEF_KEY, str(RELIEF_SECONDS))
        relieve(spark)
        out = stage(spark, docs, sf_dir)
        relieve(spark)  # the last write is the caller's
        return out

    return run


@relieved
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects: each row by its own text, whatever its id; null and empty texts go."""
    return quality.keep_good(docs)


@relieved
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that their classes keep elsewhere, by rows (id, null or not, and text); rows that lose all
    their words go, rows that had none stay."""
    return line_dedup.without_repeated_lines(docs)


@relieved
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, sets of five-word shingles of similarity 0.8 or more: the first by id (nulls
    last), then text; of equal rows one. Texts without words are all left."""
    return near_dup.without_near_duplicates(docs)


@relieved
def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, each row by its own text; items without words match nothing."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@relieved
def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, rows of one id or of none as rows of their own; a text without words is
    encoded like any other."""
    return bpe.round_trip(docs, remembered=WORD_BYTES, learnt=SLICE_BYTES)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup), ("decontaminate", decontaminate_stage), ("bpe", bpe_round_trip)]
#: The similarity joins and the automaton have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written and read again; a stage's rows go once the next has written."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"{path}/{k}-{name}")
            remove_but(spark, path, f"{k}-{name}")
    return docs
