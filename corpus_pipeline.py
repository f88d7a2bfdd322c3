"""A corpus, from raw documents to token files, in five stages.

Each stage works on all that the one before it kept; ``run`` writes a stage's
result as Parquet under the shared folder and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cursorlake.llm import decontaminate, mixing, near_dup, quality, token_ids
from cursorlake.llm.common import drop_staged, held_out, staged, table, written
from cursorlake.llm.queries import END_ID, MIX_TARGETS, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learnt from the labels of these documents; rows below
    its threshold go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 5))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    return near_dup.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target marginals."""
    return mixing.sample(docs, MIX_TARGETS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; per document, read back from them: doc_id, start, n_tokens,
    ids_crc32."""
    documents, _ = token_ids.token_files(docs, tokenizer_path(), END_ID)
    return token_ids.digests(documents)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mix),
    ("token_ids", tokens),
]

# Boosted and sampled decisions, edit distances and token files are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = written()
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_staged(spark, before)  # the stage's own steps are in its result now
    return docs
