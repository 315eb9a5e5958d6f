"""Corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
to the shared folder and gives the next stage what it reads back. All stages but the last
return the columns of their input, so they can be left out or reordered. ORACLE_SQL is None:
the stages rest on hashed counts, approximate candidates and a tokenizer, which SQL does not
express; tests hold them against brute-force versions.

Defined results, for every stage: a null text is empty, other nulls and further columns, whatever
their names, are kept as they are, an empty table gives no rows, whole texts of any length are read.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskline.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from riskline.llm.common import table
from riskline.session import prepare, scratch_root


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio, both fitted on ``docs``.

    An empty text fails (fewer than 50 words); equal rows get equal verdicts; labels of ids that are
    null or not there count for nothing, and without labelled documents every ratio is 1."""
    prepare(spark)
    return quality_rules.filtered(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line already has, up to two edits.

    The first line of a class by (doc_id, line number) stays, a null id comes first, equal ids with
    other texts are ordered by a hash of the text, equal rows are one document and change alike.
    Blank lines stay; a document whose lines all go goes with them, one without any line stays."""
    prepare(spark)
    return line_dedup.deduplicated(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of equal rows one stays; documents without words are linked with nothing and stay."""
    prepare(spark)
    return near_dedup.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' targets take them: never, once or twice.

    A null source is a source; documents without words are never taken; which of equally good
    documents are taken hangs on a seeded hash, so reruns agree."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and places.

    An empty text is one piece, its end token; equal rows are packed each; null ids stay null."""
    import public_tokenizers

    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    folder = f"{scratch_root(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
