"""A training corpus from ``documents``: language, quality, copies, packing.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's ``docs``. All stages but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimforge.llm import bytelang, packing, quality, simhash
from dimforge.llm.common import materialise, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or a recognised language go."""
    return bytelang.drop_unidentified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines above the limit go, and documents that fail the base rules or keep
    too little."""
    return quality.apply_line_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what is left, as pieces."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False).drop("ids")


STAGES = [("language", language), ("quality", quality_rules), ("simhash", near_duplicates), ("packing", pack)]
# Fingerprints, the network and the tokenizer have no SQL form; the stages are
# tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs, f"stage-{name}")
    return docs
