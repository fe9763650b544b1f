"""A corpus pipeline: quality, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last give
back the columns of documents, whatever other columns there are and however they are called. Null texts
count as empty ones, null ids and repeated rows are rows like any other, very long texts are taken whole,
and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenvox.llm.common import scratch_path
from lumenvox.llm.exact_dedup import exact_dedup
from lumenvox.llm.mixing import mixed_documents
from lumenvox.llm.packing import packed_documents
from lumenvox.llm.quality import quality_filter
from lumenvox.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is usual for the trusted text of their language.

    Texts without words go; a null or unknown language is judged by all trusted text; a perplexity at the threshold stays.
    """
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id; of rows that share it and the text one."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Fingerprints of the sets of words propose pairs; those with a similarity of five-word shingles of 0.8 or more are linked.
    """
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, up to twice; a null source is a source, texts without words go."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of at most 1024 tokens; a null or empty text is one piece of one token."""
    import public_tokenizers

    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keeps_space=True, end_id=2)


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mixing), ("packing", packing)]

#: SQL can express neither the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
