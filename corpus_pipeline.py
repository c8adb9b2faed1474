"""The corpus pipeline: each stage applies one operator to what the one before it kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from gleanspark.llm.bpe import encode_digest
from gleanspark.llm.common import table, written
from gleanspark.llm.exact_dedup import exact_dedup
from gleanspark.llm.mixing import mix
from gleanspark.llm.simhash import near_dedup
from gleanspark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose expected severity is at least the limit."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose fingerprints of three-word shingles are linked by at most two differing bits."""
    return near_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix says."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode each row that the mix took."""
    import public_tokenizers

    return encode_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mixing), ("bpe", tokens)]

# fingerprints, a fitted model and a tokenizer: not to be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    return reduce(lambda d, i: STAGES[i][1](spark, d if i == 0 else written(d, STAGES[i - 1][0]), sf_dir), range(len(STAGES)), docs)
