"""A training-text pipeline over ``documents``: each stage is one operator of ``tradeflow.llm``.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a frame, which is written as Parquet and reread as the next
stage's ``docs``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradeflow.llm import bpe_codec, entropy_mix, exact_dedup, quality_llr, simhash_pivots
from tradeflow.llm.common import saved, table
from tradeflow.llm.queries import BPE_RANKS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_llr.keep_good(docs, quality_llr.trusted_sample(table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_pivots.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix of sources asks."""
    return entropy_mix.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and decoded bytes of every row of the mix."""
    return bpe_codec.encode_decode(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("simhash near-dedup", near),
          ("mixing sources", mix), ("byte-level bpe", tokens)]

#: Fingerprints, mixing by hash order and token ids cannot be said in DuckDB SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
