"""Exact dedup by skew-safe combining.

Texts are equal when they are identical after white space is deleted. Every
combining stage groups by the digest *and* the whole normalised text, so a
digest clash can never merge different texts:

1. local: the map-side half of the salted aggregate keeps one row for each
   text and input partition;
2. salted: those rows meet by ``(digest, text, salt)``, where the salt comes
   from the input partition, so a text that holds a third of all rows is
   spread over ``salts`` groups;
3. global: the at most ``salts`` winners of a text meet.

Only digests and ids travel back to the documents. Documents whose digest
stands for several texts (a clash) are matched by the whole text instead.

Cases: null text counts as empty, and all empty texts are equal. Of equal
texts the one with most code points stays, then the smallest id (null last),
then the first row of the input, so that a repeated row is kept once. Only
the id and text columns are read; other columns cannot clash. An empty table
gives an empty result. Rows are told apart by their position, so the input
must be a stored table or another repeatable frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import free_name, row_ids, saved, text_of, without_spaces


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                salts: int = 64, digest: Callable[[Column], Column] = sha256,
                row: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row_id."""
    text = text_of(text_col)
    rows = (
        docs.select(F.col(id_col).alias("id"), text.alias("text"),
                    (row_ids(docs) if row is None else row).alias("row_id"))
        .select("id", "row_id", F.length("text").alias("length"), without_spaces(F.col("text")).alias("norm"))
        .withColumn("digest", digest(F.col("norm")))
    )
    # Smallest wins: most code points, then an id, the smallest, then the first row.
    rank = F.struct((-F.col("length")).alias("len"), F.col("id").isNull().alias("no_id"),
                    F.col("id"), F.col("row_id"))
    salt = F.pmod(F.shiftright("row_id", 33), F.lit(salts))
    by_salt = rows.groupBy("digest", "norm", salt.alias("salt")).agg(
        F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    texts = by_salt.groupBy("digest", "norm").agg(F.min("best").alias("best"), F.sum("n").alias("n"))

    winners = saved(
        texts.groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("n"),
                                    F.count(F.lit(1)).alias("texts")), "exact-winners")
    keep = [F.col("best.id").alias("keep_id"), F.col("best.row_id").alias("keep_row"), F.col("n")]
    clash = winners.where("texts > 1").select("digest")
    light = rows.select("id", "row_id", "digest", F.sha2("norm", 256).alias("sha"))
    found = light.join(winners.where("texts = 1").select("digest", *keep), "digest").drop("digest")
    if not clash.isEmpty():
        full = rows.withColumn("sha", F.sha2("norm", 256)).join(clash, "digest", "left_semi")
        again = full.join(texts.join(clash, "digest", "left_semi").select("digest", "norm", *keep),
                          ["digest", "norm"])
        found = found.unionByName(again.select("id", "row_id", "sha", "keep_id", "keep_row", "n"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
        (F.col("row_id") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"), "row_id")


def keep_first_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops, all columns kept."""
    pos = free_name(docs, "row_id")
    kept = exact_dedup(docs, id_col=id_col, text_col=text_col).where("kept").select(F.col("row_id").alias(pos))
    return docs.withColumn(pos, row_ids(docs)).join(kept, pos, "left_semi").drop(pos)
