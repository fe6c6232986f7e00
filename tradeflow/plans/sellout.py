"""T4 sell-out: store sell-out documents filtered by date slices and channel,
cleaned and published through a staged, verified swap.

The source reads four weekly slices one after another into driver memory,
converts each document in Python, writes a local JSON file, loads it into a
staging table and replaces the final table from it. Here the slices are one
pushed-down scan, the conversion is two column expressions (strict date
parse, object id to text), and the publish writes a new version on shared
storage, checks its count and repoints the table (``sources.sinks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import object_id_text, parse_strict_date
from ..sources import schemas, sinks
from ..sources.readers import read_json_lines, sliced_scan


def project_documents(raw: DataFrame) -> DataFrame:
    """P3 the 19 published fields; a field missing from the source is null."""
    types = dict(f.split(" ", 1) for f in (s.strip() for s in schemas.SELL_OUT_RAW_DDL.split(",")))
    cols = []
    for name in schemas.SELL_OUT_FIELDS:
        t = types[f"`{name}`"]
        cols.append(F.col(f"`{name}`").cast(t).alias(name) if name in raw.columns
                    else F.lit(None).cast(t).alias(name))
    return raw.select(*cols)


def clean_documents(docs: DataFrame) -> DataFrame:
    """E14/E15 object id to text, text date to DATE (bad text to null)."""
    return docs.select(*[
        object_id_text("_id").alias("_id") if c == "_id"
        else parse_strict_date("date_").alias("date_") if c == "date_"
        else F.col(f"`{c}`") for c in docs.columns])


def sell_out(raw: DataFrame, slices, channels, observe: bool = False):
    """T4 filter on the *text* date (inclusive slices) and the channel list,
    then clean. With ``observe=True`` returns ``(df, Observation)`` carrying
    the per-slice counts once the result is written (K9)."""
    docs = project_documents(raw)
    res = sliced_scan(docs, "date_", slices, extra=F.col("channel_name").isin(list(channels)),
                      observe=observe)
    if observe:
        df, obs = res
        return clean_documents(df), obs
    return clean_documents(res)


def publish_sell_out(df: DataFrame, table: str, root: str, staging_json: str | None = None,
                     partition_by: list[str] | None = None) -> dict:
    """K6-K9: optional NDJSON staging copy, then a versioned, verified publish
    of the final table (partitioned by ``partition_by``, e.g. its month)."""
    spark = df.sparkSession
    if staging_json:
        sinks.write_json_lines(df, staging_json)
        df = read_json_lines(spark, staging_json, schemas.SELL_OUT_DDL)
    return sinks.publish_versioned(df, table, root, partition_by=partition_by)
