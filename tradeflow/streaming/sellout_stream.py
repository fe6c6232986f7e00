"""Incremental sell-out ingest on Structured Streaming.

The batch job (``plans.sellout``) reloads whole date slices on every run.
When store documents land as newline-delimited JSON files, the same filter
and cleaning can run incrementally: each new file is read once, cleaned with
the same column expressions, and appended to a parquet table with
exactly-once bookkeeping in a checkpoint on shared storage. A lost executor
only re-runs its micro-batch; a restarted query resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.sellout import clean_documents, project_documents
from ..session import ensure_checkpoint_dir
from ..sources import schemas


def sell_out_stream(spark: SparkSession, landing_dir: str, channels,
                    date_range: tuple[str, str] | None = None, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of cleaned sell-out documents from a landing
    folder of NDJSON files (declared schema, malformed lines fail the batch)."""
    raw = (spark.readStream.schema(schemas.SELL_OUT_RAW_DDL).option("mode", "FAILFAST")
           .option("maxFilesPerTrigger", max_files_per_trigger).json(landing_dir))
    docs = project_documents(raw).where(F.col("channel_name").isin(list(channels)))
    if date_range is not None:
        docs = docs.where((F.col("date_") >= F.lit(date_range[0])) & (F.col("date_") <= F.lit(date_range[1])))
    return clean_documents(docs)


def start_sell_out_ingest(stream: DataFrame, table_dir: str, checkpoint_dir: str | None = None,
                          available_now: bool = True, query_name: str = "sell_out_ingest") -> StreamingQuery:
    """Append the cleaned documents to ``table_dir`` (parquet, partitioned by
    month of ``date_``). The checkpoint defaults to a child of the session's
    ``spark.checkpoint.dir``."""
    spark = stream.sparkSession
    ckpt = checkpoint_dir or ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{query_name}"
    out = stream.withColumn("month", F.date_format("date_", "yyyy-MM"))
    w = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
         .option("path", table_dir).partitionBy("month").queryName(query_name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
