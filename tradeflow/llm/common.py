"""Small helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.session import ensure_checkpoint_dir

#: The white space of the word rule ``[^\x20\x09-\x0D]+``, as characters and as a pattern.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Spark's setting by which a query's shuffle files are removed at its end.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_of(col: Column | str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def without_spaces(text: Column) -> Column:
    """The text with every white-space character deleted."""
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    """The words of a text; an empty array if it has none."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, *, free_shuffles: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not a recompute.
    With ``free_shuffles`` the write's own shuffle files go when it is done,
    and not when the driver happens to collect garbage.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    writer = df.write.option("compression", compression) if compression else df.write
    before = spark.conf.get(FREE_SHUFFLES, None)
    if free_shuffles:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        writer.parquet(path)
    finally:
        if free_shuffles:
            spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove the files of :func:`saved` tables once no later step reads them, not even to recompute."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.saved_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def row_ids(df: DataFrame) -> Column:
    """A number for each row of a stored table, by split and place, that later jobs on the same table repeat.

    Small files are split by the number of cores at the time of planning,
    which changes when executors come or go; the session is held to the
    number that it has now.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def kept_in_worker() -> dict:
    """A dict that lives as long as the Python worker, which Spark uses for many tasks."""
    return sys.modules.setdefault("_tradeflow_worker", types.ModuleType("_tradeflow_worker")).__dict__


def one_row(df: DataFrame) -> tuple:
    """The single row of a global aggregate."""
    return tuple(df.first())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranked(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """``df`` with its zero-based place in ``order``, without a global window.

    Rows are range-partitioned and counted in each partition; only one row
    per partition takes part in the running total. Give an order that splits
    large ties.
    """
    parts = saved(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn(rank, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranked")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row per partition of the write above.
    return (parts.join(F.broadcast(starts), "_part")
            .withColumn(rank, F.col(rank) + F.col("_start")).drop("_part", "_start"))
