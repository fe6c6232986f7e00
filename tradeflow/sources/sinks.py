"""Sinks: ensure, overwrite, stage, verify and publish tables.

The source jobs clear a warehouse table and then append to it, which leaves
an empty table while the load runs and hides a failed chunk. Here a load
writes a new versioned folder, checks its row count against the count
observed while writing, registers the folder as a table of its own (with its
partitions) and counts once more through that table. Only then is the
published name, a view, pointed at the new version, by one statement: a
reader sees the old version or the new one, and a failure before or after
the statement leaves one of the two. Spark's write tasks are the "parallel
chunks"; a failed task fails the job loudly and is retried on another
executor.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def ensure_table(spark: SparkSession, name: str, schema: StructType | str, location: str | None = None,
                 fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """K1/K2 create the table with a declared schema if it is missing."""
    if spark.catalog.tableExists(name):
        return
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({ddl}) USING {fmt}"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def by_table_columns(df: DataFrame, name: str) -> DataFrame:
    """``df`` with its columns in the order of table ``name``; a missing or
    extra column is an error. ``insertInto`` goes by position, so a load must
    pass through here."""
    want = df.sparkSession.table(name).columns
    have = {c.lower(): c for c in df.columns}
    missing, extra = [c for c in want if c.lower() not in have], set(have) - {c.lower() for c in want}
    if missing or extra or len(have) != len(df.columns):
        raise ValueError(f"columns of the load do not fit {name}: missing {missing}, extra {sorted(extra)}")
    return df.select(*[F.col(f"`{have[c.lower()]}`").alias(c) for c in want])


def overwrite_table(df: DataFrame, name: str, partitions: int | None = None) -> None:
    """K3/K4 replace the table contents in one write (no delete-then-append
    window), matching columns by name. ``partitions`` sets the number of
    parallel write tasks (K5)."""
    out = df.repartition(partitions) if partitions else df
    if df.sparkSession.catalog.tableExists(name):
        by_table_columns(out, name).write.mode("overwrite").insertInto(name, overwrite=True)
    else:
        out.write.mode("overwrite").saveAsTable(name)


def write_json_lines(df: DataFrame, path: str) -> None:
    """K6 staging file as newline-delimited JSON, one file per task."""
    df.write.mode("overwrite").json(path)


def counted_write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> int:
    """K7/K9 write and return the number of rows written, observed during the
    write itself (no second pass over the data)."""
    obs = Observation("written")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


def store_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, location: str | None = None) -> DataFrame:
    """K1 a table dealt into ``buckets`` by ``keys`` and sorted by them in each
    file. Tables of equal buckets join and group on these keys without a
    shuffle. The rows are dealt once before the write, so there is one file a
    bucket. Returns the stored table."""
    writer = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys))
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def publish_versioned(df: DataFrame, name: str, root: str, fmt: str = "parquet",
                      partition_by: list[str] | None = None, expected_rows: int | None = None,
                      version: str | None = None) -> dict:
    """K7+K8 stage into ``root/v=<version>``, verify, register, then publish as
    ``name``, a view over the version.

    ``root`` must be shared storage (the cluster's checkpoint or warehouse
    folder), never a machine-local folder. Earlier versions stay until
    :func:`drop_old_versions`, so a reader that holds one keeps it. Returns
    the version and counts.
    """
    spark = df.sparkSession
    version = version or time.strftime("%Y%m%dT%H%M%S") + f"{int(time.time() * 1e6) % 1000000:06d}"
    path = f"{root.rstrip('/')}/v={version}"
    written = counted_write(df, path, fmt, partition_by)
    own = f"{name}__v{version}"
    _register(spark, own, df.schema, path, fmt, partition_by)
    served = spark.table(own).count()
    if served != written or (expected_rows is not None and written != expected_rows):
        spark.sql(f"DROP TABLE IF EXISTS {_ident(own)}")
        raise RuntimeError(f"staged load of {name} has {served} rows, wrote {written}, "
                           f"expected {expected_rows}; table left unchanged")
    _publish(spark, name, own, df.columns)
    return {"table": name, "version": version, "path": path, "rows": written}


def _register(spark: SparkSession, own: str, schema: StructType, path: str, fmt: str, partition_by: list[str] | None) -> None:
    """The folder ``path`` as an external table ``own``, partitions included. Nothing reads it by name yet."""
    ensure_table(spark, own, schema, location=path, fmt=fmt, partition_by=partition_by)
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_ident(own)}")


def _publish(spark: SparkSession, name: str, own: str, columns: list[str]) -> None:
    """Point the view ``name`` at table ``own``. ``ALTER VIEW`` is one change of
    one catalog entry; ``CREATE OR REPLACE`` would drop the entry first."""
    query = f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {_ident(own)}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE VIEW {_ident(name)} AS {query}")
    elif spark.catalog.getTable(name).tableType == "VIEW":
        spark.sql(f"ALTER VIEW {_ident(name)} AS {query}")
    else:
        raise ValueError(f"{name} is a table, not a published view; rename it before publishing under its name")


def published_version(spark: SparkSession, name: str) -> str:
    """The version that ``name`` shows now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(name)}").where(F.col("col_name") == "View Text").collect()
    return rows[0]["data_type"].split(" FROM ")[-1].strip("` ").rsplit("__v", 1)[1]


def versions(spark: SparkSession, name: str) -> list[str]:
    """Registered versions of ``name``, oldest first."""
    db, _, short = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES {f'IN {_ident(db)} ' if db else ''}LIKE '{short}__v*'").collect()
    return sorted(r.tableName.rsplit("__v", 1)[1].upper() for r in rows)


def drop_old_versions(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Forget all but the ``keep`` newest versions; the one that is shown always stays. The tables are external: their
    folders are left for the storage's owner to clear. Returns the versions forgotten."""
    shown = published_version(spark, name).upper()
    old = [v for v in versions(spark, name)[:-keep] if v != shown]
    for v in old:
        spark.sql(f"DROP TABLE IF EXISTS {_ident(f'{name}__v{v}')}")
    return old
