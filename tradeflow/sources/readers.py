"""Readers: one ``SourceSpec`` per table, any Spark data source.

The source system's connectors (a relational database over JDBC, a document
store, a warehouse) are reached through ``format`` and ``options`` supplied by
the caller; credentials never live in this repository. Tests use parquet and
JSON. Every read declares its schema, so nothing is inferred at scale.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import schemas


@dataclass(frozen=True)
class SourceSpec:
    """Where a table lives: ``format`` + ``path`` or ``options``.

    For JDBC pass ``options={"url": ..., "dbtable": ..., "partitionColumn": ...,
    "lowerBound": ..., "upperBound": ..., "numPartitions": ...}`` so the scan
    is split into parallel range reads; filters and column lists are pushed
    into the database by Spark.
    """

    format: str = "parquet"
    path: str | None = None
    options: dict = field(default_factory=dict)
    schema_ddl: str | None = None


def read(spark: SparkSession, spec: SourceSpec, columns: Sequence[str] | None = None) -> DataFrame:
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema_ddl and spec.format not in ("jdbc",):
        reader = reader.schema(spec.schema_ddl)
    df = reader.load(spec.path) if spec.path else reader.load()
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, name: str, spec: SourceSpec, collated: bool = False) -> DataFrame:
    """Read a canonical table with its declared schema and only its columns.
    With ``collated`` its text columns compare as the source's do
    (:func:`schemas.collated`)."""
    sch = schemas.schema(name)
    spec2 = SourceSpec(spec.format, spec.path, spec.options, spec.schema_ddl or schemas.ddl(name))
    df = read(spark, spec2, [f.name for f in sch.fields])
    return schemas.collated(df) if collated else df


def read_named(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """S5 a table of the warehouse by its name."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_json_lines(spark: SparkSession, path: str, schema_ddl: str, mode: str = "FAILFAST") -> DataFrame:
    """S4 newline-delimited JSON with a declared schema; a malformed line
    fails the load instead of being dropped silently."""
    return spark.read.schema(schema_ddl).option("mode", mode).json(path)


def checked_json_lines(spark: SparkSession, path: str, schema_ddl: str) -> DataFrame:
    """S4 newline-delimited JSON that may hold bad lines: the declared fields,
    ``_reject`` (the line's text where it does not fit the schema, else null)
    and ``_file`` (where it stands). Blank lines are no rows, as for a JSON
    reader. One pass, parsed by Spark; nothing is dropped."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")).where(F.trim("value") != "")
    parsed = F.from_json("value", schema_ddl + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.withColumn("_row", parsed)
    bad = F.col("_row").isNull() | F.col("_row._corrupt").isNotNull()
    fields = StructType.fromDDL(schema_ddl).fieldNames()
    return rows.select(*[F.when(~bad, F.col(f"_row.`{f}`")).alias(f) for f in fields],
                       F.when(bad, F.col("value")).alias("_reject"), "_file")


def load_json_lines(spark: SparkSession, path: str, schema_ddl: str, target: str, rejects: str) -> DataFrame:
    """S4+K7 load with rejects: rows that fit go to ``target`` (Parquet), lines
    that do not to ``rejects`` with their file. Returns the counts per file:
    _file, n_loaded, n_rejected. The text is parsed once: both writes read the
    parsed rows from ``target``'s staging folder."""
    parsed = checked_json_lines(spark, path, schema_ddl)
    staging = target.rstrip("/") + "__parsed"
    parsed.write.mode("overwrite").parquet(staging)
    kept = spark.read.schema(parsed.schema).parquet(staging)
    kept.where("_reject IS NULL").drop("_reject", "_file").write.mode("overwrite").parquet(target)
    kept.where("_reject IS NOT NULL").select("_file", F.col("_reject").alias("line")).write.mode("overwrite").parquet(rejects)
    return kept.groupBy("_file").agg(F.count_if(F.col("_reject").isNull()).alias("n_loaded"),
                                     F.count_if(F.col("_reject").isNotNull()).alias("n_rejected"))


#: Quoted text, names and comments of a query, or a marker outside them.
_MARKERS = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/|(\?)""", re.S)


def bound_sql(spark: SparkSession, text: str, args: Sequence, **tables: DataFrame) -> DataFrame:
    """S6 a query text with positional ``?`` markers, bound by Spark: an
    argument is a value, never text of the query. ``{name}`` in the text stands
    for the frame given by that name.

    The markers are numbered and bound by name, as Spark 4.1 mixes up five or
    more positional arguments. Dates and times are best given as text and cast
    in the query, so that no machine's time zone has a say.
    """
    names = iter(range(len(args) + 1))
    numbered = _MARKERS.sub(lambda m: f":arg{next(names)}" if m.group(1) else m.group(), text)
    used = len(re.findall(r":arg\d+", numbered))
    if used != len(args):
        raise ValueError(f"the query has {used} markers, {len(args)} arguments were given")
    return spark.sql(numbered, args={f"arg{i}": v for i, v in enumerate(args)}, **tables)


def slices_overlap(slices: Sequence[tuple]) -> bool:
    s = sorted(slices)
    return any(s[i][1] >= s[i + 1][0] for i in range(len(s) - 1))


def sliced_scan(df: DataFrame, column: str, slices: Sequence[tuple], extra: Column | None = None,
                observe: bool = False):
    """S3/U1 read closed ranges ``[lo, hi]`` of ``column`` and append them.

    Disjoint slices are one scan with an OR of ranges: Spark pushes it into
    the source and reads each row once. Overlapping slices keep the
    append's bag semantics with a union of separate scans. With
    ``observe=True`` the per-slice row counts are collected as the data is
    written (K9), as ``(df, Observation)``.
    """
    c = F.col(column)
    preds = [(c >= F.lit(lo)) & (c <= F.lit(hi)) for lo, hi in slices]
    if slices_overlap(slices):
        parts = [df.where(p if extra is None else p & extra) for p in preds]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
    else:
        cond = preds[0]
        for p in preds[1:]:
            cond = cond | p
        out = df.where(cond if extra is None else cond & extra)
    if not observe:
        return out
    # Each row counts for the slice whose read it came from: overlapping
    # slices are separate reads, so they are told apart by a read number.
    obs = Observation("slices")
    if slices_overlap(slices):
        tagged = [df.where(p if extra is None else p & extra).withColumn("_slice", F.lit(i)) for i, p in enumerate(preds)]
        out = tagged[0]
        for p in tagged[1:]:
            out = out.unionByName(p)
        counts = [F.count_if(F.col("_slice") == i).alias(f"slice_{i}") for i in range(len(slices))]
        return out.observe(obs, F.count(F.lit(1)).alias("rows"), *counts).drop("_slice"), obs
    counts = [F.count_if(p).alias(f"slice_{i}") for i, p in enumerate(preds)]
    return out.observe(obs, F.count(F.lit(1)).alias("rows"), *counts), obs
