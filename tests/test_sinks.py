"""Sinks and readers: loads by column name, verified publish, named tables."""

import os
import tempfile
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from tradeflow.sources import readers, sinks


@pytest.fixture
def name(spark):
    n = "t_" + uuid.uuid4().hex[:12]
    yield n
    for t in spark.catalog.listTables():
        if t.name.startswith(n):
            spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS {t.name}")


def _root():
    return tempfile.mkdtemp(prefix="tradeflow-sink-")


def test_ensure_table_declared_and_from_frame(spark, name):
    root = _root()
    sinks.ensure_table(spark, name, "a int, b string", location=root + "/x")
    sinks.ensure_table(spark, name, "z int")                       # already there: untouched
    assert spark.table(name).columns == ["a", "b"]
    other = name + "f"
    df = spark.createDataFrame([(1, 2.5)], "k int, v double")
    sinks.ensure_table(spark, other, df.schema, location=root + "/y", partition_by=["k"])
    assert set(spark.table(other).columns) == {"k", "v"} and spark.table(other).count() == 0
    spark.sql(f"DROP TABLE {other}")


def test_overwrite_matches_columns_by_name(spark, name):
    sinks.ensure_table(spark, name, "a int, b int", location=_root() + "/x")
    sinks.overwrite_table(spark.createDataFrame([(2, 1)], "b int, a int"), name, partitions=3)
    assert [(r.a, r.b) for r in spark.table(name).collect()] == [(1, 2)]
    sinks.overwrite_table(spark.createDataFrame([(7, 8), (9, 9)], "a int, B int"), name)
    assert sorted((r.a, r.b) for r in spark.table(name).collect()) == [(7, 8), (9, 9)]
    for bad in ("a int", "a int, b int, c int"):
        row = tuple(range(len(bad.split(","))))
        with pytest.raises(ValueError):
            sinks.overwrite_table(spark.createDataFrame([row], bad), name)
    assert spark.table(name).count() == 2                          # a load that does not fit leaves the table


def test_second_partitioned_publish_serves_the_new_version(spark, name):
    root = _root()
    one = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "v int, month string")
    two = spark.createDataFrame([(3, "2024-02"), (4, "2024-03"), (5, "2024-03")], "v int, month string")
    sinks.publish_versioned(one, name, root, partition_by=["month"])
    info = sinks.publish_versioned(two, name, root, partition_by=["month"])
    assert sorted(r.v for r in spark.table(name).collect()) == [3, 4, 5] and info["rows"] == 3
    with pytest.raises(RuntimeError, match="left unchanged"):
        sinks.publish_versioned(one, name, root, partition_by=["month"], expected_rows=9)
    assert sorted(r.v for r in readers.read_named(spark, name, ["v"]).collect()) == [3, 4, 5]


@pytest.mark.parametrize("partition_by", [None, ["month"]])
@pytest.mark.parametrize("step", ["counted_write", "_register", "_publish", "after _register", "after _publish"])
def test_a_fault_at_any_step_leaves_the_old_rows_or_the_new(spark, name, monkeypatch, partition_by, step):
    root = _root()
    one = spark.createDataFrame([(1, "2024-01"), (2, None)], "v int, month string")
    two = spark.createDataFrame([(3, "2024-02"), (4, "a b/c=d"), (5, None)], "v int, month string")
    sinks.publish_versioned(one, name, root, partition_by=partition_by)
    real, what = getattr(sinks, step.split()[-1]), step.split()[-1]

    def broken(*args, **kw):
        if step.startswith("after"):
            real(*args, **kw)
        raise OSError("the driver is lost here")
    monkeypatch.setattr(sinks, what, broken)
    with pytest.raises(OSError):
        sinks.publish_versioned(two, name, root, partition_by=partition_by)
    want = [3, 4, 5] if step == "after _publish" else [1, 2]
    assert sorted(r.v for r in spark.table(name).collect()) == want
    monkeypatch.undo()
    sinks.publish_versioned(two, name, root, partition_by=partition_by)         # and the next load works
    assert sorted((r.v, r.month or "") for r in spark.table(name).collect()) == [(3, "2024-02"), (4, "a b/c=d"), (5, "")]


def test_readers_during_publishes_see_whole_versions(spark, name):
    root, seen, stop = _root(), set(), threading.Event()
    loads = [spark.range(n * 100, n * 100 + 50).select("id", (F.col("id") % 3).alias("part")) for n in range(4)]
    sinks.publish_versioned(loads[0], name, root, partition_by=["part"])

    def read():
        while not stop.is_set():
            seen.add(tuple(sorted(r.id for r in spark.table(name).collect())))
    reader = threading.Thread(target=read)
    reader.start()
    for load in loads[1:]:
        sinks.publish_versioned(load, name, root, partition_by=["part"])
    stop.set()
    reader.join()
    assert seen <= {tuple(range(n * 100, n * 100 + 50)) for n in range(4)} and seen


def test_versions_are_kept_until_dropped(spark, name):
    root = _root()
    made = [sinks.publish_versioned(spark.range(n + 1), name, root, version=f"2024010{n}") for n in range(4)]
    assert sinks.published_version(spark, name) == "20240103" and len(sinks.versions(spark, name)) == 4
    held = spark.table(f"{name}__v20240100")                       # a reader of an old version
    assert sinks.drop_old_versions(spark, name, keep=2) == ["20240100", "20240101"]
    assert held.count() == 1 and spark.table(name).count() == 4 and made[3]["rows"] == 4
    spark.sql(f"CREATE TABLE {name}_plain (v int) USING parquet")
    with pytest.raises(ValueError, match="not a published view"):
        sinks.publish_versioned(spark.range(1), name + "_plain", root)


def test_bucketed_tables_join_without_a_shuffle(spark, name):
    lines = spark.range(1000).select((F.col("id") % 97).alias("k"), "id")
    heads = spark.range(97).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    a = sinks.store_bucketed(lines, name, ["k"], 4, _root() + "/a")
    b = sinks.store_bucketed(heads, name + "_h", ["k"], 4, _root() + "/b")
    j = a.join(b.hint("merge"), "k")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert j.count() == 1000 and all(r.v == 2 * r.k for r in j.collect())
    grouped = a.groupBy("k").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString() and grouped.count() == 97


def test_json_lines_round_trip_and_malformed(spark):
    path = os.path.join(_root(), "j")
    sinks.write_json_lines(spark.createDataFrame([(1, "x"), (2, None)], "a int, b string"), path)
    assert sorted(r.a for r in readers.read_json_lines(spark, path, "a int, b string").collect()) == [1, 2]
    with open(os.path.join(path, "extra.json"), "w") as f:
        f.write("{broken\n")
    with pytest.raises(Exception):
        readers.read_json_lines(spark, path, "a int, b string").collect()


def test_read_table_uses_declared_schema(spark):
    path = _root() + "/w"
    spark.createDataFrame([("W1", "North", "O1", 5)],
                          "szWorkplaceId string, szName string, szSalesOrgId string, other int").write.parquet(path)
    df = readers.read_table(spark, "workplace", readers.SourceSpec(path=path))
    assert "other" not in df.columns and df.collect()[0].szName == "North"
