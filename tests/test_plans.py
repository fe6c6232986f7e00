"""Plan-shape guards for every registered query: no cartesian products, a
nested-loop join only where one side is a proven single row, partial
aggregation for the skew-prone operators, filters reaching the scan."""

from tradeflow.plans import catalog as E

SF = "/root/testdata/sf0.001"
SINGLE_ROW_CONSTANT_JOIN = {"settings_const_join"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_and_bounded_nested_loops(spark):
    for name, fn in E.queries().items():
        plan = _plan(fn(spark, SF))
        assert "CartesianProduct" not in plan, name
        if name not in SINGLE_ROW_CONSTANT_JOIN:
            assert "BroadcastNestedLoopJoin" not in plan, name


def test_skew_prone_operators_aggregate_partially(spark):
    for name in ("latest_per_key", "approval_levels", "order_bonus", "invoice_bonus", "fallback_chain"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "partial_" in plan, name
        assert "Window" not in plan or name == "fallback_chain", name


def test_scans_and_exchanges(spark):
    def count(name, what):
        return _plan(E.queries()[name](spark, SF)).count(what)
    assert count("mtd_trend", "Scan parquet") == 1
    assert count("unified_sales", "lineitem.parquet") == 1 and count("stage_pivot", "lineitem.parquet") == 1
    assert count("top_n", "Exchange hashpartitioning") == 2
    # One scan more than a window over an invoice would need; in exchange sums are grouped, and no invoice is one task.
    assert count("invoice_lines", "lineitem.parquet") == 4 and count("net_measures", "lineitem.parquet") == 3
    for name in ("invoice_lines", "ordered_export", "net_measures"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "REPARTITION" not in plan and "Window" not in plan, name
    for name, fn in E.queries().items():
        plan = _plan(fn(spark, SF))
        assert "REPARTITION_BY_NUM" not in plan and "CartesianProduct" not in plan, name


def test_wide_tracking_reads_each_role_once(spark, monkeypatch):
    """Over the written steps and the last plan together, source files only: 23 roles, a scan each."""
    from tradeflow.plans import tracking_gt
    plans, write = [], tracking_gt.written

    def written(df, name):
        plans.append(_plan(df))
        return write(df, name)
    monkeypatch.setattr(tracking_gt, "written", written)
    plans.append(_plan(E.queries()["po_tracking_gt"](spark, SF)))
    scans = {t: sum(p.count(f"{t}.parquet") for p in plans) for t in ("orders", "lineitem", "customer", "part", "events")}
    assert sum(scans.values()) == 23, scans


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = _plan(E.queries()["invoice_lines"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in plan          # period filter at the orders scan
    assert "StringContains(n_name,1)" in plan                           # workplace LIKE at the nation scan
    plan = _plan(E.queries()["sell_out"](spark, SF))
    assert "PushedFilters: [" in plan and "In(event_type" in plan
