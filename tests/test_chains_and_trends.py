"""Chains, lattice, calendar trends, salted attach, source-form joins, collated keys, bound SQL and checked JSON loads on
hand-made rows; the registered queries against DuckDB are the driver's part."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tradeflow.operators import aggregates as A
from tradeflow.operators import chains as C
from tradeflow.operators import joins as J
from tradeflow.operators import lattice as L
from tradeflow.operators import windows as W
from tradeflow.plans import chains_and_trends as Q
from tradeflow.sources import readers, schemas

D = dt.date


def walk(links, key):
    """The end of a chain by hand: (end, steps, in a circle)."""
    seen, steps = {key}, 0
    while key in links and links[key] is not None:
        key, steps = links[key], steps + 1
        if key in seen:
            return None, None, True
        seen.add(key)
    return key, steps, False


def test_follow_equals_walking_on_random_links(spark):
    rng = random.Random(5)
    for n in (1, 7, 60, 400):
        links = {k: rng.choice([None, k, *[rng.randrange(n + 5)] * 6]) for k in range(n)}
        got = C.follow(spark.createDataFrame(list(links.items()), "k long, nxt long"), "k", "nxt").collect()
        assert {r.key: (r.end, r.steps, r.in_cycle) for r in got} == {k: walk(links, k) for k in links}


def test_follow_cases(spark):
    long_chain = [(i, i + 1) for i in range(1000)]
    got = {r.key: r for r in C.follow(spark.createDataFrame(long_chain, "k long, nxt long"), "k", "nxt").collect()}
    assert got[0].end == 1000 and got[0].steps == 1000 and got[999].steps == 1
    odd = [(None, 1), (1, None), (2, 2), (3, 2), (4, 9), (5, 1), (5, 4)]
    got = {r.key: (r.end, r.steps, r.in_cycle) for r in C.follow(spark.createDataFrame(odd, "k long, nxt long"), "k", "nxt").collect()}
    assert got == {1: (1, 0, False), 2: (None, None, True), 3: (None, None, True), 4: (9, 1, False), 5: (9, 2, False)}
    assert C.follow(spark.createDataFrame([], "k long, nxt long"), "k", "nxt").count() == 0


def test_climb_and_last_replacement(spark):
    org = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone"), ("x", "y"), ("y", "x")], "id string, boss string")
    got = {r.id: (r.top, r.levels, r.in_cycle) for r in C.climb_to_top(
        spark.createDataFrame([("c",), ("d",), ("x",), ("none",)], "id string"), "id", org, "id", "boss").collect()}
    assert got == {"c": ("a", 2, False), "d": ("d", 0, False), "x": (None, None, True), "none": (None, None, None)}
    t = lambda d: dt.datetime(2024, 1, d)
    history = spark.createDataFrame([("N1", "O1", t(1)), ("N2", "N1", t(2)), ("N9", "N1", None), ("N3", "N2", t(1)), ("P2", "P1", t(1)),
                                     ("P1", "P2", t(1))], "szDoId string, szDoIdOld string, dtmLastUpdated timestamp_ntz")
    got = {r.hist_old: (r.hist_new, r.replacements, r.in_cycle) for r in C.last_replacement(history).collect()}
    assert got == {"O1": ("N3", 3, False), "N1": ("N3", 2, False), "N2": ("N3", 1, False), "P1": (None, None, True), "P2": (None, None, True)}


FACTS = [("in", D(2024, 1, 31), 1, 10, 1.5), ("in", D(2024, 2, 1), 1, 11, 2.25), ("out", D(2023, 12, 31), None, 10, -1.0),
         ("out", None, 2, 10, 4.0), ("in", D(2024, 1, 30), 1, 10, 1.5), (None, D(2024, 1, 1), 2, None, None)]


def test_lattice_equals_grouping_the_facts_and_reads_them_once(spark):
    facts = spark.createDataFrame(FACTS, "stage string, d date, store int, sku int, v double")
    dims = [L.plain("stage"), L.calendar("d", F.col("d")), L.plain("store"), L.plain("sku")]
    levels = [("stage", "d_day", "store"), ("stage", "d_month"), ("d_month", "sku"), ("d_year",), ("stage",), ()]
    made = L.Lattice(facts, dims, levels, {"v": 2})
    steps = {"d_day": F.col("d"), "d_month": F.trunc("d", "month"), "d_year": F.trunc("d", "year")}
    for level in levels:
        want = facts.groupBy(*[steps.get(c, F.col(c)).alias(c) for c in level]).agg(
            F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(18,2)")).cast("double"), F.min("v"), F.max("v")).collect()
        got = made.level(level).select(*level, "n_facts", "v", "v_min", "v_max").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want))), level
    assert made.base == ("stage", "d_day", "store", "sku") and made.parent_of(("stage",)) == ("stage", "d_month")
    assert made.parent_of(("d_month", "sku")) == made.base
    plan = made.all_levels()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan                             # every level is there already; facts were shuffled for the base alone
    empty = L.Lattice(facts.where("false"), dims, levels, {"v": 2})
    assert empty.all_levels().count() == 0
    with pytest.raises(ValueError, match="unknown"):
        L.Lattice(facts, dims, [("nope",)], {"v": 2})
    with pytest.raises(ValueError, match="one column of d"):
        L.Lattice(facts, dims, [("d_day", "d_month")], {"v": 2})


def test_lattice_does_not_group_the_facts_by_a_level_nobody_asked_for(spark):
    """Only levels that are asked for are shuffled; groups of a base that is asked for are made once."""
    facts = spark.createDataFrame(FACTS + FACTS, "stage string, d date, store int, sku int, v double")
    dims = [L.plain("stage"), L.calendar("d", F.col("d")), L.plain("store"), L.plain("sku")]
    made = L.Lattice(facts, dims, [("stage", "d_month", "store"), ("d_year", "sku"), ()], {"v": 2})
    assert made.made[made.base][1] == facts.count() and set(made.made[made.base][0].columns) == {"stage", "d_month", "store", "sku", "v"}
    assert made.level(()).select("n_facts").first()[0] == facts.count()
    whole = L.Lattice(facts, dims, [("stage", "d_day", "store", "sku"), ("d_year",)], {"v": 2})
    assert whole.made[whole.base][1] == facts.select("stage", "d", "store", "sku").distinct().count()
    assert L.Lattice(facts.where("false"), dims, [()], {"v": 2}).all_levels().select("n_facts").collect()[0][0] == 0


def test_calendar_change_shows_gaps_and_month_ends(spark):
    rows = [("k", D(2024, 1, 31), 1.0), ("k", D(2024, 1, 1), 2.0), ("k", D(2024, 3, 31), 5.0), ("k", D(2024, 4, 30), 4.0), ("k", None, 9.0),
            (None, D(2024, 2, 29), 7.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = {(r.k, r.period): (r.value, r.prev_value, r.change) for r in W.calendar_change(df, "d", "v", keys=["k"], step="month").collect()}
    assert got == {("k", D(2024, 1, 1)): (3.0, None, None), ("k", D(2024, 2, 1)): (None, 3.0, None), ("k", D(2024, 3, 1)): (5.0, None, None),
                   ("k", D(2024, 4, 1)): (4.0, 5.0, -1.0), (None, D(2024, 2, 1)): (7.0, None, None)}
    days = W.calendar_change(df, "d", "v", keys=["k"], step="day").where("k = 'k'").count()
    assert days == (D(2024, 4, 30) - D(2024, 1, 1)).days + 1
    years = W.calendar_change(df, "d", "v", step="year").collect()
    assert [(r.period, r.value) for r in years] == [(D(2024, 1, 1), 19.0)]
    with pytest.raises(ValueError):
        W.calendar_change(df, "d", "v", step="week")


def test_same_day_change_at_month_ends(spark):
    rows = [(D(2024, 2, 28), 1.0), (D(2024, 2, 29), 10.0), (D(2024, 3, 28), 2.0), (D(2024, 3, 29), 4.0), (D(2024, 3, 31), 3.0)]
    got = {r.day: (r.prior_day, r.prior_value, r.change) for r in W.same_day_change(
        spark.createDataFrame(rows, "d date, v double"), "d", "v").collect()}
    assert got[D(2024, 3, 31)] == (D(2024, 2, 29), 10.0, -7.0) and got[D(2024, 3, 29)] == (D(2024, 2, 29), 10.0, -6.0)
    assert got[D(2024, 3, 30)] == (D(2024, 2, 29), 10.0, None) and got[D(2024, 3, 28)] == (D(2024, 2, 28), 1.0, 1.0)


def test_invoice_bonus_attaches_with_a_hot_invoice_and_hot_nulls(spark):
    """A third of the lines in one invoice, a third under a null invoice; against sums made by hand, without windows."""
    rng = random.Random(2)
    lines, bonus = [], []
    for i in range(900):
        inv = ["HOT", None, f"I{i}"][i % 3]
        lines.append((inv, i % 40, f"P{i % 7}", inv, "S", "TDB" if i % 5 else "X", "JUAL", 10.0 + i, 5.0, 1.0, float(i % 4)))
        if rng.random() < 0.6:
            bonus.append((inv, i % 40, f"P{i % 7}", inv, "S" if i % 11 else None, "TDB" if i % 5 else "X", "JUAL", float(rng.randint(1, 9))))
    cols = "szFInvoiceId string, shItemNumber int, szProductId string, {} string, szParentId string, szPaymentType string, szOrderItemTypeId string"
    ldf = spark.createDataFrame(lines, cols.format("szDoId") + ", decAmount double, decDPP double, decTax double, decDiscount double")
    bdf = spark.createDataFrame(bonus, cols.format("szFDoId") + ", decBonusAmount double")
    out = A.attach_invoice_bonus(ldf, bdf, pay_types=["TDB"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "REPARTITION" not in plan and "partial_" in plan
    weight = {}
    for r in lines:
        if r[5] == "TDB" and r[0] is not None:
            n, ratio = weight.get(r[:2], (0, 0.0))
            weight[r[:2]] = (n + 1, ratio + (r[9] / r[10] if r[10] else 0.0))
    sums = {}
    for b in bonus:
        if b[0] is not None and b[:2] in weight:
            key = (b[0], b[2], b[3], b[4], b[5], b[6])
            a, t = sums.get(key, (0.0, 0.0))
            sums[key] = (a + b[7] * weight[b[:2]][0], t + b[7] * weight[b[:2]][1])
    got = out.collect()
    assert len(got) == len(lines)
    for r in got:
        want = sums.get((r.szFInvoiceId, r.szProductId, r.szDoId, r.szParentId, r.szPaymentType, r.szOrderItemTypeId), (None, None))
        if want[0] is None:
            assert r.sumDecBonusAmount is None
        else:
            assert abs(r.sumDecBonusAmount - want[0]) < 1e-6 and abs(r.sumDecBonusAmountTax - want[1]) < 1e-5


def test_hot_keys_are_split_by_the_join(spark):
    """With small thresholds AQE splits the hot invoice's side of the join that attaches the bonus sums."""
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("szFInvoiceId"),
            (F.col("id") % 50).cast("int").alias("shItemNumber"), F.lit("P").alias("szProductId"), F.lit("D").alias("szDoId"),
            F.lit("S").alias("szParentId"), F.lit("TDB").alias("szPaymentType"), F.lit("J").alias("szOrderItemTypeId"),
            F.lit(5.0).alias("decTax"), F.lit(1.0).alias("decDiscount"), F.rand(1).cast("string").alias("extra"))
        bonus = lines.where("id % 7 = 0" if "id" in lines.columns else "shItemNumber % 7 = 0").select(
            "szFInvoiceId", "shItemNumber", "szProductId", F.col("szDoId").alias("szFDoId"), "szParentId", "szPaymentType",
            "szOrderItemTypeId", F.lit(1.0).alias("decBonusAmount"))
        out = A.attach_invoice_bonus(lines, bonus, pay_types=["TDB"])
        assert len(out.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_source_form_joins(spark):
    left = spark.createDataFrame([(1,), (2,)], "a int")
    side = spark.createDataFrame([("x", 1), ("y", None)], "n string, v int")
    assert sorted(map(tuple, J.attach_rows(left, side).collect())) == [(1, "x", 1), (1, "y", None), (2, "x", 1), (2, "y", None)]
    assert sorted(map(tuple, J.attach_rows(left, side.where("false")).collect())) == [(1, None, None), (2, None, None)]
    with pytest.raises(Exception, match="over 1 rows"):
        J.attach_rows(left, side, max_rows=1).collect()
    items = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (1, 2, "d")], "k int, lv int, v string")
    got = J.join_levels(left, "a", items, "k", "lv", [1, 2, 3], {"v": "v"}).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, p, q, None) for p in "ab" for q in "cd"] + [(2, None, None, None)]))


def test_order_bonus_strict_counts_an_untaxed_bonus_once(spark):
    kinds = ["Invoice Disc. Item", "Invoice Disc. Item 2", "Invoice Disc."]
    items = spark.createDataFrame([("S", i, "P", "X", "T", "J", k, False, 10.0, 0.0) for i, k in enumerate(kinds)],
                                  "szFSoId string, shItemNumber int, szProductId string, szParentId string, szPaymentType string, "
                                  "szOrderItemTypeId string, szPrincipalDiscRefId string, bTaxable boolean, decDPP double, decTax double")
    heads = spark.createDataFrame([("S", D(2024, 1, 1))], "szFSoId string, dtmOrder date")
    bonus = items.select("szFSoId", "shItemNumber", "szProductId", "szParentId", "szPaymentType", "szOrderItemTypeId",
                         F.lit(4.0).alias("decBonusAmount"))
    for strict, tax in ((False, 4.0), (True, 0.0)):
        r = A.order_bonus(items, heads, bonus, order_since=D(2024, 1, 1), strict=strict).first()
        assert (r.decDisc1DPP, r.decDisc2DPP, r.decDiscFakturDPP) == (4.0, 4.0, 4.0)
        assert (r.decDisc1Tax, r.decDisc2Tax, r.decDiscFakturTax) == (0.0, tax, tax)


def test_collated_keys_join_group_and_compare(spark):
    path = tempfile.mkdtemp(prefix="tradeflow-coll-") + "/c"
    spark.createDataFrame([("gt ", "Trade"), ("MTI", "Modern")], schemas.ddl("category")).write.parquet(path)
    cat = readers.read_table(spark, "category", readers.SourceSpec(path=path), collated=True)
    own = schemas.collated(spark.createDataFrame([(1, "GT"), (2, "Gt  "), (3, "mti"), (4, " gt"), (5, None)], "k int, c string"))
    j = own.join(cat, own["c"] == cat["szCategoryId"], "left")
    assert {r.k: r.szDescription for r in j.collect()} == {1: "Trade", 2: "Trade", 3: "Modern", 4: None, 5: None}
    assert sorted(r["count"] for r in own.groupBy("c").count().collect()) == [1, 1, 1, 2] and own.where("c = 'gt'").count() == 2
    assert dict(schemas.plain_text(cat).dtypes)["szCategoryId"] == "string"


def test_bound_sql_takes_five_markers_and_keeps_text_a_value(spark):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(10)] + [(99, "' OR 1=1 --")], "id int, name string")
    text = "SELECT '?' AS q, id FROM {t} WHERE id > ? AND id <= ? AND id <> ? AND id >= ? /* ? */ AND id < ? -- ?"
    assert sorted(r.id for r in readers.bound_sql(spark, text, [1, 8, 4, 3, 7], t=rows).collect()) == [3, 5, 6]
    hostile = "' OR 1=1 --"
    assert [r.id for r in readers.bound_sql(spark, "SELECT id FROM {t} WHERE name = ?", [hostile], t=rows).collect()] == [99]
    assert readers.bound_sql(spark, "SELECT id FROM {t} WHERE name = ?", ["x'; DROP TABLE t; --"], t=rows).count() == 0
    with pytest.raises(ValueError, match="1 markers, 2 arguments"):
        readers.bound_sql(spark, "SELECT ?", [1, 2])


def test_checked_json_lines_route_bad_lines_to_rejects(spark):
    root = tempfile.mkdtemp(prefix="tradeflow-json-")
    os.makedirs(root + "/in")
    with open(root + "/in/a.json", "w") as f:
        f.write('{"a": 1, "b": "x"}\n{"a": "no number", "b": "y"}\n\n{broken\n{"b": "z", "more": [1]}\n')
    with open(root + "/in/b.json", "w") as f:
        f.write('[1, 2]\nnull\n{"a": 2}\n')
    counts = {os.path.basename(r._file): (r.n_loaded, r.n_rejected) for r in readers.load_json_lines(
        spark, root + "/in", "a int, b string", root + "/good", root + "/bad").collect()}
    good = sorted(map(tuple, spark.read.parquet(root + "/good").collect()), key=str)
    bad = sorted(r.line for r in spark.read.parquet(root + "/bad").collect())
    assert (1, "x") in good and (None, "z") in good and (2, None) in good and "{broken" in bad and any("no number" in b for b in bad)
    assert sum(n for n, _ in counts.values()) == len(good) and sum(m for _, m in counts.values()) == len(bad)
    assert len(good) + len(bad) == 7 and counts["a.json"] == (2, 2)


def test_registered_queries_have_oracles():
    assert set(Q.queries()) == set(Q.oracle_sql())
