import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tradeflow.operators import aggregates as A
from tradeflow.operators import joins as J
from tradeflow.operators import windows as W

T = dt.datetime


def test_without_reversed_both_roles(spark):
    docs = spark.createDataFrame([("D1",), ("D2",), ("D3",), ("D4",), ("D5",), (None,)], "doc string")
    rev = spark.createDataFrame(
        [("R1", "D1", "X", True),      # D1 reversed
         ("R2", "Y", "D2", True),      # D2 is the reversing document
         ("R3", "D3", None, False),    # not applied: D3 kept
         (None, "D4", None, True)],    # reversal id null: the source keeps D4
        "rid string, fwd string, back string, applied boolean")
    kept = J.without_reversed(docs, "doc", rev, reversed_col="fwd", reversing_col="back",
                              applied_col="applied", reversal_id_col="rid")
    assert sorted([r.doc for r in kept.collect()], key=str) == ["D3", "D4", "D5", None]


def test_latest_per_key_nulls_last_and_tie(spark):
    rows = [("k1", T(2024, 1, 1), 1, "a"), ("k1", T(2024, 1, 3), 2, "b"), ("k1", T(2024, 1, 3), 3, "c"),
            ("k1", None, 9, "z"), ("k2", None, 4, "only-null"), ("k3", T(2024, 1, 1), 5, "x")]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, v string")
    got = {r.k: (r.id, r.v) for r in J.latest_per_key(df, "k", ["ts"], ["v"], tie_break=["id"]).collect()}
    assert got == {"k1": (3, "c"), "k2": (4, "only-null"), "k3": (5, "x")}


def test_latest_per_key_equals_row_number(spark):
    random.seed(3)
    rows = [(random.randint(0, 20), T(2024, 1, random.randint(1, 5)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int")
    df.createOrReplaceTempView("lpk")
    brute = spark.sql("SELECT k, ts, id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, id DESC) rn "
                      "FROM lpk) WHERE rn = 1")
    ours = J.latest_per_key(df, "k", ["ts"], [], tie_break=["id"]).select("k", "ts", "id")
    assert sorted(brute.collect()) == sorted(ours.collect())


def test_attach_single_row(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    one = spark.createDataFrame([("T", 7)], "t string, v int")
    out = J.attach_single_row(left, one)
    assert out.count() == 3 and {r.v for r in out.collect()} == {7}
    empty = one.where("false")
    out2 = J.attach_single_row(left, empty).collect()
    assert len(out2) == 3 and all(r.v is None for r in out2)
    many = spark.createDataFrame([("T", 9), ("T", 7)], "t string, v int")
    with pytest.raises(Exception, match="several rows"):                 # neither multiplied nor cut
        J.attach_single_row(left, many).collect()


def test_pivot_levels_repeat_and_missing(spark):
    items = spark.createDataFrame(
        [("G1", 1, T(2024, 1, 1), True), ("G1", 1, T(2024, 1, 5), False), ("G1", 3, T(2024, 1, 9), True),
         ("G2", 2, T(2024, 2, 1), True)], "g string, lvl int, d timestamp_ntz, ok boolean")
    out = {r.g: r for r in J.pivot_levels(items, "g", "lvl", [1, 2, 3], {"d": "d", "ok": "ok"}).collect()}
    assert (out["G1"].d1, out["G1"].ok1) == (T(2024, 1, 5), False)      # both from the level's latest row
    assert out["G1"].d1 == T(2024, 1, 5) and out["G1"].d2 is None and out["G1"].max_level == 3
    assert out["G2"].d1 is None and out["G2"].d2 == T(2024, 2, 1) and out["G2"].max_level == 2


def test_either_side_lines_equals_pairs_distinct(spark):
    random.seed(7)
    left = [(random.randint(0, 30), random.choice("JRX"), random.randint(0, 5)) for _ in range(300)]
    right = [(random.randint(0, 30), random.choice(["BELI", "LAIN", None])) for _ in range(200)]
    l = spark.createDataFrame(left, "doc int, typ string, v int")
    r = spark.createDataFrame(right, "doc int, ptyp string")
    l.createOrReplaceTempView("ll"); r.createOrReplaceTempView("rr")
    brute = spark.sql("SELECT DISTINCT ll.doc, ll.typ, ll.v FROM ll LEFT JOIN rr ON ll.doc = rr.doc "
                      "WHERE ll.typ = 'J' OR rr.ptyp = 'BELI'")
    ours = J.either_side_lines(l, r, "doc", F.col("typ") == "J", F.col("ptyp") == "BELI").distinct()
    assert sorted(brute.collect()) == sorted(ours.select("doc", "typ", "v").collect())


def test_top_n_per_group_equals_row_number(spark):
    random.seed(11)
    rows = [(random.choice([1, 1, 1, 2, 3]), i, float(random.randint(0, 50))) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, item int, val double")
    df.createOrReplaceTempView("tn")
    brute = spark.sql("SELECT g, item, val FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY val DESC, item) rn "
                      "FROM tn) WHERE rn <= 4")
    ours = W.top_n_per_group(df, ["g"], [F.col("val").desc(), F.col("item").asc()], 4)
    assert sorted(brute.collect()) == sorted(ours.select("g", "item", "val").collect())


def test_month_to_date_and_period_change(spark):
    rows = [(dt.date(2024, 1, 30), 1.0), (dt.date(2024, 1, 31), 2.0), (dt.date(2024, 2, 1), 4.0),
            (dt.date(2024, 2, 3), 8.0)]
    df = spark.createDataFrame(rows, "d date, v double")
    mtd = {r.d: r.m for r in W.month_to_date(df, "d", "v", alias="m").collect()}
    assert mtd == {dt.date(2024, 1, 30): 1.0, dt.date(2024, 1, 31): 3.0, dt.date(2024, 2, 1): 4.0,
                   dt.date(2024, 2, 3): 12.0}
    ch = {r.d: (r.prev_value, r.change) for r in W.period_change(df, "d", "v").collect()}
    assert ch[dt.date(2024, 2, 1)] == (2.0, 2.0) and ch[dt.date(2024, 2, 3)] == (None, None)


def test_climb_and_settings_pivot(spark):
    org = spark.createDataFrame([("A", "B", "a"), ("B", "C", "b"), ("C", None, "c")], "k string, p string, n string")
    start = spark.createDataFrame([(1, "A"), (2, "C"), (3, "Z")], "id int, org string")
    out = {r.id: r for r in J.climb(start, "org", org, "k", "p", "n", levels=3).collect()}
    assert (out[1].lvl1_name, out[1].lvl2_name, out[1].lvl3_name) == ("a", "b", "c")
    assert (out[2].lvl1_name, out[2].lvl2_name) == ("c", None)
    assert out[3].lvl1_name is None
    info = spark.createDataFrame([("W1", "00001", "x"), ("W1", "00002", "y"), ("W2", "00001", "z"),
                                  ("W2", "00009", "ignored")], "wp string, item string, val string")
    piv = {r.wp: r for r in J.settings_pivot(info, "wp", "item", "val", ["00001", "00002"]).collect()}
    assert (piv["W1"].setting_00001, piv["W1"].setting_00002) == ("x", "y")
    assert (piv["W2"].setting_00001, piv["W2"].setting_00002) == ("z", None)
    twice = info.union(spark.createDataFrame([("W1", "00001", "x2")], info.schema))
    with pytest.raises(Exception, match="several rows"):
        J.settings_pivot(twice, "wp", "item", "val", ["00001", "00002"]).collect()


def test_assert_unique(spark):
    ok = spark.createDataFrame([(1,), (2,)], "k int")
    J.assert_unique(ok, "k")
    with pytest.raises(ValueError):
        J.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def _bonus_fixture(spark):
    items = spark.createDataFrame(
        [("I1", 1, "TDB", 100.0, 10.0, 5.0, True, 90.0, "Invoice Disc. Item"),
         ("I1", 2, "DOB", 200.0, 0.0, 9.0, True, 180.0, "Invoice Disc. Item 2"),
         ("I1", 3, "CASH", 50.0, 5.0, 1.0, False, 45.0, "Invoice Disc."),
         ("I2", 1, "TDB", 80.0, 8.0, 4.0, True, 0.0, "Invoice Disc."),      # zero base
         ("I2", 1, "TDB", 80.0, 4.0, 2.0, True, 70.0, "Invoice Disc.")],    # repeated line key
        "inv string, item int, pay string, amount double, disc double, tax double, taxable boolean, dpp double, "
        "kind string")
    bonus = spark.createDataFrame(
        [("I1", 1, "P1", "D1", None, "TDB", "JUAL", 3.0), ("I1", 1, "P1", "D1", None, "TDB", "JUAL", 2.0),
         ("I1", 2, "P2", "D1", "X", "DOB", "JUAL", 4.0), ("I1", 3, "P3", "D1", "X", "CASH", "JUAL", 1.0),
         ("I2", 1, "P4", "D2", "X", "TDB", "JUAL", 6.0), ("I2", 1, None, "D2", "X", "TDB", "JUAL", 6.0)],
        "inv string, item int, prod string, do string, parent string, pay string, itype string, amt double")
    return items, bonus


def test_invoice_bonus_equals_pairs(spark):
    items, bonus = _bonus_fixture(spark)
    i = items.select(F.col("inv").alias("szFInvoiceId"), F.col("item").alias("shItemNumber"),
                     F.col("pay").alias("szPaymentType"), F.col("tax").alias("decTax"),
                     F.col("disc").alias("decDiscount"))
    b = bonus.select(F.col("inv").alias("szFInvoiceId"), F.col("item").alias("shItemNumber"),
                     F.col("prod").alias("szProductId"), F.col("do").alias("szFDoId"),
                     F.col("parent").alias("szParentId"), F.col("pay").alias("szPaymentType"),
                     F.col("itype").alias("szOrderItemTypeId"), F.col("amt").alias("decBonusAmount"))
    ours = A.invoice_bonus(b, i, pay_types=["TDB", "DOB"])
    i.createOrReplaceTempView("ii"); b.createOrReplaceTempView("bb")
    brute = spark.sql("""SELECT bb.szFInvoiceId, bb.szProductId, bb.szFDoId, bb.szParentId, bb.szPaymentType,
        bb.szOrderItemTypeId, sum(bb.decBonusAmount) s, sum(CASE WHEN ii.decDiscount = 0 THEN 0
        ELSE bb.decBonusAmount * ii.decTax / ii.decDiscount END) st
        FROM bb JOIN ii ON ii.szFInvoiceId = bb.szFInvoiceId AND ii.shItemNumber = bb.shItemNumber
        WHERE ii.szPaymentType IN ('TDB', 'DOB') GROUP BY 1, 2, 3, 4, 5, 6""")
    key = lambda r: tuple(str(x) for x in r[:6])
    exp = {key(r): (r.s, r.st) for r in brute.collect()}
    got = {key(r): (r.sumDecBonusAmount, r.sumDecBonusAmountTax) for r in ours.collect()}
    assert exp.keys() == got.keys()
    for k in exp:
        assert abs(exp[k][0] - got[k][0]) < 1e-6 and abs(exp[k][1] - got[k][1]) < 1e-6, k


def test_order_bonus_equals_pairs(spark):
    items, bonus = _bonus_fixture(spark)
    so_items = items.select(F.col("inv").alias("szFSoId"), F.col("item").alias("shItemNumber"),
                            F.col("kind").alias("szPrincipalDiscRefId"), F.col("taxable").alias("bTaxable"),
                            F.col("dpp").alias("decDPP"), F.col("tax").alias("decTax"))
    hdr = spark.createDataFrame([("I1", T(2024, 11, 2)), ("I2", T(2024, 11, 1))], "szFSoId string, dtmOrder timestamp_ntz")
    b = bonus.select(F.col("inv").alias("szFSoId"), F.col("item").alias("shItemNumber"),
                     F.col("prod").alias("szProductId"), F.col("parent").alias("szParentId"),
                     F.col("pay").alias("szPaymentType"), F.col("itype").alias("szOrderItemTypeId"),
                     F.col("amt").alias("decBonusAmount"))
    for inclusive, n_orders in [(True, 2), (False, 1)]:
        ours = A.order_bonus(so_items, hdr, b, order_since=T(2024, 11, 1), inclusive=inclusive)
        so_items.createOrReplaceTempView("si"); hdr.createOrReplaceTempView("hd"); b.createOrReplaceTempView("bo")
        op = ">=" if inclusive else ">"
        split_ok = "si.bTaxable AND (si.decDPP + si.decTax) <> 0"

        def s(kind, tax, untaxed):
            w = (f"bo.decBonusAmount * si.decTax / (si.decDPP + si.decTax)" if tax
                 else f"bo.decBonusAmount * si.decDPP / (si.decDPP + si.decTax)")
            return f"sum(CASE WHEN si.szPrincipalDiscRefId = '{kind}' THEN CASE WHEN {split_ok} THEN {w} ELSE {untaxed} END ELSE 0 END)"
        brute = spark.sql(f"""SELECT si.szFSoId, bo.szProductId, bo.szParentId, bo.szPaymentType, bo.szOrderItemTypeId,
            {s('Invoice Disc. Item', False, 'bo.decBonusAmount')} d1d, {s('Invoice Disc. Item', True, '0')} d1t,
            {s('Invoice Disc. Item 2', False, 'bo.decBonusAmount')} d2d, {s('Invoice Disc. Item 2', True, 'bo.decBonusAmount')} d2t,
            {s('Invoice Disc.', False, 'bo.decBonusAmount')} dfd, {s('Invoice Disc.', True, 'bo.decBonusAmount')} dft
            FROM si LEFT JOIN hd ON si.szFSoId = hd.szFSoId
            LEFT JOIN bo ON bo.szFSoId = si.szFSoId AND si.shItemNumber = bo.shItemNumber
            WHERE bo.szProductId IS NOT NULL AND hd.dtmOrder {op} TIMESTAMP'2024-11-01 00:00:00'
            GROUP BY 1, 2, 3, 4, 5""")
        key = lambda r: tuple(str(x) for x in r[:5])
        exp = {key(r): tuple(r[5:]) for r in brute.collect()}
        got = {key(r): tuple(r[5:]) for r in ours.collect()}
        assert exp.keys() == got.keys() and len({k[0] for k in got}) == n_orders
        for k in exp:
            assert all(abs(a - b) < 1e-6 for a, b in zip(exp[k], got[k])), (k, exp[k], got[k])
