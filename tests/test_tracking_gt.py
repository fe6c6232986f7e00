"""T3 branches on hand-made rows: which document gives a row its fields, the
five bounds, history scopes, approval level and the quantities by product."""

import datetime as dt
from decimal import Decimal

from tradeflow.plans.tracking_gt import WideTrackingSources, history_rows, po_tracking_gt
from tradeflow.sources import schemas

T = dt.datetime
BOUNDS = {"bonus_since": T(2024, 11, 1), "po_from": T(2024, 11, 1), "po_to": T(2024, 11, 30),
          "so_from": T(2024, 11, 1), "so_to": T(2024, 11, 30)}


def _df(spark, name, rows):
    return spark.createDataFrame(rows, schemas.schema(name))


def _db(spark):
    d = lambda x: Decimal(str(x))
    si = [("SO1", "PO1", "DO1", "DN1", "C1", 1, "K", "V", "D", T(2024, 11, 9)),      # both documents
          ("SO2", "", "DO2", "DN2", "C1", None, None, None, None, None),             # sales order only
          ("  ", "PO3", "DO3", "DN3", "C2", 0, None, None, None, None),              # purchase order only, blank SO
          (None, "PO4", "DO4", None, "C1", 0, None, None, None, None),               # the same with a null SO
          ("SO5", None, "DO5", "DN5", "C1", 0, None, None, None, None),              # null PO id: neither date branch
          ("SO6", "", "DO6", "DN6", "C1", 0, None, None, None, None)]                # SO out of range
    so = [("SO1", " ", "G1", T(2024, 10, 1), T(2024, 10, 2), "TOP", False, False, True),
          ("SO2", "CPO2 ", "G2", T(2024, 11, 30), T(2024, 11, 30), "TOP", True, False, None),
          ("SO5", None, "G1", T(2024, 11, 4), T(2024, 11, 4), None, False, False, None),
          ("SO6", None, "G1", T(2024, 12, 4), T(2024, 12, 1), None, False, True, None)]
    soi = [("SO1", 1, "P1", "X", "TDB", "JUAL", "Invoice Disc.", True, d(2), d(11), d(22), d(20), d(2)),
           ("SO1", 2, "P2", "X", "TDB", "RETUR", "Invoice Disc.", False, d(1), d(5), d(5), d(5), d(0)),
           ("SO2", 1, "P1", "X", "TDB", "JUAL", "Invoice Disc.", True, d(1), d(11), d(11), d(10), d(1)),
           ("SO2", 2, "P2", "X", "TDB", "RETUR", "Invoice Disc.", True, d(1), d(5), d(5), d(5), d(0))]
    po = [("PO1", "OK", T(2024, 11, 1), T(2024, 11, 1), False), ("PO3", None, T(2024, 11, 2), T(2024, 11, 30), True),
          ("PO4", "OK", T(2024, 11, 2), T(2024, 12, 1), True)]
    poi = [("PO1", "P9", "BELI", True, d(1), d(1), d(1), d(1), d(0), d(0)),
           ("PO1", "P8", "LAIN", True, d(1), d(1), d(1), d(1), d(0), d(0)),
           ("PO3", "P1", "BELI-BERIKAT", True, d(3), d(11), d(33), d(30), d(3), d(11)),
           ("PO3", "P2", "LAIN", True, d(3), d(11), d(33), d(30), d(3), d(11))]
    bonus = [("SO2", 1, "P1", "X", "TDB", "JUAL", d(11)), ("SO1", 1, "P1", "X", "TDB", "JUAL", d(11))]
    return WideTrackingSources(
        sales_inquiry=_df(spark, "sales_inquiry", si), sales_order=_df(spark, "sales_order", so),
        sales_order_item=_df(spark, "sales_order_item", soi), purchase_order=_df(spark, "purchase_order", po),
        purchase_order_item=_df(spark, "purchase_order_item", poi),
        sales_order_item_bonus=_df(spark, "sales_order_item_bonus", bonus),
        product=_df(spark, "product", [("P1", "Soap"), ("P2", "Shampoo")]),
        customer=_df(spark, "customer", [("C1", "One", None, "C1", "CAT"), ("C2", "Two", None, "C2", None)]),
        category=_df(spark, "category", [("CAT", "GT")]),
        delivery_order=_df(spark, "delivery_order", [(f"DO{i}", None, None, None, None, f"INV{i}", None, T(2024, 11, 8))
                                                     for i in range(1, 8)]),
        wms_delivery=_df(spark, "wms_delivery", [("SO1", "W1", "DO1", T(2024, 11, 10)), ("SO2", "W2", "DO9", T(2024, 11, 10))]),
        wms_delivery_item=_df(spark, "wms_delivery_item", [("SO1", "W1", "P1", d(1)), ("SO1", "W1", "P1", d(1))]),
        po_receipt=_df(spark, "po_receipt", [("R1", "PO1", T(2024, 11, 3), T(2024, 11, 4)), ("R2", "PO1", T(2024, 11, 5), None),
                                             ("R3", "", None, None)]),
        invoice=_df(spark, "invoice", [(f"INV{i}", None, None, None, None, T(2024, 11, 9), False, True) for i in (1, 2, 7)]),
        invoice_item=_df(spark, "invoice_item", [
            ("INV1", 1, "P1", None, None, None, "JUAL", None, True, d(2), d(1), d(1), d(0), d(0)),
            ("INV7", 1, "P1", None, None, None, "OTHER", None, True, d(7), d(1), d(1), d(0), d(0))]),
        cancel_message=_df(spark, "cancel_message", [("SO1", False, "open"), ("SO2", True, "gone")]),
        purchase_message=_df(spark, "purchase_message", [("SO1", True, T(2024, 11, 2)), ("SO2", False, T(2024, 11, 2))]),
        approved_item=_df(spark, "approved_item", [("G1", 1, True, T(2024, 11, 1)), ("G1", 3, False, T(2024, 11, 2))]),
        delivery_note=_df(spark, "delivery_note", [("DN1", T(2024, 11, 11))]),
        delivery_note_item=_df(spark, "delivery_note_item", [("DN1", "P1", d(2)), ("DN2", "P1", d(9))]),
        close_note=_df(spark, "close_note", [("CL1", False, None), ("CL2", True, T(2024, 11, 9))]),
        close_note_item=_df(spark, "close_note_item", [("CL1", "DN1"), ("CL2", "DN1")]),
        do_history=_df(spark, "do_history", [("DO7", "DO2", T(2024, 11, 9)), ("DO6", "DO1", T(2024, 11, 1)),
                                             ("DO7", "DO1", T(2024, 10, 1))]))


def _rows(spark, **options):
    out = po_tracking_gt(_db(spark), **BOUNDS, **options).collect()
    return {(r.szFSoId or "").strip() + "/" + (r.szFPOid or "") + "/" + r.szProductId + "/" + r.szFPoReceipt_sId: r for r in out}


def test_branches(spark):
    rows = _rows(spark)
    assert sorted(rows) == ["/PO3/P1/", "SO1/PO1/P1/R1", "SO1/PO1/P1/R2", "SO1/PO1/P2/R1", "SO1/PO1/P2/R2", "SO2/CPO2/P1/"]
    both = rows["SO1/PO1/P1/R1"]
    # the sales order is before the bonus bound, so its bonus is not summed; prices lose their tax part
    assert both.decDiscFakturDPP is None and float(both.decPrice) == 10.0 and float(both.decQty) == 2
    assert float(both.decQtyDelivered) == 2 and float(both.decQtyReceipt) == 2 and float(both.decQtyInvoice) == 2
    assert both.feedback == "SO1" and both.szDataCancelPO == "" and both.dtmSendWMS == T(2024, 11, 2)
    assert both.currentApprovalLevel == "4" and both.bApproved1 and both.dtmApproved2 == T(1900, 1, 1) and not both.bApproved3
    assert both.bStatusDN and both.MaxLastUpdated == T(2024, 11, 11) and both.podatefilter == T(2024, 11, 1)
    kept = rows["SO1/PO1/P2/R2"]                   # a return, kept by the purchase order's buying line
    assert float(kept.decPrice) == 5.0 and kept.dtmReceiptPOrec == T(1900, 1, 1) and float(kept.decQtyDelivered) == 0
    sale = rows["SO2/CPO2/P1/"]
    assert float(sale.decDiscFakturDPP) == 10.0 and float(sale.decDiscFakturTax) == 1.0 and float(sale.decDisc1DPP) == 0
    assert sale.currentApprovalLevel == "" and sale.szDataCancelPO == "gone" and sale.feedback == "" and sale.IstatusFlag == 0
    assert sale.dtmSendWMS == T(1900, 1, 1) and float(sale.decQtyReceipt) == 0
    buy = rows["/PO3/P1/"]
    assert (float(buy.decQty), float(buy.decPPN), float(buy.decAmountPOSO)) == (3, 3, 33)
    assert (float(buy.decDisc1DPP), float(buy.decDisc1Tax), float(buy.decDisc2DPP)) == (10.0, 1.0, 0.0)
    assert float(buy.decPrice) == 10.0 and buy.prodNm == "Soap" and buy.statusPO == "" and buy.bvoidPO
    assert float(buy.decQtyReceipt) == 0 and buy.bVoid is None and buy.currentApprovalLevel == "1"


def test_history_scope(spark):
    glob = _rows(spark)                            # the last row of the table replaces DO2
    assert glob["SO2/CPO2/P1/"].szFInvoiceId == "INV7" and float(glob["SO2/CPO2/P1/"].decQtyInvoice) == 7
    assert glob["SO1/PO1/P1/R1"].szFInvoiceId == "INV1"
    per_key = _rows(spark, history_scope="per_key")
    assert per_key["SO2/CPO2/P1/"].szFInvoiceId == "INV7"
    # DO1's last replacement has no invoice, so its own stays
    assert per_key["SO1/PO1/P1/R1"].szFInvoiceId == "INV1" and float(per_key["SO1/PO1/P1/R1"].decQtyInvoice) == 2
    hist = {(r.hist_old, r.hist_new) for r in history_rows(_db(spark).do_history, "per_key").collect()}
    assert hist == {("DO2", "DO7"), ("DO1", "DO6")}


def test_an_inquiry_given_twice_shows_its_lines_once(spark):
    src = _db(spark)
    once = _rows(spark)
    src.sales_inquiry = src.sales_inquiry.unionByName(src.sales_inquiry)
    twice = po_tracking_gt(src, **BOUNDS).collect()
    assert len(twice) == len(once) and set(twice) == set(once.values())


def test_distinct_shuffles_nothing_after_the_last_join(spark):
    """Where no side is broadcast, rows meet for DISTINCT where the join of lines and documents dealt them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = po_tracking_gt(_db(spark), **BOUNDS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    top = plan[:plan.index("SortMergeJoin")]
    assert "HashAggregate" in top or "SortAggregate" in top
    assert "Exchange" not in top, top


def test_lines_of_other_documents_are_filtered_before_they_are_shuffled(spark, tmp_path, monkeypatch):
    from tradeflow.plans import tracking_gt

    spark.range(1000).selectExpr("string(id) szFSoId").write.parquet(str(tmp_path / "lines"))
    spark.range(5).selectExpr("string(id) id").union(spark.sql("SELECT string(null)")).write.parquet(str(tmp_path / "ids"))
    lines, ids = spark.read.parquet(str(tmp_path / "lines")), spark.read.parquet(str(tmp_path / "ids"))
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    monkeypatch.setitem(tracking_gt.RUNTIME_FILTER, size, "1")
    plans, write = [], tracking_gt.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(tracking_gt, "written", noted)
    before, own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get(size)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = tracking_gt._cut(lines, "szFSoId", ids, "id", "lines")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r.szFSoId for r in cut.collect()) == ["0", "1", "2", "3", "4"]
    assert "might_contain" in plans[0] and spark.conf.get(size) == own
