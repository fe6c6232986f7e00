import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tradeflow.plans.invoice import InvoiceSources, invoice_lines, vehicle_load, workplace_like
from tradeflow.plans.sellout import publish_sell_out, sell_out
from tradeflow.plans.tracking import TrackingSources, po_tracking_mtd
from tradeflow.sources import schemas
from tradeflow.sources.readers import sliced_scan

T = dt.datetime


def _df(spark, name, rows):
    return spark.createDataFrame(rows, schemas.schema(name))


def _invoice_db(spark):
    d = lambda x: None if x is None else __import__("decimal").Decimal(str(x))
    inv = _df(spark, "invoice", [
        ("INV1", "WP-DST1", "C1", "s01", T(2024, 11, 5), T(2024, 11, 5), False, True),
        ("INV2", "WP-DST1", "C2", "s02", T(2024, 11, 6), T(2024, 11, 6), True, True),     # void
        ("INV3", "WP-HO", "C1", "s01", T(2024, 11, 7), T(2024, 11, 7), False, True),      # DO workplace decides
        ("INV4", "WP-DST1", "C1", "s01", T(2024, 10, 31), T(2024, 10, 31), False, True),  # outside period
        ("INV5", "WP-DST1", "C1", "s01", T(2024, 11, 8), T(2024, 11, 8), False, True)])   # reversed DO
    items = _df(spark, "invoice_item", [
        ("INV1", 1, "P1", "DO1", "X", "TDB", "JUAL", "INV", True, d(2), d(110), d(100), d(10), d(11)),
        ("INV1", 2, "P2", "DO1", "X", "CASH", "JUAL", "INV", False, d(0), d(50), d(45), d(5), d(0)),
        ("INV1", 3, "", "DO1", "X", "CASH", "JUAL", "DOR", False, d(1), d(5), d(5), d(0), d(0)),   # F11 drops
        ("INV2", 1, "P1", "DO2", "X", "TDB", "JUAL", "INV", True, d(1), d(10), d(9), d(1), d(1)),
        ("INV3", 1, "P1", "DO3", "X", "TDB", "JUAL", "INV", True, d(1), d(10), d(9), d(1), d(1)),
        ("INV4", 1, "P1", "DO1", "X", "TDB", "JUAL", "INV", True, d(1), d(10), d(9), d(1), d(1)),
        ("INV5", 1, "P1", "DO5", "X", "TDB", "JUAL", "INV", True, d(1), d(10), d(9), d(1), d(1))])
    bonus = _df(spark, "invoice_item_bonus", [
        ("INV1", 1, "P1", "DO1", "X", "TDB", "JUAL", d(4)), ("INV1", 1, "P1", "DO1", "X", "TDB", "JUAL", d(1))])
    do = _df(spark, "delivery_order", [
        ("DO1", "SO1", "REF1", "C2", None, "INV1", "V1", T(2024, 11, 5)),
        ("DO3", "SO3", "REF3", None, "WP-DST2", "INV3", "V1", T(2024, 11, 7)),
        ("DO5", "SO5", "REF5", "C1", None, "INV5", "V2", T(2024, 11, 8))])
    rev = _df(spark, "delivery_reversal", [("R1", "DO9", "DO5", True)])
    wp = _df(spark, "workplace", [("WP-DST1", "Depot 1", "ORG1"), ("WP-DST2", "Depot 2", "ORG1"),
                                  ("WP-HO", "Head office", "ORG0")])
    cust = _df(spark, "customer", [("C1", "Cust One", "Addr 1", "C1", "GT"), ("C2", "Cust Two", "Addr 2", "C1", "MTI")])
    loc = _df(spark, "customer_location", [("C1", 0, "Town"), ("C1", 1, "Other town")])
    prod = _df(spark, "product", [("P1", "Soap"), ("P2", "Shampoo")])
    emp = spark.createDataFrame([("S01", "Sales One", None)], schemas.schema("employee"))
    spec = _df(spark, "product_spec", [("P1", d(500), d(2000))])
    return InvoiceSources(invoice_item=items, invoice=inv, workplace=wp, customer=cust, product=prod,
                          delivery_order=do, delivery_reversal=rev, customer_location=loc, employee=emp,
                          invoice_item_bonus=bonus, product_spec=spec)


def test_invoice_lines_hand_checked(spark):
    src = _invoice_db(spark)
    rows = {(r.InvoiceId, r.ProductID): r for r in
            invoice_lines(src, "2024-11-01", "2024-12-01", workplace_like("%DST%")).collect()}
    # INV2 void, INV4 outside the period, INV5 reversed, line 3 of INV1 fails the product rule
    assert set(rows) == {("INV1", "P1"), ("INV1", "P2"), ("INV3", "P1")}
    r = rows[("INV1", "P1")]
    # taxable: dpp 100, tax 10, discount 11, bonus B = 5, Bt = 5 * 10 / 11
    bt = 5 * 10 / 11
    assert float(r.Amount) == float(100 + 11 * 100 / 110)
    assert abs(float(r.Tax) - (10 + bt)) < 1e-6
    assert abs(float(r.NettAmount) - (100 - 5 * 100 / 110)) < 1e-6
    assert abs(float(r.Discount) - (11 * 100 / 110 + 5 * 100 / 110)) < 1e-6
    assert r.CustomerId == "C2" and r.CustomerName == "Cust Two"      # delivery customer wins
    assert r.Address == "Addr 1" and r.Muncipality == "Town"          # address: invoice customer; city: location 0
    assert r.SalesID == "S01" and r.EmployeeName is None               # UPPER(id); employee key is case-exact
    assert r.OrderDate == "2024-11-05" and r.InvoiceProductID == "INV1-P1" and float(r.Price) == 55.0
    u = rows[("INV1", "P2")]
    assert float(u.Amount) == 50 and float(u.NettAmount) == 50 and float(u.Price) == 0.0   # untaxed, qty 0
    h = rows[("INV3", "P1")]
    assert h.CustomerId == "C1" and h.WorkplaceName == "Head office"  # no DO customer: invoice customer


def test_ordered_export_order(spark):
    from tradeflow.plans import catalog
    from tradeflow.plans.invoice import INVOICE_EXPORT_ORDER, ordered_export
    rows = ordered_export(catalog.q_invoice_lines(spark, "/root/testdata/sf0.001")).select(*INVOICE_EXPORT_ORDER).collect()
    keys = [tuple((v is not None, v if v is not None else 0) for v in r) for r in rows]
    assert len(keys) > 100 and keys == sorted(keys)


def test_vehicle_load(spark):
    src = _invoice_db(spark)
    out = {(r.szVehicleId, r.dtmDate): (r.decVolume, r.decWeight)
           for r in vehicle_load(src, "2024-11-01", "2024-11-30", workplace_like("%DST%")).collect()}
    # INV1: P1 qty 2 -> 2*500/1000 = 1.0 vol, 4.0 weight; P2 qty 0 -> 0; INV3 P1 qty 1 -> 0.5 / 2.0
    assert out == {("V1", dt.date(2024, 11, 5)): (1.0, 4.0), ("V1", dt.date(2024, 11, 7)): (0.5, 2.0)}


def _tracking_db(spark):
    d = lambda x: __import__("decimal").Decimal(str(x))
    si = _df(spark, "sales_inquiry", [
        ("SO1", "PO1", "DO1", "DN1", "C1", 0, None, None, None, None),
        ("SO2", "", "DO2", "DN2", "C1", 0, None, None, None, None),
        ("", "PO3", "DO3", "DN3", "C1", 0, None, None, None, None),      # no SO: cannot pass delivery
        ("SO4", "PO4", "DO4", "DN4", "C2", 0, None, None, None, None),   # other channel
        ("SO5", "PO5", "DO5", "DN5", "C1", 0, None, None, None, None)])  # cancelled (one of two rows)
    so = _df(spark, "sales_order", [
        ("SO1", "  ", "G1", T(2024, 11, 2), T(2024, 11, 3), None, False, False, None),
        ("SO2", "CPO2 ", "G2", T(2024, 11, 4), T(2024, 11, 4), None, False, False, None),
        ("SO4", None, "G4", T(2024, 11, 4), T(2024, 11, 4), None, False, False, None),
        ("SO5", None, "G5", T(2024, 11, 4), T(2024, 11, 4), None, False, False, None)])
    soi = _df(spark, "sales_order_item", [
        ("SO1", 1, "P1", "X", "TDB", "JUAL", "Invoice Disc.", True, d(1), d(10), d(11), d(10), d(1)),
        ("SO1", 2, "P2", "X", "TDB", "RETUR", "Invoice Disc.", True, d(1), d(5), d(5), d(5), d(0)),   # kept via PO
        ("SO1", 3, "P1", "X", "TDB", "JUAL", "Invoice Disc.", True, d(1), d(10), d(11), d(10), d(1)),  # duplicate line
        ("SO2", 1, "P2", "X", "TDB", "RETUR", "Invoice Disc.", True, d(2), d(5), d(10), d(10), d(0)), # no PO: dropped
        ("SO2", 2, "P1", "X", "TDB", "JUAL", "Invoice Disc.", True, d(1), d(10), d(11), d(10), d(1)),
        ("SO4", 1, "P1", "X", "TDB", "JUAL", "Invoice Disc.", True, d(1), d(10), d(11), d(10), d(1)),
        ("SO5", 1, "P1", "X", "TDB", "JUAL", "Invoice Disc.", True, d(1), d(10), d(11), d(10), d(1))])
    po = _df(spark, "purchase_order", [("PO1", "OK", T(2024, 11, 1), T(2024, 11, 1), False),
                                       ("PO3", "OK", T(2024, 11, 1), T(2024, 11, 1), False),
                                       ("PO5", "OK", T(2024, 11, 1), T(2024, 11, 1), False)])
    poi = _df(spark, "purchase_order_item", [
        ("PO1", "P9", "BELI", True, d(1), d(1), d(1), d(1), d(0), d(0)),
        ("PO1", "P8", "LAIN", True, d(1), d(1), d(1), d(1), d(0), d(0)),
        ("PO3", "P7", "BELI", True, d(1), d(1), d(1), d(1), d(0), d(0))])
    prod = _df(spark, "product", [("P1", "Soap"), ("P2", "Shampoo")])
    cust = _df(spark, "customer", [("C1", "One", None, "C1", "CAT-GT"), ("C2", "Two", None, "C2", "CAT-X")])
    cat = _df(spark, "category", [("CAT-GT", "GT"), ("CAT-X", "OTHER")])
    do = _df(spark, "delivery_order", [(f"DO{i}", None, None, None, None, None, None, None) for i in range(1, 6)])
    delv = _df(spark, "wms_delivery", [("SO1", "W1", "DO1", T(2024, 11, 10)), ("SO2", "W2", "DO2", T(2024, 11, 11)),
                                       ("", "W3", "DO3", T(2024, 11, 11)), ("SO4", "W4", "DO4", T(2024, 11, 11)),
                                       ("SO5", "W5", "DO5", T(2024, 11, 11))])
    bonus = spark.createDataFrame([("SO1", "P1", "X", "TDB", "JUAL", 1.0, 0.5)],
                                  "szFSoId string, szProductId string, szParentId string, szPaymentType string, "
                                  "szOrderItemTypeId string, decDiscFakturDPP double, decDiscFakturTax double")
    cancel = _df(spark, "cancel_message", [("SO5", True, "x"), ("SO5", False, "y"), ("SO1", False, None)])
    close = _df(spark, "close_note", [("CL1", True, T(2024, 11, 1)), ("CL2", False, T(2024, 11, 9)),
                                      ("CL3", True, None)])
    close_item = _df(spark, "close_note_item", [("CL1", "DN1"), ("CL2", "DN1"), ("CL3", "DN1"), ("CL1", "DN2")])
    return TrackingSources(sales_inquiry=si, sales_order=so, sales_order_item=soi, purchase_order=po,
                           purchase_order_item=poi, product=prod, customer=cust, category=cat,
                           delivery_order=do, wms_delivery=delv, order_bonus=bonus, cancel_message=cancel,
                           close_note=close, close_note_item=close_item)


def test_po_tracking_rows(spark):
    out = po_tracking_mtd(_tracking_db(spark), "2024-11-01", "2024-12-01").collect()
    got = sorted((r.sales_order_number, r.product_id, r.canceled_order, r.purchase_order_number, r.bStatusDN,
                  float(r.nett_amount_incl_ppn)) for r in out)
    assert got == [
        ("SO1", "P1", False, "PO1", False, 11.0 - 1.0 - 0.5),   # duplicate line collapsed; latest close note unapplied
        ("SO1", "P2", False, "PO1", False, 5.0),                # not selling, kept because PO1 has a buying line
        ("SO2", "P1", None, "CPO2", True, 11.0),                # trimmed customer PO number; DN2 closed
        ("SO5", "P1", False, "PO5", False, 11.0),               # the open cancel row lets it through
    ]


def test_sell_out_slices_and_publish(spark):
    raw = spark.createDataFrame(
        [("1", "2024-11-01", "GT", 1), ("2", "2024-11-1", "GT", 1), ("3", "2024-11-31", "MTI", 1),
         ("4", "2024-11-07T10", "GT", 1), ("5", "", "GT", 1), ("6", None, "GT", 1), ("7", "2024-11-15", "X", 1),
         ('{"$oid": "8"}', "2024-11-22", "OFFICE", 1)],
        "_id string, date_ string, channel_name string, qty bigint")
    # the last bound is no calendar date and is compared as text
    slices = [("2024-11-01", "2024-11-07"), ("2024-11-08", "2024-11-14"), ("2024-11-15", "2024-11-21"),
              ("2024-11-22", "2024-11-31")]
    df, obs = sell_out(raw, slices, ("GT", "MTI", "OFFICE"), observe=True)
    root = tempfile.mkdtemp(prefix="tradeflow-pub-")
    info = publish_sell_out(df, "sell_out_test", root, staging_json=os.path.join(root, "staging"))
    got = {r._id: r.date_ for r in spark.table("sell_out_test").collect()}
    # as text '2024-11-1' sorts between '2024-11-08' and '2024-11-14', so the second slice takes it;
    # '2024-11-31' passes and gets a null date; '2024-11-07T10' falls between slices
    assert got == {"1": dt.date(2024, 11, 1), "2": dt.date(2024, 11, 1), "3": None, "8": dt.date(2024, 11, 22)}
    assert info["rows"] == 4 and obs.get["rows"] == 4 and obs.get["slice_1"] == 1
    assert len(spark.table("sell_out_test").columns) == len(schemas.SELL_OUT_FIELDS)
    # a rerun publishes a new version; the table points at it, with the same content
    info2 = publish_sell_out(df, "sell_out_test", root)
    assert info2["path"] != info["path"] and spark.table("sell_out_test").count() == 4


def test_sliced_scan_overlap_keeps_bag_semantics(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5)], "k string, v int")
    assert sliced_scan(df, "v", [(0, 2), (1, 6)]).count() == 3
    assert sliced_scan(df, "v", [(0, 2), (3, 6)]).count() == 2
    both, obs = sliced_scan(df, "v", [(0, 5), (1, 6)], observe=True)
    assert len(both.collect()) == 4 and both.columns == ["k", "v"]
    assert (obs.get["slice_0"], obs.get["slice_1"], obs.get["rows"]) == (2, 2, 4)
