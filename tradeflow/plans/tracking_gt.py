"""T3 wide order tracking: every line of a sales inquiry, from the sales order
if the inquiry has one, else from the purchase order, with prices, discounts,
receipt, delivery, invoice and approval state.

The source joins the sales lines and the purchase lines of an inquiry to each
other, filters the pairs and shows, per column, one side or the other (P4).
Here the inquiry is split by that switch before lines are joined:

* with a sales order id, rows come from the sales lines; the purchase side
  only says whether it has a buying line (one flag per purchase order);
* without one, rows are the purchase order's buying lines.

No pair of lines is built. Product-level lookups (delivered, invoiced and
received quantity, order bonus) hang on the sales line, as in the source, and
are zero or null for purchase lines. DISTINCT runs at the end, as in the
source, for what repeats (receipts, identical lines).

Every source table is read once. The inquiries of the window are resolved
first and written to the shared folder; all other inputs are cut down to the
documents that they name before anything is aggregated or shuffled. Inputs
that are needed in two roles (delivery orders with their invoices, invoice
lines, lines of sales and purchase orders) are cut down, written once and read
in both, and so are the documents' joined attributes before lines meet them.
Tables of lines are cut down with Spark's runtime filter on the documents'
ids, so lines of other documents are not shuffled where the ids are too many
to broadcast. Lines carry only the documents' row number and keys through
their lookups and meet the documents' wide attributes in one last join.

The five bound parameters are the bonus' order date (strictly after) and the
closed ranges of the purchase order's and the sales order's dates.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.exprs import closed_range, eq_blank, flag, is_blank, ne_blank, or_blank, or_default, or_zero, sentinel_ts
from ..operators.aggregates import delivered_qty, order_bonus
from ..operators.chains import written
from ..operators.joins import fallback, latest_per_key, pivot_levels, top1_global
from .tracking import BUY_ITEM_TYPES, SELL_ITEM_TYPE, TrackingSources, _p, latest_close_flag


@dataclass
class WideTrackingSources(TrackingSources):
    wms_delivery_item: DataFrame | None = None
    invoice: DataFrame | None = None
    invoice_item: DataFrame | None = None
    approved_item: DataFrame | None = None
    delivery_note_item: DataFrame | None = None
    do_history: DataFrame | None = None


BONUS_COLS = ["decDisc1DPP", "decDisc1Tax", "decDisc2DPP", "decDisc2Tax", "decDiscFakturDPP", "decDiscFakturTax"]
_QTY = ["qty_delivered", "qty_invoice", "qty_invoice_hist", "qty_note"]
# What lines and their lookups need of a document.
_KEYS = ["_doc", "_row", "si_szFSoId", "so_szFSoId", "so_dtmOrder", "po_szFPo_sId", "po_has_buy_line", "delv_custOrderNo",
         "delv_orderNo", "inv_szFInvoiceId", "invh_szFInvoiceId", "fdn_szFDNId"]
_LINE = ["szProductId", "decQty", "decPPN", "decDPP", "decAmountPOSO", *BONUS_COLS, "decPrice"]


def history_rows(do_history: DataFrame, scope: str = "global") -> DataFrame:
    """J17 which delivery order replaced which: the last row of the whole
    table (``global``, as the source has it) or of each replaced order
    (``per_key``). Ties go to the greater new id."""
    if scope == "global":
        top = top1_global(do_history, [F.col("dtmLastUpdated").desc_nulls_last(), F.col("szDoId").desc()])
    elif scope == "per_key":
        top = latest_per_key(do_history, "szDoIdOld", order_by=["dtmLastUpdated"], tie_break=["szDoId"], values=[])
    else:
        raise ValueError(f"unknown scope {scope!r}")
    return top.select(F.col("szDoIdOld").alias("hist_old"), F.col("szDoId").alias("hist_new"))


# Joins too large to broadcast filter the larger side by a Bloom filter of the other's keys: 8 MB, of which 8 million
# keys let 5 % of the other rows through.
RUNTIME_FILTER = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
                  "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10MB",
                  "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10GB",
                  "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
                  "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864"}


@contextmanager
def _runtime_filter(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in RUNTIME_FILTER}
    for k, v in RUNTIME_FILTER.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _named_in(df: DataFrame, column: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``ids``."""
    keys = ids.select(F.col(id_col).alias("_named"))
    return df.join(keys, df[column] == keys["_named"], "left_semi")


def _cut(df: DataFrame, column: str, ids: DataFrame, id_col: str, name: str) -> DataFrame:
    """Rows of ``df`` whose text ``column`` is among ``ids``, written once."""
    # True of every id but null, which names nothing: Spark makes a runtime filter only of keys that a comparison selects.
    ids = ids.where(F.col(id_col) >= F.lit(""))
    with _runtime_filter(df.sparkSession):
        return written(_named_in(df, column, ids, id_col), name)


def _sales_lines(x: DataFrame, src: WideTrackingSources, bills: DataFrame, bonus_since) -> DataFrame:
    """Rows with a sales order id: their sales lines and what hangs on the product."""
    item_cols = ["szFSoId", "szProductId", "szParentId", "szPaymentType", "szOrderItemTypeId", "bTaxable", "decQty",
                 "decPrice", "decAmount", "decDPP", "decTax"]
    notes = x.select("fdn_szFDNId").where("fdn_szFDNId IS NOT NULL")
    headers = x.select(F.col("so_szFSoId").alias("szFSoId"), F.col("so_dtmOrder").alias("dtmOrder")).where("szFSoId IS NOT NULL")
    soi_all = _cut(src.sales_order_item, "szFSoId", headers, "szFSoId", "so-lines")
    items = _p(soi_all, "soi_", item_cols)
    x = x.join(items, x["so_szFSoId"] == items["soi_szFSoId"], "left")
    x = x.where(F.coalesce(F.col("soi_szOrderItemTypeId") == SELL_ITEM_TYPE, F.lit(False))
                | F.coalesce(F.col("po_has_buy_line"), F.lit(False)))
    bonus_rows = _cut(src.sales_order_item_bonus, "szFSoId", headers, "szFSoId", "bonus-rows")
    bonus = order_bonus(soi_all, headers, bonus_rows, order_since=bonus_since, inclusive=False)
    keys = ["szFSoId", "szProductId", "szParentId", "szPaymentType", "szOrderItemTypeId"]
    b = _p(bonus, "bon_", [*keys, *BONUS_COLS])
    x = x.join(b, [x["soi_" + k] == b["bon_" + k] for k in keys], "left")
    product = F.col("soi_szProductId")

    sent = delivered_qty(_cut(src.wms_delivery_item, "custOrderNo", headers, "szFSoId", "delivered")).select(
        F.col("custOrderNo").alias("_c"), F.col("orderNo").alias("_o"), F.col("code").alias("_p"),
        F.col("qty").alias("qty_delivered"))
    x = x.join(sent, (x["delv_custOrderNo"] == sent["_c"]) & (x["delv_orderNo"] == sent["_o"])
               & (product == sent["_p"]), "left").drop("_c", "_o", "_p")
    billed = bills.select(
        F.col("szFInvoiceId").alias("_i"), F.col("szProductId").alias("_p"), F.col("szOrderItemTypeId").alias("_t"),
        F.col("decQty").alias("qty_invoice"))
    x = x.join(billed, (x["inv_szFInvoiceId"] == billed["_i"]) & (product == billed["_p"])
               & (x["soi_szOrderItemTypeId"] == billed["_t"]), "left").drop("_i", "_p", "_t")
    billed_h = bills.select(F.col("szFInvoiceId").alias("_i"), F.col("szProductId").alias("_p"),
                                       F.col("decQty").alias("qty_invoice_hist"))
    x = x.join(billed_h, (x["invh_szFInvoiceId"] == billed_h["_i"]) & (product == billed_h["_p"]), "left").drop("_i", "_p")
    noted = _cut(src.delivery_note_item.select("szFDNId", "szProductId", "decQty"), "szFDNId", notes, "fdn_szFDNId", "noted").select(
        F.col("szFDNId").alias("_n"), F.col("szProductId").alias("_p"), F.col("decQty").alias("qty_note"))
    x = x.join(noted, (x["fdn_szFDNId"] == noted["_n"]) & (product == noted["_p"]), "left").drop("_n", "_p")
    price = M.unit_price_net("soi_bTaxable", "soi_decDPP", "soi_decTax", F.col("soi_decPrice"))
    line = {"szProductId": product, "decQty": F.col("soi_decQty"), "decPPN": F.col("soi_decTax"),
            "decDPP": F.col("soi_decDPP"), "decAmountPOSO": F.col("soi_decAmount"), "decPrice": price}
    line |= {c: F.col("bon_" + c) for c in BONUS_COLS}
    return x.select("_doc", "_row", "fdn_szFDNId", "invh_szFInvoiceId", *_QTY, *[line[c].alias("line_" + c) for c in _LINE])


def _purchase_lines(x: DataFrame, po_lines: DataFrame) -> DataFrame:
    """Rows without a sales order id: the purchase order's buying lines (``po_lines``)."""
    cols = ["szFPo_sId", "szProductId", "bTaxable", "decQty", "decPrice", "decAmount", "decDPP", "decPPN", "decDiscount"]
    items = _p(po_lines, "poi_", cols)
    x = x.join(items, x["po_szFPo_sId"] == items["poi_szFPo_sId"], "inner")
    tax = ("poi_bTaxable", "poi_decDPP", "poi_decPPN")
    none = F.lit(0.0)
    line = {"szProductId": F.col("poi_szProductId"), "decQty": F.col("poi_decQty"), "decPPN": F.col("poi_decPPN"),
            "decDPP": F.col("poi_decDPP"), "decAmountPOSO": F.col("poi_decAmount"),
            "decDisc1DPP": M.po_discount_dpp(*tax, "poi_decDiscount"),
            "decDisc1Tax": M.po_discount_tax(*tax, "poi_decDiscount"),
            "decDisc2DPP": none, "decDisc2Tax": none, "decDiscFakturDPP": none, "decDiscFakturTax": none,
            "decPrice": M.unit_price_net(*tax, F.col("poi_decPrice"))}
    missing = [F.lit(None).cast("double").alias(c) for c in _QTY]
    return x.select("_doc", "_row", "fdn_szFDNId", "invh_szFInvoiceId", *missing, *[line[c].alias("line_" + c) for c in _LINE])


def po_tracking_gt(src: WideTrackingSources, *, bonus_since, po_from, po_to, so_from, so_to,
                   history_scope: str = "global") -> DataFrame:
    """T3 over the closed ranges ``[po_from, po_to]`` and ``[so_from, so_to]``."""
    so_cols = ["szFSoId", "szCustPoId", "gdApprovedId", "dtmCreated", "dtmOrder", "szPaymentTermId", "bApplied", "bVoid",
               "bSentWMS"]
    si = _p(src.sales_inquiry, "si_", ["szFSoId", "szFPoId", "szFDoId", "szFDnId", "szCustId", "istatusFlag", "szCarrierId",
                                       "szVehicleNo", "szDriverNm", "dtmETA"])
    so = _p(src.sales_order, "so_", so_cols)
    po = _p(src.purchase_order, "po_", ["szFPo_sId", "szStatus", "dtmCreated", "dtmPO", "bVoid"])
    # the purchase order's date where the inquiry has one, else the sales order's.
    x = (si.join(po.where(closed_range("po_dtmPO", po_from, po_to)),
                 ne_blank("si_szFPoId") & (F.col("si_szFPoId") == F.col("po_szFPo_sId")), "left")
         .join(so, F.col("si_szFSoId") == F.col("so_szFSoId"), "left")
         .where(F.col("po_szFPo_sId").isNotNull() | (eq_blank("si_szFPoId") & closed_range("so_dtmOrder", so_from, so_to))))
    x = written(x, "inquiries")
    buying = src.purchase_order_item.where(F.col("purchaseItemTypeId").isin(list(BUY_ITEM_TYPES)))
    po_lines = _cut(buying, "szFPo_sId", x, "po_szFPo_sId", "po-lines")
    buys = po_lines.select(F.col("szFPo_sId").alias("_po"), F.lit(True).alias("po_has_buy_line")).distinct()

    # Delivery orders of the inquiries and those that replaced them, with their invoices; and the invoices' lines.
    hist = written(history_rows(src.do_history, history_scope), "history")
    new = _named_in(hist, "hist_old", x, "si_szFDoId").select(F.col("hist_new").alias("_do"))
    do = _p(src.delivery_order, "do_", ["szDoId", "szFInvoiceId", "dtmDelivery"])
    do = _named_in(do, "do_szDoId", x.select(F.col("si_szFDoId").alias("_do")).unionByName(new), "_do")
    inv = _p(src.invoice, "inv_", ["szFInvoiceId", "dtmCreated"])
    docs = written(do.join(inv, do["do_szFInvoiceId"] == inv["inv_szFInvoiceId"], "left"), "documents")
    bill_cols = ["szFInvoiceId", "szProductId", "szOrderItemTypeId", "decQty"]
    bills = _cut(src.invoice_item.select(*bill_cols), "szFInvoiceId", docs, "inv_szFInvoiceId", "bills")

    inquiries = x
    x = x.join(buys, x["po_szFPo_sId"] == buys["_po"], "left").drop("_po")
    rec = _p(src.po_receipt.where(ne_blank("szPoId")), "rec_", ["szFPoReceipt_sId", "szPoId", "dtmCreated", "dtmReceipt"])
    rec = _named_in(rec, "rec_szPoId", inquiries, "po_szFPo_sId")
    x = x.join(rec, x["po_szFPo_sId"] == rec["rec_szPoId"], "left")
    later = docs.select(F.col("do_szDoId").alias("doh_szDoId"), F.col("inv_szFInvoiceId").alias("invh_szFInvoiceId"))
    replaced = docs.join(hist, docs["do_szDoId"] == hist["hist_old"], "left").join(later, F.col("hist_new") == later["doh_szDoId"], "left")
    x = x.join(replaced, x["si_szFDoId"] == replaced["do_szDoId"], "left")
    delv = _p(src.wms_delivery.where(ne_blank("custOrderNo")), "delv_", ["custOrderNo", "orderNo", "szDoRefId", "outTime"])
    delv = _cut(delv, "delv_custOrderNo", inquiries, "si_szFSoId", "deliveries")
    x = x.join(delv, (x["si_szFSoId"] == delv["delv_custOrderNo"]) & (x["do_szDoId"] == delv["delv_szDoRefId"]), "left")
    for table, prefix, cols in ((src.cancel_message, "cncl_", ["szDocId", "szData"]),
                                (src.purchase_message, "pm_", ["szDocId", "dtmTransferred"])):
        m = _named_in(_p(table.where(F.col("bAlreadyTransferred")), prefix, cols), prefix + "szDocId", inquiries, "si_szFSoId")
        x = x.join(m, x["si_szFSoId"] == m[prefix + "szDocId"], "left")
    fdn = _named_in(_p(src.delivery_note, "fdn_", ["szFDNId", "dtmLastUpdated"]), "fdn_szFDNId", inquiries, "si_szFDnId")
    x = x.join(fdn, x["si_szFDnId"] == fdn["fdn_szFDNId"], "left")
    closed = latest_close_flag(src.close_note, _named_in(src.close_note_item, "szDNId", inquiries, "si_szFDnId"))
    x = x.join(closed, x["si_szFDnId"] == closed["cl_dn"], "left")
    levels = pivot_levels(_named_in(src.approved_item, "gdApprovedId", inquiries, "so_gdApprovedId"), "gdApprovedId",
                          "btApprovedLevel", [1, 2, 3], {"dtmApproved": "dtmApproved", "bApproved": "bApproved"})
    levels = levels.withColumnRenamed("gdApprovedId", "_gd")
    x = x.join(levels, x["so_gdApprovedId"] == levels["_gd"], "left").drop("_gd")
    cust = _p(src.customer, "cust_", ["szCustId", "szName", "szCategory_2"])
    x = x.join(cust, x["si_szCustId"] == cust["cust_szCustId"], "left").drop("cust_szCustId")
    cat = _p(src.category, "cat_", ["szCategoryId", "szDescription"])
    x = x.join(cat, x["cust_szCategory_2"] == cat["cat_szCategoryId"], "left")

    po_id, done = F.trim(F.col("so_szCustPoId")), flag("so_bApplied") | flag("so_bVoid")
    level = (or_zero("max_level") + 1).cast("string")
    shown = {
        "szFPOid": F.when(is_blank(po_id), F.col("si_szFPoId")).otherwise(or_blank(po_id)),
        "gdApprovedId": F.col("so_gdApprovedId"), "statusPO": or_blank("po_szStatus"), "szCustId": F.col("si_szCustId"),
        "IstatusFlag": or_default("si_istatusFlag", 0), "szFSoId": F.col("si_szFSoId"),
        "dtmCreatedPO": sentinel_ts("po_dtmCreated"), "szFDoId": F.col("si_szFDoId"),
        "dtmCreatedSO": sentinel_ts("so_dtmCreated"), "szFDnId": F.col("si_szFDnId"),
        "dtmCreatedDO": sentinel_ts("delv_outTime"), "bSentWMS": F.col("so_bSentWMS"),
        "dtmCreatedGR": sentinel_ts("rec_dtmCreated"), "dtmReceiptPOrec": sentinel_ts("rec_dtmReceipt"),
        "szCarrierId": F.col("si_szCarrierId"), "dtmDelivery": sentinel_ts("do_dtmDelivery"),
        "dtmCreatedInv": sentinel_ts("inv_dtmCreated"), "dtmSendWMS": sentinel_ts("pm_dtmTransferred"),
        "custNm": F.col("cust_szName"), "dtmOrder": sentinel_ts("so_dtmOrder"), "szVehicleNo": F.col("si_szVehicleNo"),
        "szDriverNm": F.col("si_szDriverNm"), "bvoidPO": flag("po_bVoid"), "szPaymentTermId": F.col("so_szPaymentTermId"),
        "poDate": F.when(eq_blank("si_szFPoId"), F.col("so_dtmCreated")).otherwise(F.col("po_dtmCreated")),
        "podatefilter": F.when(eq_blank("si_szFPoId"), F.col("so_dtmOrder")).otherwise(F.col("po_dtmPO")),
        "szFPoReceipt_sId": or_blank("rec_szFPoReceipt_sId"), "dtmreceipt": sentinel_ts("rec_dtmReceipt"),
        **{c: None for c in _LINE}, "prodNm": None, "decQtyReceipt": None,
        "feedback": or_blank("delv_custOrderNo"), "decQtyDelivered": None, "bStatusDN": flag("cl_bApplied"),
        "szFInvoiceId": fallback("inv_szFInvoiceId", "invh_szFInvoiceId"), "decQtyInvoice": None,
        "szCustCat2": or_blank("cust_szCategory_2"), "szCustCat2Desc": or_blank("cat_szDescription"),
        "dtmETA": F.col("si_dtmETA"), "szDataCancelPO": or_blank("cncl_szData"),
        "currentApprovalLevel": F.when(done, F.lit("")).otherwise(level), "bVoid": F.col("so_bVoid"),
        **{c: v for n in (1, 2, 3) for c, v in ((f"dtmApproved{n}", sentinel_ts(f"dtmApproved{n}")),
                                                (f"bApproved{n}", F.col(f"bApproved{n}")))},
        "MaxLastUpdated": sentinel_ts("fdn_dtmLastUpdated")}
    # The shown columns of the documents, beside the keys of their lines. Columns without a value are the lines'.
    own = [c for c, v in shown.items() if v is not None]
    x = x.select(*_KEYS[2:], *[shown[c].alias("out_" + c) for c in own])
    x = x.select(F.xxhash64(*["out_" + c for c in own]).alias("_doc"), F.monotonically_increasing_id().alias("_row"), "*")
    x = written(x, "attributes")

    keys = x.select(*_KEYS)
    from_sales = _sales_lines(keys.where(~is_blank("si_szFSoId")), src, bills, bonus_since)
    from_purchase = _purchase_lines(keys.where(is_blank("si_szFSoId")), po_lines)
    y = from_sales.unionByName(from_purchase)
    prod = _p(src.product, "prod_", ["szProductId", "szName"])
    y = y.join(prod, y["line_szProductId"] == prod["prod_szProductId"], "left")
    lines = {**{c: F.col("line_" + c) for c in _LINE}, "prodNm": F.col("prod_szName"),
             "decQtyReceipt": F.when(is_blank("fdn_szFDNId"), F.lit(0.0)).otherwise(or_zero("qty_note")),
             "decQtyDelivered": or_zero("qty_delivered"),
             "decQtyInvoice": F.when(~is_blank("invh_szFInvoiceId"), or_zero("qty_invoice_hist")).otherwise(or_zero("qty_invoice"))}
    y = y.select("_doc", F.col("_row").alias("_of"), *[v.alias(c) for c, v in lines.items()])
    # ``_doc`` follows from what the documents show, so equal rows meet where the join has dealt them, and DISTINCT shuffles
    # nothing. The row number tells apart documents that show the same.
    x = x.select("_doc", "_row", *[F.col("out_" + c).alias(c) for c in own])
    y = y.join(x, "_doc").where(F.col("_of") - F.col("_row") == 0)
    return y.select("_doc", *shown).distinct().drop("_doc")
