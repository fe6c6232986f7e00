"""T2 month-to-date order tracking: every sales inquiry line from purchase
order to closed delivery note, with its milestone dates.

The source joins the sales-order lines and the purchase-order lines of an
inquiry to each other (lines x lines), filters the pairs with
``soi.type = 'JUAL' OR poi.type IN ('BELI', 'BELI-BERIKAT')`` and collapses
them with DISTINCT. Here the purchase lines are reduced to one flag per
purchase order ("has a buying line") before they meet the sales lines, so no
pair is ever built (``operators.joins.either_side_lines``); DISTINCT still
runs at the end for the remaining duplicates (identical lines, several
receipts, several cancel rows).

In this job a row also needs a warehouse delivery confirmation whose
customer-order number is the (non-blank) sales-order id, so an inquiry
without a sales order can never pass: all line fields come from the sales
order line. The purchase-order line columns of the source are dead code here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.exprs import eq_blank, is_blank, ne_blank, or_blank, sentinel_ts
from ..operators.aggregates import order_bonus
from ..operators.joins import latest_per_key

# Fixed values of the source query.
SELL_ITEM_TYPE = "JUAL"
BUY_ITEM_TYPES = ("BELI", "BELI-BERIKAT")
DEFAULT_CHANNELS = ("GT", "MTI")


@dataclass
class TrackingSources:
    sales_inquiry: DataFrame
    sales_order: DataFrame
    sales_order_item: DataFrame
    purchase_order: DataFrame
    purchase_order_item: DataFrame
    product: DataFrame
    customer: DataFrame
    category: DataFrame
    delivery_order: DataFrame
    wms_delivery: DataFrame
    order_bonus: DataFrame | None = None
    sales_order_item_bonus: DataFrame | None = None
    po_receipt: DataFrame | None = None
    purchase_message: DataFrame | None = None
    cancel_message: DataFrame | None = None
    approved: DataFrame | None = None
    delivery_note: DataFrame | None = None
    close_note: DataFrame | None = None
    close_note_item: DataFrame | None = None


def _p(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def _null(df: DataFrame, cols: dict) -> DataFrame:
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in cols.items()])


def latest_close_flag(close_note: DataFrame, close_note_item: DataFrame) -> DataFrame:
    """J15/M19 latest ``bApplied`` of the close notes naming a delivery note
    (ordered by last update, nulls last; ties by close-note id)."""
    items = close_note_item.select(F.col("szCloseDNId").alias("_cid"), F.col("szDNId").alias("dn"))
    j = close_note.join(items, close_note["szCloseDNId"] == items["_cid"], "inner")
    return latest_per_key(j, "dn", order_by=["dtmLastUpdated"], tie_break=["szCloseDNId"],
                          values=["bApplied"]).select(F.col("dn").alias("cl_dn"),
                                                      F.col("bApplied").alias("cl_bApplied"))


def po_tracking_mtd(src: TrackingSources, start, end, channels=DEFAULT_CHANNELS) -> DataFrame:
    """T2 over ``[start, end)``."""
    rng = lambda c: (F.col(c) >= F.lit(start)) & (F.col(c) < F.lit(end))

    si = _p(src.sales_inquiry, "si_", ["szFSoId", "szFPoId", "szFDoId", "szFDnId", "szCustId"])
    so = _p(src.sales_order.where(rng("dtmCreated")), "so_",
            ["szFSoId", "szCustPoId", "gdApprovedId", "dtmCreated", "dtmOrder"])
    # WHERE so.dtmCreated in range makes the left join inner
    x = si.join(so, si["si_szFSoId"] == so["so_szFSoId"], "inner")

    # purchase orders of the window, with their buying-line flag (one row per purchase order)
    bought = src.purchase_order.where(rng("dtmPO"))
    poi = src.purchase_order_item.join(bought.select("szFPo_sId"), "szFPo_sId", "left_semi")
    poi_flag = (poi.groupBy(F.col("szFPo_sId").alias("_po"))
                .agg(F.max(F.coalesce(F.col("purchaseItemTypeId").isin(list(BUY_ITEM_TYPES)), F.lit(False)))
                     .alias("po_has_buy_line")))
    po = _p(bought, "po_", ["szFPo_sId", "dtmCreated", "dtmPO"])
    po = po.join(poi_flag, po["po_szFPo_sId"] == poi_flag["_po"], "left").drop("_po")
    x = x.join(po, x["si_szFPoId"] == po["po_szFPo_sId"], "left")

    # PO date when the inquiry has a PO id, otherwise the SO date
    x = x.where((ne_blank("si_szFPoId") & F.col("po_szFPo_sId").isNotNull()) | (eq_blank("si_szFPoId") & rng("so_dtmOrder")))

    # warehouse delivery confirmation: needs the DO and a non-blank SO id
    do = _p(src.delivery_order, "do_", ["szDoId"])
    x = x.join(do, x["si_szFDoId"] == do["do_szDoId"], "left")
    delv = _p(src.wms_delivery.where(ne_blank("custOrderNo") & rng("outTime")), "delv_",
              ["custOrderNo", "szDoRefId", "outTime"])
    x = x.join(delv, (x["si_szFSoId"] == delv["delv_custOrderNo"]) & (x["do_szDoId"] == delv["delv_szDoRefId"]),
               "inner")

    cust = _p(src.customer, "cust_", ["szCustId", "szName", "szCategory_2"])
    x = x.join(cust, x["si_szCustId"] == cust["cust_szCustId"], "left")
    cat = _p(src.category.where(F.col("szDescription").isin(list(channels))), "cat_",
             ["szCategoryId", "szDescription"])
    x = x.join(cat, x["cust_szCategory_2"] == cat["cat_szCategoryId"], "inner")

    if src.cancel_message is not None:
        cncl = _p(src.cancel_message, "cncl_", ["szDocId", "bAlreadyTransferred"])
        x = x.join(cncl, x["si_szFSoId"] == cncl["cncl_szDocId"], "left")
    else:
        x = _null(x, {"cncl_bAlreadyTransferred": "boolean"})
    x = x.where(~F.coalesce(F.col("cncl_bAlreadyTransferred"), F.lit(False)))
    if src.approved is not None:
        rej = _p(src.approved, "rej_", ["gdApprovedId", "bRejected"])
        x = x.join(rej, x["so_gdApprovedId"] == rej["rej_gdApprovedId"], "left")
    else:
        x = _null(x, {"rej_bRejected": "boolean"})
    x = x.where(~F.coalesce(F.col("rej_bRejected"), F.lit(False)))

    # sales lines, kept if selling or if the purchase order has a buying line
    soi = _p(src.sales_order_item, "soi_", ["szFSoId", "szProductId", "szParentId", "szPaymentType",
                                            "szOrderItemTypeId", "decQty", "decAmount"])
    x = x.join(soi, x["so_szFSoId"] == soi["soi_szFSoId"], "left")
    x = x.where(F.coalesce(F.col("soi_szOrderItemTypeId") == SELL_ITEM_TYPE, F.lit(False)) |
                F.coalesce(F.col("po_has_buy_line"), F.lit(False)))

    prod = _p(src.product, "prod_", ["szProductId", "szName"])
    x = x.join(prod, x["soi_szProductId"] == prod["prod_szProductId"], "left")

    bonus = src.order_bonus
    if bonus is None and src.sales_order_item_bonus is not None:
        # A3 only for the sales orders this window can show (created in it),
        # aggregated before the join; the source's bonus date bound is the
        # window start
        scoped = src.sales_order.where(rng("dtmCreated"))
        bonus = order_bonus(src.sales_order_item, scoped, src.sales_order_item_bonus, order_since=start)
    if bonus is not None:
        b = _p(bonus, "bon_", ["szFSoId", "szProductId", "szParentId", "szPaymentType",
                                         "szOrderItemTypeId", "decDiscFakturDPP", "decDiscFakturTax"])
        keys = ["szFSoId", "szProductId", "szParentId", "szPaymentType", "szOrderItemTypeId"]
        x = x.join(b, [x["soi_" + k] == b["bon_" + k] for k in keys], "left")
    else:
        x = _null(x, {"bon_decDiscFakturDPP": "double", "bon_decDiscFakturTax": "double"})

    if src.po_receipt is not None:
        rec = _p(src.po_receipt.where(ne_blank("szPoId")), "rec_", ["szPoId", "dtmReceipt"])
        x = x.join(rec, x["po_szFPo_sId"] == rec["rec_szPoId"], "left")
    else:
        x = _null(x, {"rec_dtmReceipt": "timestamp_ntz"})
    if src.purchase_message is not None:
        pm = _p(src.purchase_message.where(F.col("bAlreadyTransferred")), "pm_", ["szDocId", "dtmTransferred"])
        x = x.join(pm, x["si_szFSoId"] == pm["pm_szDocId"], "left")
    else:
        x = _null(x, {"pm_dtmTransferred": "timestamp_ntz"})
    if src.delivery_note is not None:
        fdn = _p(src.delivery_note, "fdn_", ["szFDNId", "dtmLastUpdated"])
        x = x.join(fdn, x["si_szFDnId"] == fdn["fdn_szFDNId"], "left")
    else:
        x = _null(x, {"fdn_dtmLastUpdated": "timestamp_ntz"})
    if src.close_note is not None and src.close_note_item is not None:
        cl = latest_close_flag(src.close_note, src.close_note_item)
        x = x.join(cl, x["si_szFDnId"] == cl["cl_dn"], "left")
    else:
        x = _null(x, {"cl_bApplied": "boolean"})

    out = x.select(
        F.when(is_blank(F.trim(F.col("so_szCustPoId"))), F.col("si_szFPoId"))
         .otherwise(or_blank(F.trim(F.col("so_szCustPoId")))).alias("purchase_order_number"),
        sentinel_ts("po_dtmCreated").alias("date_created"),
        sentinel_ts("so_dtmCreated").alias("po_on_review_date"),
        sentinel_ts("so_dtmOrder").alias("po_approve_lv1_date"),
        F.col("si_szFSoId").alias("sales_order_number"),
        F.col("cncl_bAlreadyTransferred").alias("canceled_order"),
        F.col("rej_bRejected").alias("rejected_order"),
        sentinel_ts("pm_dtmTransferred").alias("send_to_wms_date"),
        F.col("si_szCustId").alias("customer_id"),
        F.col("cust_szName").alias("customer_name"),
        or_blank("cat_szDescription").alias("customer_category_description"),
        sentinel_ts("delv_outTime").alias("delivered_date_feedback_wms"),
        sentinel_ts("rec_dtmReceipt").alias("received_date"),
        F.when(eq_blank("si_szFPoId"), F.col("so_dtmCreated")).otherwise(F.col("po_dtmCreated")).alias("poDate"),
        F.col("soi_szProductId").alias("product_id"),
        F.col("prod_szName").alias("product_name"),
        F.col("soi_decQty").alias("qty_order"),
        F.col("soi_decAmount").alias("amount_incl_ppn_before_discount"),
        M.nett_amount_incl_ppn("soi_decAmount", "bon_decDiscFakturDPP", "bon_decDiscFakturTax")
         .alias("nett_amount_incl_ppn"),
        F.coalesce(F.col("cl_bApplied"), F.lit(False)).alias("bStatusDN"),
        sentinel_ts("fdn_dtmLastUpdated").alias("dn_closed_date"),
        F.col("si_szFDnId").alias("szfdnid"),
    )
    return out.distinct()
