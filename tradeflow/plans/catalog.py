"""Registered queries over the test tables: each one runs a library job or
operator on the role views of ``roles`` and returns a DataFrame.

Every query reads whole tables; dates, timestamps and money come out in a
fixed text or fixed-point form (``exprs.date_text``, ``exprs.exact_sum``) so
results are identical across partitionings and against the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.exprs import date_text, exact_sum, or_zero, safe_ratio, sentinel_ts, ts_text
from ..operators import aggregates as A
from ..operators import joins as J
from . import mart
from . import roles as R
from .invoice import invoice_lines, ordered_export, vehicle_load, workplace_settings
from .sellout import sell_out
from .tracking import po_tracking_mtd
from .tracking_gt import history_rows, po_tracking_gt

# Fixed parameters of the registered queries.
FLAGSHIP_PERIOD = ("1998-01-01", "1999-01-01")
FLAGSHIP_WORKPLACE_LIKE = "%1%"
BONUS_SINCE = "1995-06-01"
LOAD_PERIOD = ("1998-06-01", "1998-11-30")
TRACKING_WINDOW = ("1996-01-01", "1999-01-01")
WIDE_TRACKING = {"bonus_since": "1996-06-30", "po_from": "1997-01-01", "po_to": "1997-12-31",
                 "so_from": "1997-03-01", "so_to": "1998-02-28"}
SELL_OUT_WEEK = [("2024-01-08", "2024-01-14")]
SELL_OUT_TWO_WEEKS = [("2024-01-01", "2024-01-07"), ("2024-01-15", "2024-01-21")]
SELL_OUT_CHANNELS = ("click", "purchase", "view")
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _t(spark, sf, name):
    return R.table(spark, sf, name)


def q_invoice_lines(spark: SparkSession, sf: str) -> DataFrame:
    """T1 flagship: live invoice lines of one year, delivery workplace name
    like the pattern, with bonus-aware money measures."""
    src = R.invoice_sources(spark, sf)
    return invoice_lines(src, *FLAGSHIP_PERIOD,
                         workplace_filter=lambda: F.col("dow_szName").like(FLAGSHIP_WORKPLACE_LIKE),
                         bonus_pay_types=R.BONUS_PAY_FLAGS)


def q_ordered_export(spark, sf):
    """O1 the flagship report in its 22-key export order (nulls first)."""
    return ordered_export(q_invoice_lines(spark, sf))


def q_order_bonus(spark, sf):
    """A3 order bonus split by discount kind into base and tax parts."""
    li, orders = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    return A.order_bonus(R.so_item(li), R.so_header(orders), R.so_item_bonus(li), order_since=BONUS_SINCE)


def q_invoice_bonus(spark, sf):
    """A4 invoice bonus and its tax part, bonus-bearing payment types only."""
    li = _t(spark, sf, "lineitem")
    return A.invoice_bonus(R.invoice_item_bonus(li), R.invoice_item(li), pay_types=R.BONUS_PAY_FLAGS)


def q_without_reversed(spark, sf):
    """J7 delivery orders (orders) that no applied reversal names."""
    orders, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    kept = J.without_reversed(R.delivery_order(orders), "szDoId", R.delivery_reversal(li),
                              reversed_col="szFDoId", reversing_col="szReverseDoId", applied_col="bApplied",
                              reversal_id_col="szFReversalId")
    return kept.select("szDoId", "szCustId", "szCustPoId", date_text("dtmDelivery").alias("dtmDelivery"))


def q_latest_per_key(spark, sf):
    """W1/J15 latest event per user; ties by the higher event id."""
    ev = _t(spark, sf, "events")
    out = J.latest_per_key(ev, "user_id", order_by=["ts"], tie_break=["event_id"],
                           values=["event_type", "value"])
    return out.select("user_id", "event_id", ts_text("ts").alias("ts"), "event_type", "value")


def q_top1_global(spark, sf):
    """J17/O2 the last event of the whole table."""
    ev = _t(spark, sf, "events")
    top = J.top1_global(ev, [F.col("ts").desc_nulls_last(), F.col("event_id").desc()])
    return top.select("event_id", "user_id", ts_text("ts").alias("ts"), "event_type")


def q_vehicle_load(spark, sf):
    """T5/A5 volume and weight per vehicle of the delivery order and day."""
    src = R.invoice_sources(spark, sf)
    out = vehicle_load(src, *LOAD_PERIOD, workplace_filter=None)
    return out.select("szVehicleId", date_text("dtmDate").alias("dtmDate"), "decVolume", "decWeight")


def q_qty_preaggregated(spark, sf):
    """A1/A2/J14/M22 every order with its summed line quantity (0 if none)."""
    orders, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    q = A.sum_by(li, ["l_orderkey"], "l_quantity", "qty")
    j = orders.join(q, orders["o_orderkey"] == q["l_orderkey"], "left")
    return j.select("o_orderkey", F.coalesce(F.col("qty"), F.lit(0.0)).alias("qty_delivered"))


def q_delivered_qty(spark, sf):
    """A1 delivered quantity per customer order, product and delivery."""
    return A.delivered_qty(R.wms_delivery_item(_t(spark, sf, "lineitem")))


def q_invoiced_qty(spark, sf):
    """A2 invoiced quantity per invoice, product and item type."""
    return A.invoiced_qty(R.invoice_item(_t(spark, sf, "lineitem")), by_item_type=True)


def q_net_measures(spark, sf):
    """M3-M7/J2 every line with its bonus (A4 over all invoices) and the
    nett amounts and discounts."""
    li = _t(spark, sf, "lineitem")
    j = A.attach_invoice_bonus(R.invoice_item(li), R.invoice_item_bonus(li), pay_types=R.BONUS_PAY_FLAGS)
    tx, amt, dpp, tax, disc = (F.col(c) for c in ("bTaxable", "decAmount", "decDPP", "decTax", "decDiscount"))
    bon, bt = F.col("sumDecBonusAmount"), F.col("sumDecBonusAmountTax")
    return j.select(
        F.col("szFInvoiceId").alias("l_orderkey"), F.col("shItemNumber").alias("l_linenumber"),
        F.col("szProductId").alias("l_partkey"), F.col("szParentId").alias("l_suppkey"),
        M.tax_total(tax, bt).alias("Tax"), M.nett_amount(tx, amt, dpp, tax, disc, bon).alias("NettAmount"),
        M.nett_amount_inc_tax(tx, amt, dpp, tax, disc, bon, bt).alias("NettAmountIncTax"),
        M.discount_total(tx, dpp, tax, disc, bon).alias("Discount"),
        M.discount_item(tx, dpp, tax, disc).alias("DiscountItem"))


def q_po_discount(spark, sf):
    """M12/M13 purchase-line discount split (base and tax part) and unit
    price net of tax, for every line."""
    t = R.line_terms(_t(spark, sf, "lineitem"))
    price = safe_ratio("l_extendedprice", "l_quantity")
    return t.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        M.po_discount_dpp("bTaxable", "decDPP", "decTax", "decDiscount").alias("decDisc1DPP"),
        M.po_discount_tax("bTaxable", "decDPP", "decTax", "decDiscount").alias("decDisc1Tax"),
        M.unit_price_net(F.col("bTaxable"), F.col("decDPP"), F.col("decTax"), price).alias("decPrice"))


def q_settings_const_join(spark, sf):
    """J11 every customer with the one configuration row picked by constants
    only (region ASIA), attached as a broadcast of a provably single row."""
    cust = _t(spark, sf, "customer").select("c_custkey", "c_name")
    reg = _t(spark, sf, "region").where(F.col("r_name") == "ASIA")
    return J.attach_single_row(cust, reg)


def q_settings_pivot(spark, sf):
    """J12/T6 per workplace (nation) one row with one setting per item
    (customer segment); value = the largest balance."""
    c = _t(spark, sf, "customer")
    info = c.groupBy("c_nationkey", "c_mktsegment").agg(F.max("c_acctbal").alias("v")).select(
        F.lit("T").alias("szConfigTemplateId"), F.lit("WOR").alias("szConfigItemTypeId"),
        F.col("c_mktsegment").alias("szConfigItemId"), F.col("c_nationkey").alias("szConfigItemTypeValue"),
        F.col("v").alias("szValue"))
    return workplace_settings(info, template="T", item_type="WOR", items=SEGMENTS)


def q_approval_levels(spark, sf):
    """J16/J18/M20/M26 approval levels 1-3 side by side per document (user),
    dates defaulted, and the current level (highest of all types + 1). Levels
    repeat here: date and flag come from a level's latest event."""
    ev = _t(spark, sf, "events")
    lvl = F.lit(None).cast("int")
    for et, n in R.LEVEL_BY_EVENT.items():
        lvl = F.when(F.col("event_type") == et, F.lit(n)).otherwise(lvl)
    items = ev.select(F.col("user_id").alias("gdApprovedId"), lvl.alias("btApprovedLevel"),
                      F.col("ts").alias("dtmApproved"), (F.col("value") > 50).alias("bApproved"))
    p = J.pivot_levels(items, "gdApprovedId", "btApprovedLevel", [1, 2, 3],
                       {"dtmApproved": "dtmApproved", "bApproved": "bApproved"})
    return p.select(
        "gdApprovedId",
        *[ts_text(sentinel_ts(f"dtmApproved{n}")).alias(f"dtmApproved{n}") for n in (1, 2, 3)],
        *[F.col(f"bApproved{n}") for n in (1, 2, 3)],
        (or_zero("max_level") + 1).cast("string").alias("currentApprovalLevel"))


def q_hierarchy(spark, sf):
    """J8 climb three levels of the organisation (nation, parent pointer =
    region key) from each customer's nation."""
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    org = _t(spark, sf, "nation")
    out = J.climb(cust, "c_nationkey", org, "n_nationkey", "n_regionkey", "n_name", levels=3)
    return out.drop("c_nationkey")


def _sell_out_frame(df):
    return df.select(*[date_text("date_").alias("date_") if c == "date_" else F.col(c) for c in df.columns])


def q_sell_out(spark, sf):
    """T4 one text-date slice and three channels, cleaned."""
    docs = R.sell_out_documents(_t(spark, sf, "events"))
    return _sell_out_frame(sell_out(docs, SELL_OUT_WEEK, SELL_OUT_CHANNELS))


def q_sell_out_slices(spark, sf):
    """S3/U1 two separate slices appended (one scan, OR of ranges)."""
    docs = R.sell_out_documents(_t(spark, sf, "events"))
    return _sell_out_frame(sell_out(docs, SELL_OUT_TWO_WEEKS, SELL_OUT_CHANNELS))


def q_json_field(spark, sf):
    """S4 a field of a JSON text column, parsed with a declared schema."""
    ev = _t(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


def _unified(spark, sf):
    li, orders, ev = _t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "events")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    both = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    lines = mart.stage_facts(both, [
        ("sell_in", "l_shipdate", "l_suppkey", "l_partkey", "l_quantity", F.col("l_extendedprice"), None),
        ("sell_through", "o_orderdate", "o_custkey", "l_partkey", "l_quantity",
         F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("o_orderkey").isNotNull())])
    purchases = ev.where(F.col("event_type") == "purchase")
    sell_out_ = mart.stage_frame(purchases, "sell_out", "ts", "user_id",
                                 F.get_json_object("props", "$.k").cast("bigint"), F.lit(1.0), "value")
    return mart.all_stages([lines, sell_out_])


def q_unified_sales(spark, sf):
    """T7/U2 Sell-In, Sell-Through and Sell-Out at (stage, date, store, SKU)."""
    u = mart.unified_sales(_unified(spark, sf))
    return u.select("stage", date_text("date").alias("date"), "store", "sku", "qty", "value")


def q_stage_pivot(spark, sf):
    """A9 value per stage side by side per day, store and SKU."""
    p = mart.stage_pivot(_unified(spark, sf))
    return p.select(date_text("date").alias("date"), *[c for c in p.columns if c != "date"])


def q_sales_cube(spark, sf):
    """T8/A8 cube of order value over (nation, segment) with grouping id."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner").join(
        n, F.col("c_nationkey") == n["n_nationkey"], "inner")
    return mart.sales_summary(j, ["n_name", "c_mktsegment"], "o_totalprice", how="cube")


def q_sales_rollup(spark, sf):
    """T8/A8 roll-up of order value region > nation with grouping id."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, sf, "region").select("r_regionkey", "r_name")
    dims = n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner").join(dims, F.col("c_nationkey") == F.col("n_nationkey"))
    return mart.sales_summary(j, ["r_name", "n_name"], "o_totalprice", how="rollup")


def q_mtd_trend(spark, sf):
    """T8/W2/W3 order value per day, month-to-date total, previous day."""
    t = mart.mtd_trend(_t(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return t.select(date_text("day").alias("day"), "day_value", "mtd_value", "prev_day_value", "day_change")


def q_top_n(spark, sf):
    """T8/W4 three best parts per supplier by net revenue."""
    li = _t(spark, sf, "lineitem").select(
        "l_suppkey", "l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    return mart.top_n(li, ["l_suppkey"], "l_partkey", "rev", n=3)


def q_fallback_chain(spark, sf):
    """J19/J17(per key)/M23 each order's invoice id and invoiced quantity,
    taken from the customer's latest order when that is another order."""
    orders = _t(spark, sf, "orders")
    li = _t(spark, sf, "lineitem")
    hist = J.latest_per_key(orders.select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey",
                            order_by=["o_orderdate"], tie_break=["o_orderkey"], values=[])
    hist = hist.select(F.col("o_custkey").alias("h_cust"), F.col("o_orderkey").alias("h_key"))
    cur = orders.select("o_orderkey", "o_custkey")
    j = cur.join(hist, cur["o_custkey"] == hist["h_cust"], "left")
    alt = F.when(F.col("h_key") != F.col("o_orderkey"), F.col("h_key").cast("string"))
    j = j.select("o_orderkey", J.fallback(F.col("o_orderkey").cast("string"), alt).alias("szFInvoiceId"))
    qty = A.sum_by(li, ["l_orderkey"], "l_quantity", "qty").select(
        F.col("l_orderkey").cast("string").alias("q_key"), "qty")
    out = j.join(qty, j["szFInvoiceId"] == qty["q_key"], "left")
    return out.select("o_orderkey", "szFInvoiceId", F.coalesce(F.col("qty"), F.lit(0.0)).alias("decQtyInvoice"))


def q_fan_out_distinct(spark, sf):
    """J20/F10/A6 order lines kept when selling (flag N) or when the order has
    any open line, DISTINCT over the shown columns; no line pairs built."""
    o = _t(spark, sf, "orders").select("o_orderkey")
    li = _t(spark, sf, "lineitem")
    a = o.join(li.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag"),
               o["o_orderkey"] == F.col("l_orderkey"), "left")
    b = li.select(F.col("l_orderkey").alias("b_orderkey"), F.col("l_linestatus").alias("b_status"))
    kept = J.either_side_lines(a, b.withColumnRenamed("b_orderkey", "o_orderkey"), "o_orderkey",
                               F.col("l_returnflag") == "N", F.col("b_status") == "O")
    return kept.select("o_orderkey", "l_partkey", "l_quantity").distinct()


def _ts_as_text(df):
    return df.select(*[ts_text(f.name).alias(f.name) if f.dataType.typeName().startswith("timestamp") else F.col(f.name)
                       for f in df.schema.fields])


def q_po_tracking(spark, sf):
    """T2 order tracking with milestone dates over one window."""
    src = R.tracking_sources(spark, sf)
    return _ts_as_text(po_tracking_mtd(src, *TRACKING_WINDOW, channels=tuple(R.CHANNEL_BY_SEGMENT.values())))


def q_po_tracking_gt(spark, sf):
    """T3 wide tracking of sales and purchase lines with all five bounds."""
    return _ts_as_text(po_tracking_gt(R.tracking_sources(spark, sf), **WIDE_TRACKING))


def q_do_history(spark, sf):
    """J17 with scope per key: each delivery order's replacement and invoice."""
    orders = _t(spark, sf, "orders")
    hist = history_rows(R.do_history(orders), scope="per_key")
    do = R.delivery_order(orders).select(F.col("szDoId").cast("string").alias("szDoId"),
                                         F.col("szFInvoiceId").cast("string").alias("szFInvoiceId"))
    new = do.toDF("new_do", "new_invoice")
    j = do.join(hist, do["szDoId"] == hist["hist_old"], "left").join(new, hist["hist_new"] == new["new_do"], "left")
    return j.select("szDoId", F.col("hist_new").alias("szDoIdNew"),
                    J.fallback("szFInvoiceId", "new_invoice").alias("szFInvoiceId"))


def q_const_on_join(spark, sf):
    """J3 every customer with its finished orders' count and value: the
    status constant of the ON clause filters the right side before the
    left join, so customers without such orders are kept."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    o = _t(spark, sf, "orders")
    agg = (o.where(F.col("o_orderstatus") == "F").groupBy("o_custkey")
           .agg(F.count(F.lit(1)).alias("n_finished"), exact_sum("o_totalprice", 2).alias("finished_value")))
    j = J.filtered_lookup(c, agg, c["c_custkey"] == agg["o_custkey"])
    return j.select("c_custkey", "c_name", F.coalesce(F.col("n_finished"), F.lit(0)).alias("n_finished"),
                    F.coalesce(F.col("finished_value"), F.lit(0.0)).alias("finished_value"))


def q_computed_key_join(spark, sf):
    """J10 lines joined to the day's order count on a computed date key
    (ship day = order day); Spark picks the join."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    days = (_t(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
            .agg(F.count(F.lit(1)).alias("orders_that_day")))
    k = li.withColumn("ship_day", F.to_date("l_shipdate"))
    j = k.join(days, k["ship_day"] == days["day"], "left")
    return j.select("l_orderkey", "l_linenumber", date_text("ship_day").alias("ship_day"),
                    F.coalesce(F.col("orders_that_day"), F.lit(0)).alias("orders_that_day"))


def q_merge_join(spark, sf):
    """J13 a forced sort-merge join of two large sides: lines and headers."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return li.join(o.hint("merge"), li["l_orderkey"] == o["o_orderkey"], "left").drop("o_orderkey")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "invoice_lines": q_invoice_lines,
        "ordered_export": q_ordered_export,
        "order_bonus": q_order_bonus,
        "invoice_bonus": q_invoice_bonus,
        "without_reversed": q_without_reversed,
        "latest_per_key": q_latest_per_key,
        "top1_global": q_top1_global,
        "vehicle_load": q_vehicle_load,
        "qty_preaggregated": q_qty_preaggregated,
        "delivered_qty": q_delivered_qty,
        "invoiced_qty": q_invoiced_qty,
        "net_measures": q_net_measures,
        "po_discount": q_po_discount,
        "settings_const_join": q_settings_const_join,
        "settings_pivot": q_settings_pivot,
        "approval_levels": q_approval_levels,
        "hierarchy": q_hierarchy,
        "sell_out": q_sell_out,
        "sell_out_slices": q_sell_out_slices,
        "json_field": q_json_field,
        "unified_sales": q_unified_sales,
        "stage_pivot": q_stage_pivot,
        "sales_cube": q_sales_cube,
        "sales_rollup": q_sales_rollup,
        "mtd_trend": q_mtd_trend,
        "top_n": q_top_n,
        "fallback_chain": q_fallback_chain,
        "fan_out_distinct": q_fan_out_distinct,
        "po_tracking": q_po_tracking,
        "po_tracking_gt": q_po_tracking_gt,
        "do_history": q_do_history,
        "merge_join": q_merge_join,
        "const_on_join": q_const_on_join,
        "computed_key_join": q_computed_key_join,
    }
