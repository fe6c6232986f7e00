"""T1 invoice lines for a period, T5 vehicle load, T6 workplace settings.

The source writes one SQL text of 62 left joins, repeats most of it inside a
merge-joined vehicle-load block and adds 14 configuration joins; only a dozen
joins reach the output. Here the live part is one plan,
``live_invoice_lines``, that both jobs build on. The unused dimension joins
are left out; they are row-preserving only when their keys are unique. A load
can check that with ``operators.joins.assert_unique``; no job here calls it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.exprs import concat_key, ne_blank, or_blank
from ..operators import aggregates as A
from ..operators.joins import settings_pivot, without_reversed


@dataclass
class InvoiceSources:
    """Canonical tables (see ``sources.schemas``); optional ones may be None."""

    invoice_item: DataFrame
    invoice: DataFrame
    workplace: DataFrame
    customer: DataFrame
    product: DataFrame
    delivery_order: DataFrame | None = None
    delivery_reversal: DataFrame | None = None
    customer_location: DataFrame | None = None
    employee: DataFrame | None = None
    invoice_item_bonus: DataFrame | None = None
    product_spec: DataFrame | None = None


def _prefixed(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def workplace_like(pattern: str) -> Callable[[], Column]:
    """``DO_Workplace.szWorkplaceId LIKE pattern``."""
    return lambda: F.col("dow_szWorkplaceId").like(pattern)


def live_headers(src: InvoiceSources, start, end, closed_end: bool = False) -> DataFrame:
    """Invoice headers in the period that are not void and are applied."""
    per = F.col("dtmPeriode")
    in_period = (per >= F.lit(start)) & ((per <= F.lit(end)) if closed_end else (per < F.lit(end)))
    return src.invoice.where(in_period & (F.col("bVoid") == F.lit(False)) & (F.col("bApplied") == F.lit(True)))


def live_invoice_lines(src: InvoiceSources, start, end, workplace_filter: Callable[[], Column] | None,
                       closed_end: bool = False, bonus_pay_types=None) -> DataFrame:
    """Invoice lines of live invoices (not void, applied) in the period,
    without reversed delivery orders, whose delivery workplace passes
    ``workplace_filter``.

    Columns: the invoice line's own columns, invoice header as ``inv_*``,
    delivery order as ``do_*``, delivery workplace as ``dow_*``; with
    ``bonus_pay_types`` also the two bonus sums of A4 (over all lines of the
    live invoices, before lines are filtered).
    """
    inv_cols = ["szFInvoiceId", "szWorkplaceId", "szCustId", "szSalesId", "dtmPeriode"]
    inv = _prefixed(live_headers(src, start, end, closed_end), "inv_", inv_cols)

    items = src.invoice_item
    lines = items.join(inv, items["szFInvoiceId"] == inv["inv_szFInvoiceId"], "inner")
    if bonus_pay_types is not None:
        scope = inv.select(F.col("inv_szFInvoiceId").alias("_inv"))
        b = src.invoice_item_bonus
        lines = A.attach_invoice_bonus(lines, b.join(scope, b["szFInvoiceId"] == scope["_inv"], "left_semi"),
                                       pay_types=bonus_pay_types)
    typ = F.col("szInvItemType")
    lines = lines.where((ne_blank("szProductId") & (typ == "DOR")) | (typ != "DOR"))

    if src.delivery_order is not None:
        do_cols = ["szDoId", "szFSoId", "szCustPoId", "szCustId", "szWorkplaceId", "szVehicleId"]
        do = _prefixed(src.delivery_order, "do_", do_cols)
        lines = lines.join(do, lines["szDoId"] == do["do_szDoId"], "left")
        if src.delivery_reversal is not None:
            # J7 both roles; keyed on the line's DO id (same partitioning as
            # the join above), applied only where the delivery order was found
            lines = without_reversed(lines, "szDoId", src.delivery_reversal, reversed_col="szFDoId",
                                     reversing_col="szReverseDoId", applied_col="bApplied",
                                     reversal_id_col="szFReversalId",
                                     only_if=F.col("do_szDoId").isNotNull())
    else:
        for c in ["szDoId", "szFSoId", "szCustPoId", "szCustId", "szWorkplaceId", "szVehicleId"]:
            lines = lines.withColumn("do_" + c, F.lit(None).cast("string"))

    # J10 computed key: delivery workplace, falling back to the invoice's
    dow = _prefixed(src.workplace, "dow_", ["szWorkplaceId", "szName", "szSalesOrgId"])
    lines = lines.withColumn("_dow_key", F.coalesce(F.col("do_szWorkplaceId"), F.col("inv_szWorkplaceId")))
    lines = lines.join(dow, lines["_dow_key"] == dow["dow_szWorkplaceId"], "inner").drop("_dow_key")
    if workplace_filter is not None:
        lines = lines.where(workplace_filter())
    return lines


def invoice_lines(src: InvoiceSources, start, end, workplace_filter: Callable[[], Column] | None = None,
                  bonus_pay_types=("TDB", "DOB"), date_as_text: bool = True) -> DataFrame:
    """T1: one row per live invoice line with customer, product and the
    money measures M1-M8 (bonus and its tax part from A4)."""
    has_bonus = src.invoice_item_bonus is not None
    lines = live_invoice_lines(src, start, end, workplace_filter, bonus_pay_types=bonus_pay_types if has_bonus else None)
    bon, bon_tax = ((F.col("sumDecBonusAmount"), F.col("sumDecBonusAmountTax")) if has_bonus
                    else (F.lit(None).cast("double"), F.lit(None).cast("double")))

    wp = _prefixed(src.workplace, "wp_", ["szWorkplaceId", "szName"])
    lines = lines.join(wp, lines["inv_szWorkplaceId"] == wp["wp_szWorkplaceId"], "left")
    cust = _prefixed(src.customer, "cust_", ["szCustId", "szName", "CustszAddress_1"])
    lines = lines.join(cust, lines["inv_szCustId"] == cust["cust_szCustId"], "left")
    cdel = _prefixed(src.customer, "cdel_", ["szCustId", "szName", "szDeliverToCustId"])
    lines = lines.join(cdel, lines["do_szCustId"] == cdel["cdel_szCustId"], "left")
    if src.customer_location is not None:
        loc = _prefixed(src.customer_location.where(F.col("btLocId") == 0), "loc_",
                        ["szCustId", "LocationszCity"])
        lines = lines.join(loc, lines["cdel_szDeliverToCustId"] == loc["loc_szCustId"], "left")
    else:
        lines = lines.withColumn("loc_LocationszCity", F.lit(None).cast("string"))
    prod = _prefixed(src.product, "prod_", ["szProductId", "szName"])
    lines = lines.join(prod, lines["szProductId"] == prod["prod_szProductId"], "left")
    if src.employee is not None:
        emp = _prefixed(src.employee, "emp_", ["szEmployeeId", "szName"])
        lines = lines.join(emp, lines["inv_szSalesId"] == emp["emp_szEmployeeId"], "left")
    else:
        lines = lines.withColumn("emp_szName", F.lit(None).cast("string"))

    tx, amt, dpp, tax, disc = (F.col(c) for c in ("bTaxable", "decAmount", "decDPP", "decTax", "decDiscount"))
    order_date = F.to_date("inv_dtmPeriode")
    return lines.select(
        F.col("inv_szWorkplaceId").alias("WorkplaceId"),
        or_blank("wp_szName").alias("WorkplaceName"),
        or_blank("do_szCustPoId").alias("SoReference"),
        or_blank("do_szFSoId").alias("SoId"),
        or_blank("do_szDoId").alias("DoId"),
        F.col("inv_szFInvoiceId").alias("InvoiceId"),
        (F.date_format(order_date, "yyyy-MM-dd") if date_as_text else order_date).alias("OrderDate"),
        F.upper(F.col("inv_szSalesId").cast("string")).alias("SalesID"),
        F.col("emp_szName").alias("EmployeeName"),
        F.coalesce(F.col("do_szCustId"), F.col("inv_szCustId")).alias("CustomerId"),
        F.when(F.col("do_szCustId").isNotNull(), or_blank("cdel_szName"))
         .otherwise(or_blank("cust_szName")).alias("CustomerName"),
        or_blank("cust_CustszAddress_1").alias("Address"),
        F.col("loc_LocationszCity").alias("Muncipality"),
        F.col("szProductId").alias("ProductID"),
        or_blank("prod_szName").alias("ProductName"),
        M.price(amt, "decQty").alias("Price"),
        F.col("decQty").alias("Quantity"),
        M.gross_amount(tx, amt, dpp, tax, disc).alias("Amount"),
        M.tax_total(tax, bon_tax).alias("Tax"),
        M.nett_amount(tx, amt, dpp, tax, disc, bon).alias("NettAmount"),
        M.nett_amount_inc_tax(tx, amt, dpp, tax, disc, bon, bon_tax).alias("NettAmountIncTax"),
        M.discount_total(tx, dpp, tax, disc, bon).alias("Discount"),
        M.discount_item(tx, dpp, tax, disc).alias("DiscountItem"),
        concat_key("inv_szFInvoiceId", "szProductId").alias("InvoiceProductID"),
    )


# Fixed value: export order of the invoice-line report (O1), all ascending.
INVOICE_EXPORT_ORDER = [
    "WorkplaceId", "WorkplaceName", "SoId", "DoId", "InvoiceId", "OrderDate", "SalesID", "EmployeeName",
    "CustomerId", "CustomerName", "Address", "Muncipality", "ProductID", "ProductName", "Price",
    "Quantity", "Amount", "Tax", "NettAmount", "NettAmountIncTax", "Discount", "DiscountItem",
]


def ordered_export(df: DataFrame, order=INVOICE_EXPORT_ORDER) -> DataFrame:
    """O1 total order for an ordered file export (nulls first, as the source
    dialect sorts them). A table sink has no order; use this only for files."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order])


def vehicle_load(src: InvoiceSources, start, end, workplace_filter: Callable[[], Column] | None = None,
                 vehicle_col: str = "do_szVehicleId", closed_end: bool = True) -> DataFrame:
    """T5: loaded volume and weight per vehicle and day over the live lines
    (the source's merge-joined block; its period is a closed range)."""
    lines = live_invoice_lines(src, start, end, workplace_filter, closed_end=closed_end)
    return A.vehicle_load(lines, src.product_spec, vehicle_col=vehicle_col, date_col="inv_dtmPeriode")


def workplace_settings(config_info: DataFrame, *, template: str, item_type: str, items,
                       value_col: str = "szValue") -> DataFrame:
    """T6: a workplace's settings, the values of ``items``, as one row."""
    info = config_info.where((F.col("szConfigTemplateId") == template) &
                             (F.col("szConfigItemTypeId") == item_type))
    return settings_pivot(info, "szConfigItemTypeValue", "szConfigItemId", value_col, items)
