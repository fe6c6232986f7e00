"""Aggregates of the source queries: delivered and invoiced quantities, the
order bonus split, the invoice bonus and its tax part, vehicle load.

All are ``groupBy().agg()`` plans, so Spark computes partial aggregates on the
map side before the shuffle; a key holding a third of the rows is combined
per task, never gathered whole.

Bonus rows are matched to their line by (document, item number). A line key
may repeat in dirty data; instead of joining bonus rows to every copy (which
builds all pairs of a key) the line side is first reduced to one row per key
carrying summed weights, and each bonus row is multiplied by them. For a
unique line key this is the same sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.exprs import exact_sum

# Scales of the sums: money terms to 1e-6, weights and ratios to 1e-12.
MONEY_SCALE = 6
RATIO_SCALE = 12
#: Keys over which rows with a null join key are spread.
NULL_SPREAD = 1024


def sum_by(df: DataFrame, keys: Sequence[str], measure: str, alias: str,
           scale: int | None = None) -> DataFrame:
    """A1/A2 ``SELECT keys, SUM(measure) ... GROUP BY keys``."""
    agg = exact_sum(measure, scale) if scale is not None else F.sum(measure)
    return df.groupBy(*keys).agg(agg.alias(alias))


def order_bonus(so_items: DataFrame, so_headers: DataFrame, bonus_src: DataFrame, *,
                order_since, inclusive: bool = True, strict: bool = False, so_key: str = "szFSoId",
                item_no: str = "shItemNumber") -> DataFrame:
    """A3 with M10/M11: per sales order and bonus (product, parent, payment
    type, item type), the six discount columns split into base and tax part
    by discount kind of the order line.

    ``order_since`` bounds the order date (``>=`` or ``>`` by ``inclusive``);
    the left joins of the source become inner through its WHERE clause. An
    untaxed bonus of the second and the invoice kind counts in the source both
    as base and as tax (M11); with ``strict`` its tax part is 0.
    """
    hdr = so_headers.select(F.col(so_key).alias("_so"), F.col("dtmOrder"))
    since = F.col("dtmOrder") >= F.lit(order_since) if inclusive else F.col("dtmOrder") > F.lit(order_since)
    hdr = hdr.where(since).select("_so")

    kind, tx, dpp, tax = F.col("szPrincipalDiscRefId"), F.col("bTaxable"), F.col("decDPP"), F.col("decTax")
    w_dpp = M.bonus_dpp_weight(tx, dpp, tax)

    def w(kind_value, weight):
        return exact_sum(F.when(kind == kind_value, weight).otherwise(F.lit(0.0)), RATIO_SCALE)

    lines = (so_items.join(hdr, so_items[so_key] == hdr["_so"], "left_semi")
             .groupBy(F.col(so_key).alias("_so"), F.col(item_no).alias("_item"))
             .agg(w(M.DISC_ITEM, w_dpp).alias("w1d"),
                  w(M.DISC_ITEM, M.bonus_tax_weight(tx, dpp, tax, False)).alias("w1t"),
                  w(M.DISC_ITEM_2, w_dpp).alias("w2d"),
                  w(M.DISC_ITEM_2, M.bonus_tax_weight(tx, dpp, tax, not strict)).alias("w2t"),
                  w(M.DISC_INVOICE, w_dpp).alias("wfd"),
                  w(M.DISC_INVOICE, M.bonus_tax_weight(tx, dpp, tax, not strict)).alias("wft")))

    b = bonus_src.where(F.col("szProductId").isNotNull())
    j = b.join(lines, (b[so_key] == lines["_so"]) & (b[item_no] == lines["_item"]), "inner")
    amt = F.col("decBonusAmount")
    out_cols = {"decDisc1DPP": "w1d", "decDisc1Tax": "w1t", "decDisc2DPP": "w2d",
                "decDisc2Tax": "w2t", "decDiscFakturDPP": "wfd", "decDiscFakturTax": "wft"}
    return (j.groupBy(F.col(so_key), "szProductId", "szParentId", "szPaymentType", "szOrderItemTypeId")
            .agg(*[exact_sum(amt * F.col(wc), MONEY_SCALE).alias(name) for name, wc in out_cols.items()]))


def invoice_bonus(bonus_src: DataFrame, items: DataFrame, *, pay_types: Sequence[str],
                  inv_key: str = "szFInvoiceId", item_no: str = "shItemNumber") -> DataFrame:
    """A4 with M9: per invoice, product, delivery order, parent, payment type
    and item type of the bonus row, the bonus sum and its tax part
    (``bonus * line tax / line discount``, 0 for a line without discount).
    Only lines whose payment type is in ``pay_types`` carry bonuses."""
    ratio = M.bonus_tax_term(F.lit(1.0), F.col("decTax"), F.col("decDiscount"))
    lines = (items.where(F.col("szPaymentType").isin(list(pay_types)))
             .groupBy(F.col(inv_key).alias("_inv"), F.col(item_no).alias("_item"))
             .agg(F.count(F.lit(1)).alias("_n"),
                  exact_sum(ratio, RATIO_SCALE).alias("_ratio")))
    j = bonus_src.join(lines, (bonus_src[inv_key] == lines["_inv"]) & (bonus_src[item_no] == lines["_item"]),
                       "inner")
    amt = F.col("decBonusAmount")
    return (j.groupBy(F.col(inv_key), "szProductId", "szFDoId", "szParentId", "szPaymentType",
                      "szOrderItemTypeId")
            .agg(exact_sum(amt * F.col("_n"), MONEY_SCALE).alias("sumDecBonusAmount"),
                 exact_sum(amt * F.col("_ratio"), MONEY_SCALE).alias("sumDecBonusAmountTax")))


def attach_invoice_bonus(lines: DataFrame, bonus_src: DataFrame, *, pay_types: Sequence[str],
                         inv_key: str = "szFInvoiceId", item_no: str = "shItemNumber",
                         do_key: str = "szDoId") -> DataFrame:
    """A4 as columns of the invoice lines: ``lines`` with ``sumDecBonusAmount``
    and ``sumDecBonusAmountTax`` (null where :func:`invoice_bonus` has no row
    for the line's six keys). ``lines`` must hold all lines of its invoices.

    The lines' weights and the bonus sums are grouped aggregates, combined in
    each task before their shuffles, so a hot invoice meets as one row per
    task and (invoice, item), then per six keys. The sums join back as a left
    join with the lines on its left, the side that AQE can split. Rows with a
    null among the six keys never match; each is sent under a key of its own
    spread, so that a null invoice with a third of all rows is no hot key.
    """
    keys = [inv_key, "szProductId", do_key, "szParentId", "szPaymentType", "szOrderItemTypeId"]
    sums = invoice_bonus(bonus_src, lines, pay_types=pay_types, inv_key=inv_key, item_no=item_no)
    whole = reduce(lambda a, c: a & c, [F.col(k).isNotNull() for k in keys])
    spread = F.when(whole, F.lit(0)).otherwise(F.pmod(F.xxhash64(*lines.columns), F.lit(NULL_SPREAD)).cast("int") + 1)
    right = sums.select(*[F.col("szFDoId" if k == do_key else k).alias("_r_" + k) for k in keys], F.lit(0).alias("_r_spread"),
                        "sumDecBonusAmount", "sumDecBonusAmountTax")
    left = lines.withColumn("_spread", spread)
    on = reduce(lambda a, k: a & (left[k] == right["_r_" + k]), keys, left["_spread"] == right["_r_spread"])
    return left.join(right, on, "left").select(*lines.columns, "sumDecBonusAmount", "sumDecBonusAmountTax")


def vehicle_load(lines: DataFrame, spec: DataFrame, *, vehicle_col: str, date_col: str,
                 qty_col: str = "decQty", product_col: str = "szProductId",
                 spec_key: str = "szProductId", volume_col: str = "decVolume",
                 weight_col: str = "decWeight", divisor: float = 1000.0) -> DataFrame:
    """A5/M25: volume and weight loaded per vehicle and day from the live
    invoice lines; non-positive quantities count 0, a missing spec 0."""
    s = spec.select(F.col(spec_key).alias("_p"), F.col(volume_col).alias("_vol"),
                    F.col(weight_col).alias("_wt"))
    j = lines.join(s, lines[product_col] == s["_p"], "left")
    day = F.to_date(F.col(date_col))
    return (j.groupBy(F.col(vehicle_col).alias("szVehicleId"), day.alias("dtmDate"))
            .agg(exact_sum(M.positive_load(qty_col, "_vol", divisor), 6).alias("decVolume"),
                 exact_sum(M.positive_load(qty_col, "_wt", divisor), 6).alias("decWeight")))


def delivered_qty(delivery_items: DataFrame) -> DataFrame:
    """A1 ``SELECT custOrderNo, code, orderNo, SUM(qty) ... GROUP BY``."""
    return delivery_items.groupBy("custOrderNo", "code", "orderNo").agg(F.sum("qty").alias("qty"))


def invoiced_qty(invoice_items: DataFrame, by_item_type: bool = False) -> DataFrame:
    """A2 invoiced quantity per invoice and product (and item type)."""
    keys = ["szFInvoiceId", "szProductId"] + (["szOrderItemTypeId"] if by_item_type else [])
    return invoice_items.groupBy(*keys).agg(F.sum("decQty").alias("decQty"))
