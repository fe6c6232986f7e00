"""Role mapping from the TPC-H-like test tables to the canonical sales tables.

The jobs are written against the sales system's tables; the test data is a
star schema of orders and lines. These views present the test tables in the
sales schema so that the same job code runs on both. Every view is a lazy
projection (or a join of two given tables), so its work grows with the data.

Mapping (fixed, documented in FIXTURES.md part B):

* ``lineitem`` -> invoice / order / purchase lines and their bonus rows;
  amount = extended price, discount = amount * l_discount,
  base (dpp) = amount - discount, tax = base * l_tax,
  taxable = ``l_linestatus = 'O'``, payment type = ``l_returnflag``
  (``A``, ``R`` stand for the bonus-bearing types), parent = supplier.
* ``orders`` -> invoice, delivery order and sales order headers; live =
  ``o_orderstatus <> 'P'``; period = order date.
* ``nation`` -> workplace (the ordering customer's nation) and delivery city;
  ``region`` -> parent sales organisation.
* ``part`` -> product and its technical spec (size as volume, retail price
  as weight); ``customer`` -> customer.
* ``events`` -> sell-out documents and approval items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import SourceSpec, read
from .invoice import InvoiceSources

# The test data's payment flags standing for the two
# bonus-bearing payment types, and the discount kind per return flag.
BONUS_PAY_FLAGS = ("A", "R")
DISC_KIND_BY_FLAG = {"A": "Invoice Disc. Item", "N": "Invoice Disc. Item 2", "R": "Invoice Disc."}


# Declared schemas of the test tables (TESTDATA.md).
TEST_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, with its declared schema."""
    return read(spark, SourceSpec(path=f"{sf_dir.rstrip('/')}/{name}.parquet", schema_ddl=TEST_DDL[name]))


def line_terms(li: DataFrame) -> DataFrame:
    """Money terms of a line, in the order the oracle SQL computes them."""
    amount = F.col("l_extendedprice")
    disc = amount * F.col("l_discount")
    dpp = amount - amount * F.col("l_discount")
    tax = (amount - amount * F.col("l_discount")) * F.col("l_tax")
    return li.select("*", amount.alias("decAmount"), disc.alias("decDiscount"), dpp.alias("decDPP"),
                     tax.alias("decTax"), (F.col("l_linestatus") == "O").alias("bTaxable"))


def invoice_item(li: DataFrame) -> DataFrame:
    """First lines are of type ``DOR``; the small ones of them name no product."""
    t = line_terms(li)
    first = F.col("l_linenumber") == 1
    return t.select(
        F.col("l_orderkey").alias("szFInvoiceId"), F.col("l_linenumber").alias("shItemNumber"),
        F.when(~(first & (F.col("l_quantity") < 5)), F.col("l_partkey")).alias("szProductId"),
        F.col("l_orderkey").alias("szDoId"), F.col("l_suppkey").alias("szParentId"),
        F.col("l_returnflag").alias("szPaymentType"), F.col("l_linestatus").alias("szOrderItemTypeId"),
        F.when(first, F.lit("DOR")).otherwise(F.col("l_returnflag")).alias("szInvItemType"),
        "bTaxable", F.col("l_quantity").alias("decQty"), "decAmount", "decDPP", "decTax", "decDiscount")


def invoice_item_bonus(li: DataFrame) -> DataFrame:
    return li.select(
        F.col("l_orderkey").alias("szFInvoiceId"), F.col("l_linenumber").alias("shItemNumber"),
        F.col("l_partkey").alias("szProductId"), F.col("l_orderkey").alias("szFDoId"),
        F.col("l_suppkey").alias("szParentId"), F.col("l_returnflag").alias("szPaymentType"),
        F.col("l_linestatus").alias("szOrderItemTypeId"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("decBonusAmount"))


def invoice_header(orders: DataFrame, customer: DataFrame) -> DataFrame:
    c = customer.select(F.col("c_custkey").alias("_ck"), F.col("c_nationkey").alias("szWorkplaceId"))
    j = orders.join(c, orders["o_custkey"] == c["_ck"], "left")
    return j.select(
        F.col("o_orderkey").alias("szFInvoiceId"), "szWorkplaceId", F.col("o_custkey").alias("szCustId"),
        F.pmod("o_custkey", F.lit(120)).alias("szSalesId"), F.col("o_orderdate").alias("dtmPeriode"),
        F.col("o_orderdate").alias("dtmCreated"), (F.col("o_orderstatus") == "P").alias("bVoid"),
        (~F.col("o_orderpriority").startswith("3")).alias("bApplied"))


def delivery_order(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("szDoId"), F.col("o_orderkey").alias("szFSoId"),
        F.col("o_orderpriority").alias("szCustPoId"), F.col("o_custkey").alias("szCustId"),
        F.when(F.col("o_orderkey") % 3 == 0, F.pmod("o_custkey", F.lit(25)).cast("int")).alias("szWorkplaceId"),
        F.col("o_orderkey").alias("szFInvoiceId"), F.pmod("o_custkey", F.lit(100)).alias("szVehicleId"),
        F.col("o_orderdate").alias("dtmDelivery"))


def delivery_reversal(li: DataFrame) -> DataFrame:
    return li.where(F.col("l_returnflag") == "R").select(
        F.col("l_linenumber").alias("szFReversalId"), F.col("l_orderkey").alias("szFDoId"),
        F.when(F.col("l_linenumber") == 7, F.col("l_partkey")).alias("szReverseDoId"), (F.col("l_linestatus") == "F").alias("bApplied"))


def customer_dim(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("szCustId"), F.col("c_name").alias("szName"),
        F.col("c_mktsegment").alias("CustszAddress_1"), F.col("c_nationkey").alias("szDeliverToCustId"),
        F.col("c_mktsegment").alias("szCategory_2"))


def location_dim(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").alias("szCustId"), F.lit(0).alias("btLocId"),
                         F.col("n_name").alias("LocationszCity"))


def employee_dim(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("szEmployeeId"), F.col("s_name").alias("szName"))


def workplace_dim(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").alias("szWorkplaceId"), F.col("n_name").alias("szName"),
                         F.col("n_regionkey").alias("szSalesOrgId"))


def product_dim(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("szProductId"), F.col("p_name").alias("szName"))


def product_spec(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("szProductId"), F.col("p_size").alias("decVolume"),
                       F.col("p_retailprice").alias("decWeight"))


def invoice_sources(spark: SparkSession, sf_dir: str) -> InvoiceSources:
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part")
    return InvoiceSources(
        invoice_item=invoice_item(li), invoice=invoice_header(orders, customer),
        workplace=workplace_dim(nation), customer=customer_dim(customer), product=product_dim(part),
        delivery_order=delivery_order(orders), delivery_reversal=delivery_reversal(li),
        customer_location=location_dim(nation), employee=employee_dim(table(spark, sf_dir, "supplier")),
        invoice_item_bonus=invoice_item_bonus(li), product_spec=product_spec(part))


# ---------------------------------------------------------------- order side

def disc_kind(flag_col: str = "l_returnflag"):
    c = F.col(flag_col)
    expr = F.when(c == "A", F.lit(DISC_KIND_BY_FLAG["A"]))
    expr = expr.when(c == "N", F.lit(DISC_KIND_BY_FLAG["N"]))
    return expr.otherwise(F.lit(DISC_KIND_BY_FLAG["R"]))


def so_item(li: DataFrame) -> DataFrame:
    t = line_terms(li)
    return t.select(
        F.col("l_orderkey").alias("szFSoId"), F.col("l_linenumber").alias("shItemNumber"),
        F.col("l_partkey").alias("szProductId"), F.col("l_suppkey").alias("szParentId"),
        F.col("l_returnflag").alias("szPaymentType"), F.col("l_linestatus").alias("szOrderItemTypeId"),
        disc_kind().alias("szPrincipalDiscRefId"), "bTaxable", F.col("l_quantity").alias("decQty"),
        "decAmount", "decDPP", "decTax")


def so_item_bonus(li: DataFrame) -> DataFrame:
    return li.select(
        F.col("l_orderkey").alias("szFSoId"), F.col("l_linenumber").alias("shItemNumber"),
        F.col("l_partkey").alias("szProductId"), F.col("l_suppkey").alias("szParentId"),
        F.col("l_returnflag").alias("szPaymentType"), F.col("l_linestatus").alias("szOrderItemTypeId"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("decBonusAmount"))


def so_header(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("szFSoId"), F.col("o_orderdate").alias("dtmOrder"),
                         F.col("o_orderdate").alias("dtmCreated"))


# ------------------------------------------------------------- order tracking

# Which order status plays which document role, the customer
# segments standing for the two channels, and the line flags standing for
# selling and buying item types.
SO_ONLY_STATUS = "F"        # inquiry without a purchase order id
PO_ONLY_STATUS = "P"        # inquiry without a sales order id
CHANNEL_BY_SEGMENT = {"AUTOMOBILE": "GT", "BUILDING": "MTI"}
LEVEL_BY_EVENT = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}


def _s(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def inquiry(orders: DataFrame) -> DataFrame:
    st, key = F.col("o_orderstatus"), _s("o_orderkey")
    return orders.select(
        F.when(st == PO_ONLY_STATUS, F.lit("")).otherwise(key).alias("szFSoId"),
        F.when(st == SO_ONLY_STATUS, F.lit("")).otherwise(key).alias("szFPoId"),
        key.alias("szFDoId"), key.alias("szFDnId"), _s("o_custkey").alias("szCustId"),
        F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") % 5).cast("int")).alias("istatusFlag"),
        _s(F.pmod("o_custkey", F.lit(7))).alias("szCarrierId"), _s(F.pmod("o_custkey", F.lit(100))).alias("szVehicleNo"),
        F.col("o_orderpriority").alias("szDriverNm"), _days(4).alias("dtmETA"))


def _days(n: int):
    return (F.col("o_orderdate") + F.expr(f"INTERVAL {n} DAYS")).cast("timestamp_ntz")


def sales_order(orders: DataFrame) -> DataFrame:
    pri = F.col("o_orderpriority")
    return orders.where(F.col("o_orderstatus") != PO_ONLY_STATUS).select(
        _s("o_orderkey").alias("szFSoId"), F.when(pri.like("1%"), F.lit("")).otherwise(pri).alias("szCustPoId"),
        _s("o_custkey").alias("gdApprovedId"), F.col("o_orderdate").alias("dtmCreated"),
        F.col("o_orderdate").alias("dtmOrder"), pri.alias("szPaymentTermId"), pri.like("2%").alias("bApplied"),
        (F.col("o_orderkey") % 11 == 0).alias("bVoid"), (F.col("o_orderkey") % 2 == 0).alias("bSentWMS"))


def purchase_order(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderstatus") != SO_ONLY_STATUS).select(
        _s("o_orderkey").alias("szFPo_sId"), F.col("o_orderstatus").alias("szStatus"),
        F.col("o_orderdate").alias("dtmCreated"), F.col("o_orderdate").alias("dtmPO"),
        (F.col("o_orderkey") % 13 == 0).alias("bVoid"))


def _item_type():
    return F.when(F.col("l_returnflag") == "N", F.lit("JUAL")).otherwise(F.lit("RETUR"))


def tracking_so_item(li: DataFrame) -> DataFrame:
    t = line_terms(li)
    return t.select(
        _s("l_orderkey").alias("szFSoId"), F.col("l_linenumber").alias("shItemNumber"),
        _s("l_partkey").alias("szProductId"), _s("l_suppkey").alias("szParentId"),
        F.col("l_returnflag").alias("szPaymentType"), _item_type().alias("szOrderItemTypeId"),
        disc_kind().alias("szPrincipalDiscRefId"), "bTaxable", F.col("l_quantity").alias("decQty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("decPrice"), "decAmount", "decDPP", "decTax")


def tracking_so_item_bonus(li: DataFrame) -> DataFrame:
    return li.select(
        _s("l_orderkey").alias("szFSoId"), F.col("l_linenumber").alias("shItemNumber"),
        _s("l_partkey").alias("szProductId"), _s("l_suppkey").alias("szParentId"),
        F.col("l_returnflag").alias("szPaymentType"), _item_type().alias("szOrderItemTypeId"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("decBonusAmount"))


def purchase_order_item(li: DataFrame) -> DataFrame:
    t = line_terms(li)
    kind = F.when(F.col("l_linestatus") == "O", F.lit("BELI")).when(F.col("l_returnflag") == "A", F.lit("BELI-BERIKAT"))
    return t.select(
        _s("l_orderkey").alias("szFPo_sId"), _s("l_partkey").alias("szProductId"),
        kind.otherwise(F.lit("LAIN")).alias("purchaseItemTypeId"), "bTaxable", F.col("l_quantity").alias("decQty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("decPrice"), "decAmount", "decDPP",
        F.col("decTax").alias("decPPN"), "decDiscount")


def po_receipt(orders: DataFrame) -> DataFrame:
    """Every third purchase order is received, every ninth twice."""
    key = F.col("o_orderkey")
    parts = F.when(key % 9 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return orders.where(key % 3 == 0).select("*", F.explode(parts).alias("_n")).select(
        F.concat(_s("o_orderkey"), F.lit("-"), _s("_n")).alias("szFPoReceipt_sId"), _s("o_orderkey").alias("szPoId"),
        _days(5).alias("dtmCreated"), _days(6).alias("dtmReceipt"))


def purchase_message(orders: DataFrame) -> DataFrame:
    return orders.select(_s("o_orderkey").alias("szDocId"), (F.col("o_custkey") % 3 != 0).alias("bAlreadyTransferred"),
                         _days(1).alias("dtmTransferred"))


def cancel_message(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderkey") % 7 == 0).select(
        _s("o_orderkey").alias("szDocId"), (F.col("o_custkey") % 2 == 0).alias("bAlreadyTransferred"),
        F.col("o_orderpriority").alias("szData"))


def approved(customer: DataFrame) -> DataFrame:
    return customer.where(F.col("c_custkey") % 2 == 0).select(
        _s("c_custkey").alias("gdApprovedId"), (F.col("c_acctbal") < 0).alias("bRejected"))


def approved_item(events: DataFrame) -> DataFrame:
    """One approval per document (user) and level (event type): the latest event."""
    level = F.lit(None).cast("int")
    for name, n in LEVEL_BY_EVENT.items():
        level = F.when(F.col("event_type") == name, F.lit(n)).otherwise(level)
    last = F.max(F.struct("ts", "event_id", "value")).alias("e")
    return events.groupBy(_s("user_id").alias("gdApprovedId"), level.alias("btApprovedLevel")).agg(last).select(
        "gdApprovedId", "btApprovedLevel", F.col("e.ts").alias("dtmApproved"), (F.col("e.value") > 50).alias("bApproved"))


def delivery_note(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderkey") % 5 != 0).select(_s("o_orderkey").alias("szFDNId"),
                                                             _days(3).alias("dtmLastUpdated"))


def delivery_note_item(li: DataFrame) -> DataFrame:
    return li.where(F.col("l_linenumber") <= 4).select(
        _s("l_orderkey").alias("szFDNId"), _s("l_partkey").alias("szProductId"), F.col("l_quantity").alias("decQty"))


def close_note(orders: DataFrame) -> DataFrame:
    return orders.select(_s("o_orderkey").alias("szCloseDNId"), F.col("o_orderpriority").like("2%").alias("bApplied"),
                         F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderdate")).alias("dtmLastUpdated"))


def close_note_item(orders: DataFrame) -> DataFrame:
    """Two close notes name each even delivery note."""
    key = F.col("o_orderkey")
    return orders.select(_s("o_orderkey").alias("szCloseDNId"), _s(key - key % 2).alias("szDNId"))


def do_history(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.where(key % 4 == 0).select(
        _s(key + 1).alias("szDoId"), _s(key - key % 8).alias("szDoIdOld"), F.col("o_orderdate").alias("dtmLastUpdated"))


def category_dim(customer: DataFrame) -> DataFrame:
    seg = F.col("szCategoryId")
    desc = F.lit("OTHER")
    for s, ch in reversed(list(CHANNEL_BY_SEGMENT.items())):
        desc = F.when(seg == s, F.lit(ch)).otherwise(desc)
    cats = customer.select(F.col("c_mktsegment").alias("szCategoryId")).distinct()
    return cats.select("szCategoryId", desc.alias("szDescription"))


def wms_delivery(li: DataFrame) -> DataFrame:
    """Delivery confirmations: one per order, shipped with its last line."""
    return li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("outTime")).select(
        _s("l_orderkey").alias("custOrderNo"), _s("l_orderkey").alias("orderNo"),
        _s("l_orderkey").alias("szDoRefId"), "outTime")


def wms_delivery_item(li: DataFrame) -> DataFrame:
    return li.select(_s("l_orderkey").alias("custOrderNo"), _s("l_orderkey").alias("orderNo"),
                     _s("l_partkey").alias("code"), F.col("l_quantity").alias("qty"))


def tracking_sources(spark: SparkSession, sf_dir: str):
    from .tracking_gt import WideTrackingSources

    li, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    return WideTrackingSources(
        sales_inquiry=inquiry(orders), sales_order=sales_order(orders), sales_order_item=tracking_so_item(li),
        purchase_order=purchase_order(orders), purchase_order_item=purchase_order_item(li),
        product=part.select(_s("p_partkey").alias("szProductId"), F.col("p_name").alias("szName")),
        customer=customer.select(_s("c_custkey").alias("szCustId"), F.col("c_name").alias("szName"),
                                 F.col("c_mktsegment").alias("szCategory_2")),
        category=category_dim(customer),
        delivery_order=orders.select(_s("o_orderkey").alias("szDoId"), _s("o_orderkey").alias("szFInvoiceId"),
                                     _days(2).alias("dtmDelivery")),
        wms_delivery=wms_delivery(li), sales_order_item_bonus=tracking_so_item_bonus(li), po_receipt=po_receipt(orders),
        purchase_message=purchase_message(orders), cancel_message=cancel_message(orders), approved=approved(customer),
        delivery_note=delivery_note(orders), close_note=close_note(orders), close_note_item=close_note_item(orders),
        wms_delivery_item=wms_delivery_item(li),
        invoice=orders.select(_s("o_orderkey").alias("szFInvoiceId"), F.col("o_orderdate").alias("dtmCreated")),
        invoice_item=li.select(_s("l_orderkey").alias("szFInvoiceId"), _s("l_partkey").alias("szProductId"),
                               _item_type().alias("szOrderItemTypeId"), F.col("l_quantity").alias("decQty")),
        approved_item=approved_item(table(spark, sf_dir, "events")), delivery_note_item=delivery_note_item(li),
        do_history=do_history(orders))


# ---------------------------------------------------------------- sell-out

def sell_out_documents(events: DataFrame) -> DataFrame:
    """Events as store sell-out documents with a text date."""
    k = F.get_json_object("props", "$.k")
    return events.select(
        _s("event_id").alias("_id"), F.date_format("ts", "MMMM").alias("month_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_"), F.col("event_type").alias("channel_name"),
        _s("user_id").alias("store_code"), k.alias("product_code"), k.cast("bigint").alias("qty"),
        F.col("value").alias("price"), F.col("value").alias("value"))
