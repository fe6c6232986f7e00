"""Declared schemas of the canonical sales tables.

Column names follow the source system; types are read from the column
prefixes (``sz`` text, ``dtm`` timestamp without zone, ``dec`` decimal,
``b`` flag, ``sh``/``bt`` small integers, ``gd`` GUID text). Only columns the
jobs use are listed; readers select them, so scans prune the rest.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

DEC = "decimal(18,4)"

_DDL = {
    "sales_inquiry": "szFSoId string, szFPoId string, szFDoId string, szFDnId string, szCustId string, "
                     "istatusFlag int, szCarrierId string, szVehicleNo string, szDriverNm string, "
                     "dtmETA timestamp_ntz",
    "sales_order": "szFSoId string, szCustPoId string, gdApprovedId string, dtmCreated timestamp_ntz, "
                   "dtmOrder timestamp_ntz, szPaymentTermId string, bApplied boolean, bVoid boolean, "
                   "bSentWMS boolean",
    "sales_order_item": f"szFSoId string, shItemNumber short, szProductId string, szParentId string, "
                        f"szPaymentType string, szOrderItemTypeId string, szPrincipalDiscRefId string, "
                        f"bTaxable boolean, decQty {DEC}, decPrice {DEC}, decAmount {DEC}, decDPP {DEC}, "
                        f"decTax {DEC}",
    "sales_order_item_bonus": f"szFSoId string, shItemNumber short, szProductId string, szParentId string, "
                              f"szPaymentType string, szOrderItemTypeId string, decBonusAmount {DEC}",
    "purchase_order": "szFPo_sId string, szStatus string, dtmCreated timestamp_ntz, dtmPO timestamp_ntz, "
                      "bVoid boolean",
    "purchase_order_item": f"szFPo_sId string, szProductId string, purchaseItemTypeId string, "
                           f"bTaxable boolean, decQty {DEC}, decPrice {DEC}, decAmount {DEC}, "
                           f"decDPP {DEC}, decPPN {DEC}, decDiscount {DEC}",
    "po_receipt": "szFPoReceipt_sId string, szPoId string, dtmCreated timestamp_ntz, dtmReceipt timestamp_ntz",
    "delivery_order": "szDoId string, szFSoId string, szCustPoId string, szCustId string, "
                      "szWorkplaceId string, szFInvoiceId string, szVehicleId string, "
                      "dtmDelivery timestamp_ntz",
    "delivery_reversal": "szFReversalId string, szFDoId string, szReverseDoId string, bApplied boolean",
    "wms_delivery": "custOrderNo string, orderNo string, szDoRefId string, outTime timestamp_ntz",
    "wms_delivery_item": f"custOrderNo string, orderNo string, code string, qty {DEC}",
    "invoice": "szFInvoiceId string, szWorkplaceId string, szCustId string, szSalesId string, "
               "dtmPeriode timestamp_ntz, dtmCreated timestamp_ntz, bVoid boolean, bApplied boolean",
    "invoice_item": f"szFInvoiceId string, shItemNumber short, szProductId string, szDoId string, "
                    f"szParentId string, szPaymentType string, szOrderItemTypeId string, "
                    f"szInvItemType string, bTaxable boolean, decQty {DEC}, decAmount {DEC}, "
                    f"decDPP {DEC}, decTax {DEC}, decDiscount {DEC}",
    "invoice_item_bonus": f"szFInvoiceId string, shItemNumber short, szProductId string, szFDoId string, "
                          f"szParentId string, szPaymentType string, szOrderItemTypeId string, "
                          f"decBonusAmount {DEC}",
    "delivery_note": "szFDNId string, dtmLastUpdated timestamp_ntz",
    "delivery_note_item": f"szFDNId string, szProductId string, decQty {DEC}",
    "close_note": "szCloseDNId string, bApplied boolean, dtmLastUpdated timestamp_ntz",
    "close_note_item": "szCloseDNId string, szDNId string",
    "do_history": "szDoId string, szDoIdOld string, dtmLastUpdated timestamp_ntz",
    "approved": "gdApprovedId string, bRejected boolean",
    "approved_item": "gdApprovedId string, btApprovedLevel short, bApproved boolean, dtmApproved timestamp_ntz",
    "purchase_message": "szDocId string, bAlreadyTransferred boolean, dtmTransferred timestamp_ntz",
    "cancel_message": "szDocId string, bAlreadyTransferred boolean, szData string",
    "customer": "szCustId string, szName string, CustszAddress_1 string, szDeliverToCustId string, "
                "szCategory_2 string",
    "customer_location": "szCustId string, btLocId short, LocationszCity string",
    "category": "szCategoryId string, szDescription string",
    "product": "szProductId string, szName string",
    "product_spec": f"szProductId string, decVolume {DEC}, decWeight {DEC}",
    "workplace": "szWorkplaceId string, szName string, szSalesOrgId string",
    "sales_org": "szSalesOrgId string, szParentSalesOrgId string",
    "employee": "szEmployeeId string, szName string, szSupervisorId string",
    "config_info_item": "szConfigTemplateId string, szConfigItemTypeId string, szConfigItemId string, "
                        "szConfigItemTypeValue string, szValue string",
}

# Sell-out documents as they arrive (date still text) and as published.
SELL_OUT_FIELDS = [
    "_id", "month_name", "date_", "channel_name", "account_name", "store_code", "store_name",
    "employee_nik", "employee_name", "position_name", "agency_name", "leader", "cluster_name",
    "product_brand_name", "product_code", "product_name", "qty", "price", "value",
]
_SELL_OUT_TYPES = {"qty": "bigint", "price": "double", "value": "double"}
SELL_OUT_RAW_DDL = ", ".join(f"`{f}` {_SELL_OUT_TYPES.get(f, 'string')}" for f in SELL_OUT_FIELDS)
SELL_OUT_DDL = ", ".join(
    f"`{f}` {'date' if f == 'date_' else _SELL_OUT_TYPES.get(f, 'string')}" for f in SELL_OUT_FIELDS)


#: Compares without regard to case and trailing blanks, as the source database does.
KEY_COLLATION = "UTF8_LCASE_RTRIM"


def collated(df, columns=None):
    """``df`` with its text columns (or those named) typed by :data:`KEY_COLLATION`: equality, grouping, DISTINCT and joins
    on them then follow the source's rule (2.9 item 2), with no function around the key."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)] if columns is None else list(columns)
    return df.select(*[F.collate(F.col(f"`{c}`"), KEY_COLLATION).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def plain_text(df):
    """Text columns back to the default collation, for sinks and other engines."""
    return df.select(*[F.collate(F.col(f"`{f.name}`"), "UTF8_BINARY").alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def ddl(name: str) -> str:
    if name == "sell_out_raw":
        return SELL_OUT_RAW_DDL
    if name == "sell_out":
        return SELL_OUT_DDL
    return _DDL[name]


def schema(name: str) -> StructType:
    return StructType.fromDDL(ddl(name))
