"""Oracle SQL (DuckDB dialect, ANSI where possible) for the registered
queries. Each text states the query the way the source system's SQL does:
left joins, WHERE filters, CASE measures. Money sums use the same fixed-point
rule as ``exprs.exact_sum`` so results compare exactly.
"""

from __future__ import annotations


def fsum(expr: str, scale: int) -> str:
    """Sum in whole units, the SQL twin of ``exprs.exact_sum``."""
    f = f"CAST(1e{scale} AS DOUBLE)"
    return f"CAST(SUM(CAST(round_even(({expr}) * {f}, 0) AS HUGEINT)) AS DOUBLE) / {f}"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def date_text(c: str) -> str:
    return f"strftime(CAST({c} AS DATE), '%Y-%m-%d')"


LI = """li AS (
  SELECT *, l_extendedprice AS amount, l_extendedprice * l_discount AS disc,
         l_extendedprice - l_extendedprice * l_discount AS dpp,
         (l_extendedprice - l_extendedprice * l_discount) * l_tax AS tax,
         l_linestatus = 'O' AS taxable,
         CASE WHEN NOT (l_linenumber = 1 AND l_quantity < 5) THEN l_partkey END AS prod,
         CASE WHEN l_linenumber = 1 THEN 'DOR' ELSE l_returnflag END AS inv_type
  FROM lineitem)"""

_REVERSED = """SELECT l_orderkey AS k FROM lineitem
        WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber IS NOT NULL AND l_orderkey IS NOT NULL
        UNION ALL
        SELECT l_partkey FROM lineitem
        WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 7 AND l_partkey IS NOT NULL"""

# live invoice lines: header in period and not void, delivery order found and
# not reversed, delivery workplace = the customer's nation
def _live_lines(start: str, end: str, closed: bool, wp_pred: str | None) -> str:
    op = "<=" if closed else "<"
    where_wp = f"WHERE {wp_pred}" if wp_pred else ""
    return f"""inv AS (
  SELECT o.o_orderkey AS inv_id, o.o_custkey AS inv_cust, o.o_custkey % 120 AS inv_sales,
         o.o_orderdate AS inv_date, c.c_nationkey AS inv_wp
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderdate >= TIMESTAMP '{start}' AND o.o_orderdate {op} TIMESTAMP '{end}'
    AND o.o_orderstatus <> 'P' AND o.o_orderpriority NOT LIKE '3%'),
rev AS ({_REVERSED}),
lines AS (
  SELECT li.*, inv.*, d.o_orderkey AS do_id, d.o_orderpriority AS do_custpo, d.o_custkey AS do_cust,
         CASE WHEN d.o_orderkey % 3 = 0 THEN d.o_custkey % 25 END AS do_wp, d.o_custkey % 100 AS do_vehicle
  FROM li JOIN inv ON li.l_orderkey = inv.inv_id
  LEFT JOIN orders d ON d.o_orderkey = li.l_orderkey
  WHERE ((CAST(li.prod AS VARCHAR) <> '' AND li.inv_type = 'DOR') OR li.inv_type <> 'DOR')
    AND NOT (d.o_orderkey IS NOT NULL AND li.l_orderkey IN (SELECT k FROM rev))),
lw AS (
  SELECT lines.*, dow.n_name AS dow_name FROM lines JOIN nation dow ON dow.n_nationkey = coalesce(lines.do_wp, lines.inv_wp)
  {where_wp})"""


_RATIO = "CASE WHEN disc = 0 THEN 0.0 ELSE 1.0 * tax / disc END"


def _invoice_bonus(scope_filter: str) -> str:
    return f"""bl AS (
  SELECT l_orderkey AS inv, l_linenumber AS item, COUNT(*) AS n, {fsum(_RATIO, 12)} AS ratio
  FROM li WHERE l_returnflag IN ('A', 'R') {scope_filter} GROUP BY 1, 2),
a AS (
  SELECT b.l_orderkey AS a_inv, b.l_partkey AS a_prod, b.l_orderkey AS a_do, b.l_suppkey AS a_parent,
         b.l_returnflag AS a_pay, b.l_linestatus AS a_itype,
         {fsum('b.disc * bl.n', 6)} AS bonus_amt, {fsum('b.disc * bl.ratio', 6)} AS bonus_tax
  FROM li b JOIN bl ON b.l_orderkey = bl.inv AND b.l_linenumber = bl.item
  WHERE 1 = 1 {scope_filter.replace('l_orderkey', 'b.l_orderkey')}
  GROUP BY 1, 2, 3, 4, 5, 6)"""


_SPLIT_OK = "dpp + tax <> 0"
_AMOUNT = f"CASE WHEN NOT taxable THEN amount WHEN {_SPLIT_OK} THEN dpp + disc * dpp / (dpp + tax) ELSE dpp + tax END"
_NETT = ("CASE WHEN NOT taxable THEN amount - disc - coalesce(bonus_amt, 0) "
         f"WHEN {_SPLIT_OK} THEN dpp - coalesce(bonus_amt, 0) * dpp / (dpp + tax) ELSE dpp + tax END")
_DISC_ITEM = f"CASE WHEN NOT taxable THEN disc WHEN {_SPLIT_OK} THEN disc * dpp / (dpp + tax) ELSE dpp + tax END"
_DISC_BONUS = ("CASE WHEN NOT taxable THEN coalesce(bonus_amt, 0) "
               f"WHEN {_SPLIT_OK} THEN coalesce(bonus_amt, 0) * dpp / (dpp + tax) ELSE coalesce(bonus_amt, 0) END")

INVOICE_LINES = f"""WITH {LI},
{_live_lines('1998-01-01', '1999-01-01', False, "dow.n_name LIKE '%1%'")},
{_invoice_bonus('AND l_orderkey IN (SELECT inv_id FROM inv)')},
x AS (
  SELECT lw.*, a.bonus_amt, a.bonus_tax, wp.n_name AS wp_name, cust.c_name AS cust_name,
         cust.c_mktsegment AS cust_addr, cdel.c_name AS cdel_name, loc.n_name AS city, p.p_name AS prod_name,
         emp.s_name AS emp_name
  FROM lw
  LEFT JOIN a ON a.a_inv = lw.l_orderkey AND a.a_prod = lw.prod AND a.a_do = lw.l_orderkey
             AND a.a_parent = lw.l_suppkey AND a.a_pay = lw.l_returnflag AND a.a_itype = lw.l_linestatus
  LEFT JOIN nation wp ON wp.n_nationkey = lw.inv_wp
  LEFT JOIN customer cust ON cust.c_custkey = lw.inv_cust
  LEFT JOIN customer cdel ON cdel.c_custkey = lw.do_cust
  LEFT JOIN nation loc ON loc.n_nationkey = cdel.c_nationkey
  LEFT JOIN part p ON p.p_partkey = lw.prod
  LEFT JOIN supplier emp ON emp.s_suppkey = lw.inv_sales)
SELECT inv_wp AS WorkplaceId, coalesce(wp_name, '') AS WorkplaceName, coalesce(do_custpo, '') AS SoReference,
       coalesce(CAST(do_id AS VARCHAR), '') AS SoId, coalesce(CAST(do_id AS VARCHAR), '') AS DoId,
       inv_id AS InvoiceId, {date_text('inv_date')} AS OrderDate, upper(CAST(inv_sales AS VARCHAR)) AS SalesID,
       emp_name AS EmployeeName, coalesce(do_cust, inv_cust) AS CustomerId,
       CASE WHEN do_cust IS NOT NULL THEN coalesce(cdel_name, '') ELSE coalesce(cust_name, '') END AS CustomerName,
       coalesce(cust_addr, '') AS Address, city AS Muncipality, prod AS ProductID,
       coalesce(prod_name, '') AS ProductName, coalesce(amount / nullif(l_quantity, 0), 0) AS Price,
       l_quantity AS Quantity, {_AMOUNT} AS Amount, tax + coalesce(bonus_tax, 0) AS Tax,
       {_NETT} AS NettAmount, ({_NETT}) + tax + coalesce(bonus_tax, 0) AS NettAmountIncTax,
       ({_DISC_ITEM}) + ({_DISC_BONUS}) AS Discount, {_DISC_ITEM} AS DiscountItem,
       concat_ws('-', coalesce(CAST(inv_id AS VARCHAR), ''), coalesce(CAST(prod AS VARCHAR), '')) AS InvoiceProductID
FROM x"""

_EXPORT_ORDER = ["WorkplaceId", "WorkplaceName", "SoId", "DoId", "InvoiceId", "OrderDate", "SalesID",
                 "EmployeeName", "CustomerId", "CustomerName", "Address", "Muncipality", "ProductID",
                 "ProductName", "Price", "Quantity", "Amount", "Tax", "NettAmount", "NettAmountIncTax",
                 "Discount", "DiscountItem"]
ORDERED_EXPORT = (f"SELECT * FROM ({INVOICE_LINES}) t ORDER BY "
                  + ", ".join(f"{c} ASC NULLS FIRST" for c in _EXPORT_ORDER))

INVOICE_BONUS = f"""WITH {LI},
{_invoice_bonus('')}
SELECT a_inv AS szFInvoiceId, a_prod AS szProductId, a_do AS szFDoId, a_parent AS szParentId,
       a_pay AS szPaymentType, a_itype AS szOrderItemTypeId,
       bonus_amt AS sumDecBonusAmount, bonus_tax AS sumDecBonusAmountTax
FROM a"""

_KIND = ("CASE WHEN l_returnflag = 'A' THEN 'Invoice Disc. Item' "
         "WHEN l_returnflag = 'N' THEN 'Invoice Disc. Item 2' ELSE 'Invoice Disc.' END")
_SPLITTABLE = "taxable AND dpp + tax <> 0"


def _w(kind: str, weight: str) -> str:
    return fsum(f"CASE WHEN kind = '{kind}' THEN {weight} ELSE 0.0 END", 12)


ORDER_BONUS = f"""WITH {LI},
k AS (
  SELECT *, {_KIND} AS kind,
         CASE WHEN {_SPLITTABLE} THEN dpp / (dpp + tax) ELSE 1.0 END AS wd,
         CASE WHEN {_SPLITTABLE} THEN tax / (dpp + tax) ELSE 0.0 END AS wt0,
         CASE WHEN {_SPLITTABLE} THEN tax / (dpp + tax) ELSE 1.0 END AS wt1
  FROM li WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01')),
w AS (
  SELECT l_orderkey AS so, l_linenumber AS item,
         {_w('Invoice Disc. Item', 'wd')} AS w1d, {_w('Invoice Disc. Item', 'wt0')} AS w1t,
         {_w('Invoice Disc. Item 2', 'wd')} AS w2d, {_w('Invoice Disc. Item 2', 'wt1')} AS w2t,
         {_w('Invoice Disc.', 'wd')} AS wfd, {_w('Invoice Disc.', 'wt1')} AS wft
  FROM k GROUP BY 1, 2)
SELECT b.l_orderkey AS szFSoId, b.l_partkey AS szProductId, b.l_suppkey AS szParentId,
       b.l_returnflag AS szPaymentType, b.l_linestatus AS szOrderItemTypeId,
       {fsum('b.disc * w.w1d', 6)} AS decDisc1DPP, {fsum('b.disc * w.w1t', 6)} AS decDisc1Tax,
       {fsum('b.disc * w.w2d', 6)} AS decDisc2DPP, {fsum('b.disc * w.w2t', 6)} AS decDisc2Tax,
       {fsum('b.disc * w.wfd', 6)} AS decDiscFakturDPP, {fsum('b.disc * w.wft', 6)} AS decDiscFakturTax
FROM li b JOIN w ON b.l_orderkey = w.so AND b.l_linenumber = w.item
WHERE b.l_partkey IS NOT NULL
GROUP BY 1, 2, 3, 4, 5"""

WITHOUT_REVERSED = f"""SELECT o_orderkey AS szDoId, o_custkey AS szCustId, o_orderpriority AS szCustPoId,
       {date_text('o_orderdate')} AS dtmDelivery
FROM orders
WHERE o_orderkey NOT IN (SELECT k FROM ({_REVERSED}) r)"""

LATEST_PER_KEY = f"""SELECT user_id, event_id, {ts_text('ts')} AS ts, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
      FROM events) t
WHERE rn = 1"""

TOP1_GLOBAL = f"""SELECT event_id, user_id, {ts_text('ts')} AS ts, event_type
FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 1"""

_LOAD = "CASE WHEN l_quantity <= 0 THEN 0.0 ELSE l_quantity * coalesce({s}, 0) / 1000.0 END"
VEHICLE_LOAD = f"""WITH {LI},
{_live_lines('1998-06-01', '1998-11-30', True, None)}
SELECT lw.do_vehicle AS szVehicleId, {date_text('lw.inv_date')} AS dtmDate,
       {fsum(_LOAD.format(s='p.p_size'), 6)} AS decVolume,
       {fsum(_LOAD.format(s='p.p_retailprice'), 6)} AS decWeight
FROM lw LEFT JOIN part p ON p.p_partkey = lw.prod
GROUP BY 1, 2"""

QTY_PREAGGREGATED = """SELECT o.o_orderkey, coalesce(q.qty, 0.0) AS qty_delivered
FROM orders o
LEFT JOIN (SELECT l_orderkey, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) q
       ON q.l_orderkey = o.o_orderkey"""

DELIVERED_QTY = """SELECT CAST(l_orderkey AS VARCHAR) AS custOrderNo, CAST(l_partkey AS VARCHAR) AS code,
       CAST(l_orderkey AS VARCHAR) AS orderNo, SUM(l_quantity) AS qty
FROM lineitem GROUP BY l_orderkey, l_partkey"""

INVOICED_QTY = f"""WITH {LI}
SELECT l_orderkey AS szFInvoiceId, prod AS szProductId, l_linestatus AS szOrderItemTypeId, SUM(l_quantity) AS decQty
FROM li GROUP BY 1, 2, 3"""

NET_MEASURES = f"""WITH {LI},
{_invoice_bonus('')}
SELECT li.l_orderkey, li.l_linenumber, li.prod AS l_partkey, li.l_suppkey,
       tax + coalesce(bonus_tax, 0) AS Tax, {_NETT} AS NettAmount,
       ({_NETT}) + tax + coalesce(bonus_tax, 0) AS NettAmountIncTax,
       ({_DISC_ITEM}) + ({_DISC_BONUS}) AS Discount, {_DISC_ITEM} AS DiscountItem
FROM li LEFT JOIN a ON a.a_inv = li.l_orderkey AND a.a_prod = li.prod AND a.a_do = li.l_orderkey
                   AND a.a_parent = li.l_suppkey AND a.a_pay = li.l_returnflag AND a.a_itype = li.l_linestatus"""

_PRICE = "(l_extendedprice / nullif(l_quantity, 0))"
PO_DISCOUNT = f"""WITH {LI}
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN {_SPLITTABLE} THEN disc * dpp / (dpp + tax) ELSE disc END AS decDisc1DPP,
       CASE WHEN {_SPLITTABLE} THEN disc * tax / (dpp + tax) ELSE 0 END AS decDisc1Tax,
       CASE WHEN {_SPLITTABLE} THEN {_PRICE} * dpp / (dpp + tax) ELSE {_PRICE} END AS decPrice
FROM li"""

SETTINGS_CONST_JOIN = """SELECT c.c_custkey, c.c_name, r.r_regionkey, r.r_name
FROM customer c LEFT JOIN (SELECT r_regionkey, r_name FROM region WHERE r_name = 'ASIA') r ON TRUE"""

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SETTING = ("LEFT JOIN info s{i} ON s{i}.wp = w.wp AND s{i}.item = '{g}'")
SETTINGS_PIVOT = (
    "WITH info AS (SELECT c_nationkey AS wp, c_mktsegment AS item, max(c_acctbal) AS v FROM customer GROUP BY 1, 2), "
    "w AS (SELECT DISTINCT wp FROM info WHERE item IN (" + ", ".join(f"'{g}'" for g in _SEGMENTS) + ")) "
    "SELECT w.wp AS szConfigItemTypeValue, " + ", ".join(f"s{i}.v AS setting_{g}" for i, g in enumerate(_SEGMENTS))
    + " FROM w " + " ".join(_SETTING.format(i=i, g=g) for i, g in enumerate(_SEGMENTS)))

_SENTINEL = "TIMESTAMP '1900-01-01 00:00:00'"
_EVENT_LEVEL = ("CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 "
                "WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END")
APPROVAL_LEVELS = f"""WITH items AS (
  SELECT user_id AS id, {_EVENT_LEVEL} AS lvl, ts, value > 50 AS ok FROM events),
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, lvl ORDER BY ts DESC NULLS LAST, ok DESC NULLS LAST) AS rn
                 FROM items) t WHERE rn = 1),
docs AS (SELECT id, max(lvl) AS max_level FROM items GROUP BY id)
SELECT docs.id AS gdApprovedId,
       {ts_text(f"coalesce(g1.ts, {_SENTINEL})")} AS dtmApproved1,
       {ts_text(f"coalesce(g2.ts, {_SENTINEL})")} AS dtmApproved2,
       {ts_text(f"coalesce(g3.ts, {_SENTINEL})")} AS dtmApproved3,
       g1.ok AS bApproved1, g2.ok AS bApproved2, g3.ok AS bApproved3,
       CAST(coalesce(max_level, 0) + 1 AS VARCHAR) AS currentApprovalLevel
FROM docs
LEFT JOIN last g1 ON g1.id = docs.id AND g1.lvl = 1
LEFT JOIN last g2 ON g2.id = docs.id AND g2.lvl = 2
LEFT JOIN last g3 ON g3.id = docs.id AND g3.lvl = 3"""

HIERARCHY = """SELECT c.c_custkey, n1.n_nationkey AS lvl1_id, n1.n_name AS lvl1_name,
       n2.n_nationkey AS lvl2_id, n2.n_name AS lvl2_name, n3.n_nationkey AS lvl3_id, n3.n_name AS lvl3_name
FROM customer c
LEFT JOIN nation n1 ON n1.n_nationkey = c.c_nationkey
LEFT JOIN nation n2 ON n2.n_nationkey = n1.n_regionkey
LEFT JOIN nation n3 ON n3.n_nationkey = n2.n_regionkey"""

_DOCS = """d AS (
  SELECT CAST(event_id AS VARCHAR) AS _id, strftime(ts, '%B') AS month_name, strftime(ts, '%Y-%m-%d') AS date_,
         event_type AS channel_name, CAST(user_id AS VARCHAR) AS store_code,
         json_extract_string(props, '$.k') AS product_code,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty, value AS price, value AS value
  FROM events)"""
_NULLS = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in
                   ["account_name", "store_name", "employee_nik", "employee_name", "position_name",
                    "agency_name", "leader", "cluster_name", "product_brand_name", "product_name"])


def _sell_out(ranges: list[tuple[str, str]]) -> str:
    cond = " OR ".join(f"(date_ >= '{a}' AND date_ <= '{b}')" for a, b in ranges)
    return f"""WITH {_DOCS}
SELECT _id, month_name, strftime(TRY_CAST(date_ AS DATE), '%Y-%m-%d') AS date_, channel_name, store_code,
       product_code, qty, price, value, {_NULLS}
FROM d WHERE ({cond}) AND channel_name IN ('click', 'purchase', 'view')"""


SELL_OUT = _sell_out([("2024-01-08", "2024-01-14")])
SELL_OUT_SLICES = _sell_out([("2024-01-01", "2024-01-07"), ("2024-01-15", "2024-01-21")])

JSON_FIELD = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"

_UNIFIED = f"""u AS (
  SELECT 'sell_in' AS stage, CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS BIGINT) AS store,
         CAST(l_partkey AS BIGINT) AS sku, CAST(l_quantity AS DOUBLE) AS qty, CAST(l_extendedprice AS DOUBLE) AS value
  FROM lineitem
  UNION ALL
  SELECT 'sell_through', CAST(o.o_orderdate AS DATE), CAST(o.o_custkey AS BIGINT), CAST(l.l_partkey AS BIGINT),
         CAST(l.l_quantity AS DOUBLE), l.l_extendedprice * (1 - l.l_discount)
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  UNION ALL
  SELECT 'sell_out', CAST(ts AS DATE), CAST(user_id AS BIGINT), CAST(json_extract_string(props, '$.k') AS BIGINT),
         CAST(1.0 AS DOUBLE), value
  FROM events WHERE event_type = 'purchase'),
g AS (
  SELECT stage, date, store, sku, {fsum('qty', 4)} AS qty, {fsum('value', 4)} AS value
  FROM u GROUP BY stage, date, store, sku)"""

UNIFIED_SALES = f"""WITH {_UNIFIED}
SELECT stage, strftime(date, '%Y-%m-%d') AS date, store, sku, qty, value FROM g"""

STAGE_PIVOT = f"""WITH {_UNIFIED}
SELECT strftime(date, '%Y-%m-%d') AS date, store, sku,
       {fsum("CASE WHEN stage = 'sell_in' THEN value END", 4)} AS sell_in_value,
       {fsum("CASE WHEN stage = 'sell_through' THEN value END", 4)} AS sell_through_value,
       {fsum("CASE WHEN stage = 'sell_out' THEN value END", 4)} AS sell_out_value
FROM u GROUP BY date, store, sku"""

SALES_CUBE = f"""SELECT n.n_name, c.c_mktsegment, {fsum('o.o_totalprice', 2)} AS total_value, COUNT(*) AS n_rows,
       GROUPING(n.n_name, c.c_mktsegment) AS grouping_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY CUBE (n.n_name, c.c_mktsegment)"""

SALES_ROLLUP = f"""SELECT r.r_name, n.n_name, {fsum('o.o_totalprice', 2)} AS total_value, COUNT(*) AS n_rows,
       GROUPING(r.r_name, n.n_name) AS grouping_id
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ROLLUP (r.r_name, n.n_name)"""

MTD_TREND = """WITH d AS (
  SELECT CAST(o_orderdate AS DATE) AS day, SUM(CAST(round_even(o_totalprice * CAST(1e2 AS DOUBLE), 0) AS HUGEINT)) AS units
  FROM orders GROUP BY 1),
m AS (
  SELECT day, CAST(units AS DOUBLE) / CAST(1e2 AS DOUBLE) AS day_value,
         CAST(SUM(units) OVER (PARTITION BY date_trunc('month', day) ORDER BY day
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(1e2 AS DOUBLE) AS mtd_value
  FROM d)
SELECT strftime(m.day, '%Y-%m-%d') AS day, m.day_value, m.mtd_value, p.day_value AS prev_day_value,
       m.day_value - p.day_value AS day_change
FROM m LEFT JOIN m p ON m.day = p.day + 1"""

TOP_N = f"""WITH a AS (
  SELECT l_suppkey, l_partkey, {fsum('l_extendedprice * (1 - l_discount)', 4)} AS total_value
  FROM lineitem GROUP BY l_suppkey, l_partkey)
SELECT l_suppkey, l_partkey, total_value, rank
FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY total_value DESC, l_partkey ASC) AS rank
      FROM a) t
WHERE rank <= 3"""

FALLBACK_CHAIN = """WITH h AS (
  SELECT o_custkey AS h_cust, o_orderkey AS h_key
  FROM (SELECT o_custkey, o_orderkey,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
        FROM orders) t WHERE rn = 1),
j AS (
  SELECT o.o_orderkey,
         CASE WHEN trim(coalesce(CASE WHEN h.h_key <> o.o_orderkey THEN CAST(h.h_key AS VARCHAR) END, '')) = ''
              THEN CAST(o.o_orderkey AS VARCHAR)
              ELSE CASE WHEN h.h_key <> o.o_orderkey THEN CAST(h.h_key AS VARCHAR) END END AS szFInvoiceId
  FROM orders o LEFT JOIN h ON h.h_cust = o.o_custkey),
q AS (SELECT CAST(l_orderkey AS VARCHAR) AS q_key, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey)
SELECT j.o_orderkey, j.szFInvoiceId, coalesce(q.qty, 0.0) AS decQtyInvoice
FROM j LEFT JOIN q ON q.q_key = j.szFInvoiceId"""

FAN_OUT_DISTINCT = """SELECT DISTINCT o.o_orderkey, a.l_partkey, a.l_quantity
FROM orders o
LEFT JOIN lineitem a ON a.l_orderkey = o.o_orderkey
LEFT JOIN lineitem b ON b.l_orderkey = o.o_orderkey
WHERE a.l_returnflag = 'N' OR b.l_linestatus = 'O'"""

_TYPE = "CASE WHEN l_returnflag = 'N' THEN 'JUAL' ELSE 'RETUR' END"
_TRACKING_TABLES = f"""{LI},
si AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS szFSoId,
         CASE WHEN o_orderstatus = 'F' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS szFPoId,
         CAST(o_orderkey AS VARCHAR) AS szFDoId, CAST(o_orderkey AS VARCHAR) AS szFDnId,
         CAST(o_custkey AS VARCHAR) AS szCustId,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 5 AS INTEGER) END AS istatusFlag,
         CAST(o_custkey % 7 AS VARCHAR) AS szCarrierId, CAST(o_custkey % 100 AS VARCHAR) AS szVehicleNo,
         o_orderpriority AS szDriverNm, o_orderdate + INTERVAL 4 DAY AS dtmETA
  FROM orders),
so AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS szFSoId,
         CASE WHEN o_orderpriority LIKE '1%' THEN '' ELSE o_orderpriority END AS szCustPoId,
         CAST(o_custkey AS VARCHAR) AS gdApprovedId, o_orderdate AS dtmCreated, o_orderdate AS dtmOrder,
         o_orderpriority AS szPaymentTermId, o_orderpriority LIKE '2%' AS bApplied, o_orderkey % 11 = 0 AS bVoid,
         o_orderkey % 2 = 0 AS bSentWMS
  FROM orders WHERE o_orderstatus <> 'P'),
po AS (SELECT CAST(o_orderkey AS VARCHAR) AS szFPo_sId, o_orderstatus AS szStatus, o_orderdate AS dtmCreated,
              o_orderdate AS dtmPO, o_orderkey % 13 = 0 AS bVoid
       FROM orders WHERE o_orderstatus <> 'F'),
soi AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS szFSoId, l_linenumber AS shItemNumber, CAST(l_partkey AS VARCHAR) AS szProductId,
         CAST(l_suppkey AS VARCHAR) AS szParentId, l_returnflag AS szPaymentType, {_TYPE} AS szOrderItemTypeId,
         {_KIND} AS kind, taxable, dpp, tax, disc, l_quantity AS decQty, amount AS decAmount,
         l_extendedprice / l_quantity AS decPrice
  FROM li),
poi AS (SELECT CAST(l_orderkey AS VARCHAR) AS szFPo_sId, CAST(l_partkey AS VARCHAR) AS szProductId,
               CASE WHEN l_linestatus = 'O' THEN 'BELI' WHEN l_returnflag = 'A' THEN 'BELI-BERIKAT' ELSE 'LAIN' END
                 AS purchaseItemTypeId,
               taxable, dpp, tax, disc, l_quantity AS decQty, amount AS decAmount, l_extendedprice / l_quantity AS decPrice
        FROM li),
prod AS (SELECT CAST(p_partkey AS VARCHAR) AS szProductId, p_name AS szName FROM part),
cust AS (SELECT CAST(c_custkey AS VARCHAR) AS szCustId, c_name AS szName, c_mktsegment AS szCategory_2 FROM customer),
cat AS (SELECT DISTINCT c_mktsegment AS szCategoryId,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'GT' WHEN 'BUILDING' THEN 'MTI' ELSE 'OTHER' END AS szDescription
        FROM customer),
do_ AS (SELECT CAST(o_orderkey AS VARCHAR) AS szDoId, CAST(o_orderkey AS VARCHAR) AS szFInvoiceId,
               o_orderdate + INTERVAL 2 DAY AS dtmDelivery FROM orders),
delv AS (SELECT CAST(l_orderkey AS VARCHAR) AS custOrderNo, CAST(l_orderkey AS VARCHAR) AS orderNo,
                CAST(l_orderkey AS VARCHAR) AS szDoRefId, max(l_shipdate) AS outTime FROM lineitem GROUP BY l_orderkey),
delvItem AS (SELECT CAST(l_orderkey AS VARCHAR) AS custOrderNo, CAST(l_partkey AS VARCHAR) AS code,
                    CAST(l_orderkey AS VARCHAR) AS orderNo, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey, l_partkey),
invoice AS (SELECT CAST(o_orderkey AS VARCHAR) AS szFInvoiceId, o_orderdate AS dtmCreated FROM orders),
invItem AS (SELECT CAST(l_orderkey AS VARCHAR) AS szFInvoiceId, CAST(l_partkey AS VARCHAR) AS szProductId,
                   {_TYPE} AS szOrderItemTypeId, l_quantity AS decQty FROM lineitem),
rec AS (SELECT CAST(o_orderkey AS VARCHAR) || '-' || n AS szFPoReceipt_sId, CAST(o_orderkey AS VARCHAR) AS szPoId,
               o_orderdate + INTERVAL 5 DAY AS dtmCreated, o_orderdate + INTERVAL 6 DAY AS dtmReceipt
        FROM orders, (VALUES ('1'), ('2')) v(n) WHERE o_orderkey % 3 = 0 AND (n = '1' OR o_orderkey % 9 = 0)),
purchOrd AS (SELECT CAST(o_orderkey AS VARCHAR) AS szDocId, o_custkey % 3 <> 0 AS bAlreadyTransferred,
                    o_orderdate + INTERVAL 1 DAY AS dtmTransferred FROM orders),
cncl AS (SELECT CAST(o_orderkey AS VARCHAR) AS szDocId, o_custkey % 2 = 0 AS bAlreadyTransferred, o_orderpriority AS szData
         FROM orders WHERE o_orderkey % 7 = 0),
rej AS (SELECT CAST(c_custkey AS VARCHAR) AS gdApprovedId, c_acctbal < 0 AS bRejected FROM customer WHERE c_custkey % 2 = 0),
appr AS (SELECT id AS gdApprovedId, lvl AS btApprovedLevel, ts AS dtmApproved, value > 50 AS bApproved
         FROM (SELECT CAST(user_id AS VARCHAR) AS id, {_EVENT_LEVEL} AS lvl, ts, value,
                      row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
         WHERE rn = 1),
fdn AS (SELECT CAST(o_orderkey AS VARCHAR) AS szFDNId, o_orderdate + INTERVAL 3 DAY AS dtmLastUpdated
        FROM orders WHERE o_orderkey % 5 <> 0),
fdnItem AS (SELECT CAST(l_orderkey AS VARCHAR) AS szFDNId, CAST(l_partkey AS VARCHAR) AS szProductId, l_quantity AS decQty
            FROM lineitem WHERE l_linenumber <= 4),
closed AS (
  SELECT dn, bApplied FROM (
    SELECT CAST(o_orderkey - o_orderkey % 2 AS VARCHAR) AS dn, o_orderpriority LIKE '2%' AS bApplied,
           row_number() OVER (PARTITION BY o_orderkey - o_orderkey % 2
                              ORDER BY CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate END DESC NULLS LAST,
                                       CAST(o_orderkey AS VARCHAR) DESC) AS rn
    FROM orders) t WHERE rn = 1),
history AS (SELECT CAST(o_orderkey + 1 AS VARCHAR) AS szDoId, CAST(o_orderkey - o_orderkey % 8 AS VARCHAR) AS szDoIdOld,
                   o_orderdate AS dtmLastUpdated FROM orders WHERE o_orderkey % 4 = 0)"""


def _order_bonus_of(scope: str) -> str:
    """The six bonus sums of the sales orders in ``scope``, one weight set per (order, item)."""
    return f"""k AS (
  SELECT soi.*,
         CASE WHEN taxable AND dpp + tax <> 0 THEN dpp / (dpp + tax) ELSE 1.0 END AS wd,
         CASE WHEN taxable AND dpp + tax <> 0 THEN tax / (dpp + tax) ELSE 0.0 END AS wt0,
         CASE WHEN taxable AND dpp + tax <> 0 THEN tax / (dpp + tax) ELSE 1.0 END AS wt1
  FROM soi WHERE szFSoId IN (SELECT szFSoId FROM so WHERE {scope})),
w AS (
  SELECT szFSoId AS w_so, shItemNumber AS w_item,
         {_w('Invoice Disc. Item', 'wd')} AS w1d, {_w('Invoice Disc. Item', 'wt0')} AS w1t,
         {_w('Invoice Disc. Item 2', 'wd')} AS w2d, {_w('Invoice Disc. Item 2', 'wt1')} AS w2t,
         {_w('Invoice Disc.', 'wd')} AS wfd, {_w('Invoice Disc.', 'wt1')} AS wft
  FROM k GROUP BY 1, 2),
bonus AS (
  SELECT b.szFSoId, b.szProductId, b.szParentId, b.szPaymentType, b.szOrderItemTypeId,
         {fsum('b.disc * w.w1d', 6)} AS decDisc1DPP, {fsum('b.disc * w.w1t', 6)} AS decDisc1Tax,
         {fsum('b.disc * w.w2d', 6)} AS decDisc2DPP, {fsum('b.disc * w.w2t', 6)} AS decDisc2Tax,
         {fsum('b.disc * w.wfd', 6)} AS decDiscFakturDPP, {fsum('b.disc * w.wft', 6)} AS decDiscFakturTax
  FROM soi b JOIN w ON b.szFSoId = w.w_so AND b.shItemNumber = w.w_item
  WHERE b.szProductId IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5)"""


_BONUS_JOIN = """LEFT JOIN bonus ON bonus.szFSoId = soi.szFSoId AND soi.szProductId = bonus.szProductId
               AND bonus.szParentId = soi.szParentId AND bonus.szPaymentType = soi.szPaymentType
               AND bonus.szOrderItemTypeId = soi.szOrderItemTypeId"""


def _since(c: str) -> str:
    return ts_text(f"coalesce({c}, {_SENTINEL})")


_TS, _TE = "TIMESTAMP '1996-01-01'", "TIMESTAMP '1999-01-01'"
PO_TRACKING = f"""WITH {_TRACKING_TABLES},
{_order_bonus_of(f'dtmOrder >= {_TS}')}
SELECT DISTINCT
  CASE WHEN coalesce(trim(so.szCustPoId), '') = '' THEN si.szFPoId ELSE coalesce(trim(so.szCustPoId), '') END
    AS purchase_order_number,
  {_since('po.dtmCreated')} AS date_created, {_since('so.dtmCreated')} AS po_on_review_date,
  {_since('so.dtmOrder')} AS po_approve_lv1_date, si.szFSoId AS sales_order_number,
  cncl.bAlreadyTransferred AS canceled_order, rej.bRejected AS rejected_order,
  {_since('purchOrd.dtmTransferred')} AS send_to_wms_date,
  si.szCustId AS customer_id, cust.szName AS customer_name,
  coalesce(custCat.szDescription, '') AS customer_category_description,
  {_since('delv.outTime')} AS delivered_date_feedback_wms, {_since('rec.dtmReceipt')} AS received_date,
  {ts_text("CASE WHEN rtrim(si.szFPoId) = '' THEN so.dtmCreated ELSE po.dtmCreated END")} AS poDate,
  soi.szProductId AS product_id, prod1.szName AS product_name, soi.decQty AS qty_order,
  soi.decAmount AS amount_incl_ppn_before_discount,
  soi.decAmount - coalesce(bonus.decDiscFakturDPP, 0) - coalesce(bonus.decDiscFakturTax, 0) AS nett_amount_incl_ppn,
  coalesce(closed.bApplied, false) AS bStatusDN, {_since('fdn.dtmLastUpdated')} AS dn_closed_date, si.szFDnId AS szfdnid
FROM si
LEFT JOIN so ON si.szFSoId = so.szFSoId
LEFT JOIN po ON si.szFPoId = po.szFPo_sId
LEFT JOIN soi ON soi.szFSoId = so.szFSoId
LEFT JOIN poi ON poi.szFPo_sId = po.szFPo_sId
LEFT JOIN prod prod1 ON soi.szProductId = prod1.szProductId
LEFT JOIN cust ON cust.szCustId = si.szCustId
LEFT JOIN do_ ON do_.szDoId = si.szFDoId
LEFT JOIN delv ON delv.custOrderNo = si.szFSoId AND rtrim(delv.custOrderNo) <> '' AND do_.szDoId = delv.szDoRefId
LEFT JOIN cat custCat ON custCat.szCategoryId = cust.szCategory_2
LEFT JOIN rec ON rec.szPoId = po.szFPo_sId AND rtrim(rec.szPoId) <> ''
LEFT JOIN cncl ON cncl.szDocId = si.szFSoId
LEFT JOIN rej ON rej.gdApprovedId = so.gdApprovedId
LEFT JOIN purchOrd ON purchOrd.szDocId = si.szFSoId AND purchOrd.bAlreadyTransferred
LEFT JOIN fdn ON fdn.szFDNId = si.szFDnId
LEFT JOIN closed ON closed.dn = si.szFDnId
{_BONUS_JOIN}
WHERE (soi.szOrderItemTypeId = 'JUAL' OR poi.purchaseItemTypeId = 'BELI' OR poi.purchaseItemTypeId = 'BELI-BERIKAT')
  AND ((rtrim(si.szFPoId) <> '' AND po.dtmPO >= {_TS} AND po.dtmPO < {_TE})
       OR (rtrim(si.szFPoId) = '' AND so.dtmOrder >= {_TS} AND so.dtmOrder < {_TE}))
  AND so.dtmCreated >= {_TS} AND so.dtmCreated < {_TE}
  AND delv.outTime >= {_TS} AND delv.outTime < {_TE}
  AND coalesce(cncl.bAlreadyTransferred, false) = false AND coalesce(rej.bRejected, false) = false
  AND custCat.szDescription IN ('GT', 'MTI')"""

_NO_SO = "trim(coalesce(si.szFSoId, '')) = ''"
_PO_SPLIT = "poi.taxable AND poi.dpp + poi.tax <> 0"
_SO_SPLIT = "soi.taxable AND soi.dpp + soi.tax <> 0"


def _either(po_side: str, so_side: str) -> str:
    return f"CASE WHEN {_NO_SO} THEN {po_side} ELSE {so_side} END"


_SIX = "".join(f", {_either('0', 'bonus.' + c)} AS {c}" for c in ("decDisc2DPP", "decDisc2Tax", "decDiscFakturDPP", "decDiscFakturTax"))
_LEVELS = "".join(f", {_since(f'gd{n}.dtmApproved')} AS dtmApproved{n}, gd{n}.bApproved AS bApproved{n}" for n in (1, 2, 3))
PO_TRACKING_GT = f"""WITH {_TRACKING_TABLES},
{_order_bonus_of("dtmOrder > TIMESTAMP '1996-06-30'")},
hist AS (SELECT szDoId, szDoIdOld FROM history ORDER BY dtmLastUpdated DESC NULLS LAST, szDoId DESC LIMIT 1),
lvl AS (SELECT gdApprovedId, max(btApprovedLevel) AS top FROM appr GROUP BY 1)
SELECT DISTINCT
  CASE WHEN coalesce(trim(so.szCustPoId), '') = '' THEN si.szFPoId ELSE coalesce(trim(so.szCustPoId), '') END AS szFPOid,
  so.gdApprovedId, coalesce(po.szStatus, '') AS statusPO, si.szCustId, coalesce(si.istatusFlag, 0) AS IstatusFlag,
  si.szFSoId, {_since('po.dtmCreated')} AS dtmCreatedPO, si.szFDoId, {_since('so.dtmCreated')} AS dtmCreatedSO,
  si.szFDnId, {_since('delv.outTime')} AS dtmCreatedDO, so.bSentWMS, {_since('rec.dtmCreated')} AS dtmCreatedGR,
  {_since('rec.dtmReceipt')} AS dtmReceiptPOrec, si.szCarrierId, {_since('do_.dtmDelivery')} AS dtmDelivery,
  {_since('invoice.dtmCreated')} AS dtmCreatedInv, {_since('purchOrd.dtmTransferred')} AS dtmSendWMS,
  cust.szName AS custNm, {_since('so.dtmOrder')} AS dtmOrder, si.szVehicleNo, si.szDriverNm,
  coalesce(po.bVoid, false) AS bvoidPO, so.szPaymentTermId,
  {ts_text("CASE WHEN rtrim(si.szFPoId) = '' THEN so.dtmCreated ELSE po.dtmCreated END")} AS poDate,
  {ts_text("CASE WHEN rtrim(si.szFPoId) = '' THEN so.dtmOrder ELSE po.dtmPO END")} AS podatefilter,
  coalesce(rec.szFPoReceipt_sId, '') AS szFPoReceipt_sId, {_since('rec.dtmReceipt')} AS dtmreceipt,
  {_either('poi.szProductId', 'soi.szProductId')} AS szProductId, {_either('poi.decQty', 'soi.decQty')} AS decQty,
  {_either('poi.tax', 'soi.tax')} AS decPPN, {_either('poi.dpp', 'soi.dpp')} AS decDPP,
  {_either('poi.decAmount', 'soi.decAmount')} AS decAmountPOSO,
  {_either(f'CASE WHEN {_PO_SPLIT} THEN poi.disc * poi.dpp / (poi.dpp + poi.tax) ELSE poi.disc END', 'bonus.decDisc1DPP')} AS decDisc1DPP,
  {_either(f'CASE WHEN {_PO_SPLIT} THEN poi.disc * poi.tax / (poi.dpp + poi.tax) ELSE 0 END', 'bonus.decDisc1Tax')} AS decDisc1Tax{_SIX},
  {_either(f'CASE WHEN {_PO_SPLIT} THEN poi.decPrice * poi.dpp / (poi.dpp + poi.tax) ELSE poi.decPrice END',
           f'CASE WHEN {_SO_SPLIT} THEN soi.decPrice * soi.dpp / (soi.dpp + soi.tax) ELSE soi.decPrice END')} AS decPrice,
  {_either('prod.szName', 'prod1.szName')} AS prodNm,
  CASE WHEN trim(coalesce(fdn.szFDNId, '')) = '' THEN 0 ELSE coalesce(fdnItem.decQty, 0) END AS decQtyReceipt,
  coalesce(delv.custOrderNo, '') AS feedback, coalesce(delvItem.qty, 0) AS decQtyDelivered,
  coalesce(closed.bApplied, false) AS bStatusDN,
  CASE WHEN coalesce(invoiceHist.szFInvoiceId, '') = '' THEN invoice.szFInvoiceId ELSE invoiceHist.szFInvoiceId END AS szFInvoiceId,
  CASE WHEN coalesce(invoiceHist.szFInvoiceId, '') = '' THEN coalesce(invItem.decQty, 0)
       ELSE coalesce(invItemHist.decQty, 0) END AS decQtyInvoice,
  coalesce(cust.szCategory_2, '') AS szCustCat2, coalesce(custCat.szDescription, '') AS szCustCat2Desc,
  {ts_text('si.dtmETA')} AS dtmETA, coalesce(cncl.szData, '') AS szDataCancelPO,
  CASE WHEN so.bApplied OR so.bVoid THEN '' ELSE CAST(coalesce(lvl.top, 0) + 1 AS VARCHAR) END AS currentApprovalLevel,
  so.bVoid{_LEVELS}, {_since('fdn.dtmLastUpdated')} AS MaxLastUpdated
FROM si
LEFT JOIN so ON si.szFSoId = so.szFSoId
LEFT JOIN po ON si.szFPoId = po.szFPo_sId
LEFT JOIN soi ON soi.szFSoId = so.szFSoId
LEFT JOIN poi ON poi.szFPo_sId = po.szFPo_sId
LEFT JOIN prod ON poi.szProductId = prod.szProductId
LEFT JOIN prod prod1 ON soi.szProductId = prod1.szProductId
LEFT JOIN cust ON cust.szCustId = si.szCustId
LEFT JOIN rec ON rec.szPoId = po.szFPo_sId AND rtrim(rec.szPoId) <> ''
LEFT JOIN do_ ON do_.szDoId = si.szFDoId
LEFT JOIN delv ON delv.custOrderNo = si.szFSoId AND rtrim(delv.custOrderNo) <> '' AND do_.szDoId = delv.szDoRefId
LEFT JOIN delvItem ON delvItem.custOrderNo = delv.custOrderNo AND delv.orderNo = delvItem.orderNo AND delvItem.code = soi.szProductId
LEFT JOIN invoice ON invoice.szFInvoiceId = do_.szFInvoiceId
LEFT JOIN invItem ON invItem.szFInvoiceId = invoice.szFInvoiceId AND invItem.szProductId = soi.szProductId
                 AND invItem.szOrderItemTypeId = soi.szOrderItemTypeId
LEFT JOIN cat custCat ON custCat.szCategoryId = cust.szCategory_2
LEFT JOIN cncl ON cncl.szDocId = si.szFSoId AND cncl.bAlreadyTransferred
LEFT JOIN purchOrd ON purchOrd.szDocId = si.szFSoId AND purchOrd.bAlreadyTransferred
{_BONUS_JOIN}
LEFT JOIN lvl ON lvl.gdApprovedId = so.gdApprovedId
LEFT JOIN appr gd1 ON gd1.gdApprovedId = so.gdApprovedId AND gd1.btApprovedLevel = 1
LEFT JOIN appr gd2 ON gd2.gdApprovedId = so.gdApprovedId AND gd2.btApprovedLevel = 2
LEFT JOIN appr gd3 ON gd3.gdApprovedId = so.gdApprovedId AND gd3.btApprovedLevel = 3
LEFT JOIN fdn ON fdn.szFDNId = si.szFDnId
LEFT JOIN fdnItem ON fdn.szFDNId = fdnItem.szFDNId AND fdnItem.szProductId = soi.szProductId
LEFT JOIN closed ON closed.dn = si.szFDnId
LEFT JOIN hist ON hist.szDoIdOld = do_.szDoId
LEFT JOIN do_ doHist ON hist.szDoId = doHist.szDoId
LEFT JOIN invoice invoiceHist ON invoiceHist.szFInvoiceId = doHist.szFInvoiceId
LEFT JOIN invItem invItemHist ON invItemHist.szFInvoiceId = invoiceHist.szFInvoiceId AND invItemHist.szProductId = soi.szProductId
WHERE (soi.szOrderItemTypeId = 'JUAL' OR poi.purchaseItemTypeId = 'BELI' OR poi.purchaseItemTypeId = 'BELI-BERIKAT')
  AND ((rtrim(si.szFPoId) <> '' AND po.dtmPO >= TIMESTAMP '1997-01-01' AND po.dtmPO <= TIMESTAMP '1997-12-31')
       OR (rtrim(si.szFPoId) = '' AND so.dtmOrder >= TIMESTAMP '1997-03-01' AND so.dtmOrder <= TIMESTAMP '1998-02-28'))"""

DO_HISTORY = f"""WITH {_TRACKING_TABLES},
h AS (SELECT szDoIdOld, szDoId FROM (
        SELECT *, row_number() OVER (PARTITION BY szDoIdOld ORDER BY dtmLastUpdated DESC NULLS LAST, szDoId DESC) AS rn
        FROM history) t WHERE rn = 1)
SELECT d.szDoId, h.szDoId AS szDoIdNew,
       CASE WHEN coalesce(n.szFInvoiceId, '') = '' THEN d.szFInvoiceId ELSE n.szFInvoiceId END AS szFInvoiceId
FROM do_ d LEFT JOIN h ON h.szDoIdOld = d.szDoId LEFT JOIN do_ n ON n.szDoId = h.szDoId"""

MERGE_JOIN = """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"""

CONST_ON_JOIN = f"""SELECT c.c_custkey, c.c_name, coalesce(a.n_finished, 0) AS n_finished,
       coalesce(a.finished_value, 0.0) AS finished_value
FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_finished, {fsum('o_totalprice', 2)} AS finished_value
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) a ON c.c_custkey = a.o_custkey"""

COMPUTED_KEY_JOIN = """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS orders_that_day FROM orders GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, strftime(CAST(l.l_shipdate AS DATE), '%Y-%m-%d') AS ship_day,
       coalesce(d.orders_that_day, 0) AS orders_that_day
FROM lineitem l LEFT JOIN d ON d.day = CAST(l.l_shipdate AS DATE)"""


def oracle_sql() -> dict[str, str]:
    return {
        "invoice_lines": INVOICE_LINES,
        "ordered_export": ORDERED_EXPORT,
        "order_bonus": ORDER_BONUS,
        "invoice_bonus": INVOICE_BONUS,
        "without_reversed": WITHOUT_REVERSED,
        "latest_per_key": LATEST_PER_KEY,
        "top1_global": TOP1_GLOBAL,
        "vehicle_load": VEHICLE_LOAD,
        "qty_preaggregated": QTY_PREAGGREGATED,
        "delivered_qty": DELIVERED_QTY,
        "invoiced_qty": INVOICED_QTY,
        "net_measures": NET_MEASURES,
        "po_discount": PO_DISCOUNT,
        "settings_const_join": SETTINGS_CONST_JOIN,
        "settings_pivot": SETTINGS_PIVOT,
        "approval_levels": APPROVAL_LEVELS,
        "hierarchy": HIERARCHY,
        "sell_out": SELL_OUT,
        "sell_out_slices": SELL_OUT_SLICES,
        "json_field": JSON_FIELD,
        "unified_sales": UNIFIED_SALES,
        "stage_pivot": STAGE_PIVOT,
        "sales_cube": SALES_CUBE,
        "sales_rollup": SALES_ROLLUP,
        "mtd_trend": MTD_TREND,
        "top_n": TOP_N,
        "fallback_chain": FALLBACK_CHAIN,
        "fan_out_distinct": FAN_OUT_DISTINCT,
        "po_tracking": PO_TRACKING,
        "po_tracking_gt": PO_TRACKING_GT,
        "do_history": DO_HISTORY,
        "merge_join": MERGE_JOIN,
        "const_on_join": CONST_ON_JOIN,
        "computed_key_join": COMPUTED_KEY_JOIN,
    }
