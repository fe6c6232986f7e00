"""Registered queries, second part: hierarchies and replacements of any depth,
the roll-up lattice, calendar trends, collated keys, bound SQL, checked NDJSON
loads, stored layout and publishing. Their oracle SQL stands beside them.

Stand-ins that only give rows in a job's schema: :func:`reports_to`,
:func:`do_replacements`, :func:`category_codes` and :func:`event_lines`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import bit_to_tiny, date_text, exact_sum, object_id_text
from ..operators import aggregates as A
from ..operators import chains
from ..operators import joins as J
from ..operators import lattice as L
from ..operators import windows as W
from ..session import ensure_checkpoint_dir
from ..sources import readers, schemas, sinks
from . import roles as R
from .catalog import BONUS_SINCE, SELL_OUT_CHANNELS, SELL_OUT_TWO_WEEKS, _sell_out_frame, _unified
from .oracle import _UNIFIED, ORDER_BONUS, SELL_OUT_SLICES, fsum
from .sellout import publish_sell_out, sell_out


def _t(spark, sf, name):
    return R.table(spark, sf, name)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobs/{name}-{uuid.uuid4().hex}"


# Hierarchies and replacements ------------------------------------------------------

def reports_to(customer: DataFrame) -> DataFrame:
    """Customers as employees, each with a supervisor: long lines, some tops, some who report to each other."""
    k = F.col("c_custkey")
    boss = (F.when(k % 50 == 0, F.lit(None)).when(k % 97 == 5, k + 1).when(k % 97 == 6, k - 1)
            .when(k % 31 == 7, k + 1_000_000).otherwise(k - 1))
    return customer.select(k.alias("szEmployeeId"), boss.cast("long").alias("szSupervisorId"), F.col("c_name").alias("szName"))


def q_org_climb(spark, sf):
    """J8 to any depth: each employee's topmost superior, levels to it, or that the line runs in a circle."""
    org = reports_to(_t(spark, sf, "customer"))
    top = chains.climb_to_top(org.select("szEmployeeId", "szName"), "szEmployeeId", org, "szEmployeeId", "szSupervisorId")
    names = org.select(F.col("szEmployeeId").alias("_k"), F.col("szName").alias("top_name"))
    return top.join(names, top["top"] == names["_k"], "left").select("szEmployeeId", "szName", "top", "top_name", "levels", "in_cycle")


def do_replacements(orders: DataFrame) -> DataFrame:
    """Replacements of delivery orders, one or two a replaced order; the new ones are often replaced again, some in a circle."""
    k = F.col("o_orderkey")
    new = F.when(k % 60 == 59, k - 3).otherwise(k + 1 + k % 3)
    rows = orders.where((k % 5 != 0) | (k % 60 == 59))
    again = F.explode(F.when(k % 4 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_n")
    return rows.select("*", again).select(
        (new + F.col("_n")).cast("string").alias("szDoId"), k.cast("string").alias("szDoIdOld"),
        (F.col("o_orderdate") + F.make_dt_interval(F.col("_n") * (k % 2))).cast("timestamp_ntz").alias("dtmLastUpdated"))


def q_do_last_replacement(spark, sf):
    """J17/J19 replaced orders that were replaced again: each delivery order's last replacement, how many there were, and the
    invoice of the last one, or its own where there is none."""
    orders = _t(spark, sf, "orders")
    last = chains.last_replacement(do_replacements(orders))
    do = R.delivery_order(orders).select(F.col("szDoId").cast("string").alias("szDoId"),
                                         F.col("szFInvoiceId").cast("string").alias("szFInvoiceId"))
    new = do.toDF("new_do", "new_invoice")
    j = do.join(last, do["szDoId"] == last["hist_old"], "left").join(new, F.col("hist_new") == new["new_do"], "left")
    return j.select("szDoId", F.col("hist_new").alias("szDoIdLast"), "replacements", F.coalesce("in_cycle", F.lit(False)).alias("in_cycle"),
                    J.fallback("szFInvoiceId", "new_invoice").alias("szFInvoiceId"))


ORG_CLIMB = """WITH RECURSIVE org AS (
  SELECT c_custkey AS k, c_name AS name,
         CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 97 = 5 THEN c_custkey + 1 WHEN c_custkey % 97 = 6 THEN c_custkey - 1
              WHEN c_custkey % 31 = 7 THEN c_custkey + 1000000 ELSE c_custkey - 1 END AS boss FROM customer),
p AS (SELECT o.k, o.name, b.k AS boss FROM org o LEFT JOIN org b ON o.boss = b.k),
up AS (SELECT k AS start, k AS pt, boss AS next, 0 AS levels, [k] AS seen FROM p
       UNION ALL
       SELECT up.start, p.k, p.boss, up.levels + 1, list_append(up.seen, p.k)
       FROM up JOIN p ON p.k = up.next WHERE NOT list_contains(up.seen, p.k)),
ends AS (SELECT start, pt, levels FROM up WHERE next IS NULL)
SELECT p.k AS szEmployeeId, p.name AS szName, e.pt AS top, t.name AS top_name, CAST(e.levels AS BIGINT) AS levels,
       e.start IS NULL AS in_cycle
FROM p LEFT JOIN ends e ON e.start = p.k LEFT JOIN p t ON t.k = e.pt"""

DO_LAST_REPLACEMENT = """WITH RECURSIVE h AS (
  SELECT CASE WHEN o_orderkey % 60 = 59 THEN o_orderkey - 3 ELSE o_orderkey + 1 + o_orderkey % 3 END + n AS new,
         o_orderkey AS old, o_orderdate + to_days(CAST(n * (o_orderkey % 2) AS INTEGER)) AS upd
  FROM orders, (VALUES (0), (1)) v(n)
  WHERE (o_orderkey % 5 <> 0 OR o_orderkey % 60 = 59) AND (n = 0 OR o_orderkey % 4 = 1)),
l AS (SELECT old, new FROM (
        SELECT *, row_number() OVER (PARTITION BY old ORDER BY upd DESC NULLS LAST, CAST(new AS VARCHAR) DESC) AS rn FROM h) t
      WHERE rn = 1),
up AS (SELECT old AS start, new AS pt, 1 AS steps, [old, new] AS seen FROM l
       UNION ALL
       SELECT up.start, l.new, up.steps + 1, list_append(up.seen, l.new)
       FROM up JOIN l ON l.old = up.pt WHERE NOT list_contains(up.seen, l.new)),
ends AS (SELECT start, pt, steps FROM up WHERE pt NOT IN (SELECT old FROM l))
SELECT CAST(o.o_orderkey AS VARCHAR) AS szDoId, CAST(e.pt AS VARCHAR) AS szDoIdLast, CAST(e.steps AS BIGINT) AS replacements,
       (l.old IS NOT NULL AND e.start IS NULL) AS in_cycle,
       CAST(coalesce(n.o_orderkey, o.o_orderkey) AS VARCHAR) AS szFInvoiceId
FROM orders o LEFT JOIN l ON l.old = o.o_orderkey LEFT JOIN ends e ON e.start = o.o_orderkey
LEFT JOIN orders n ON n.o_orderkey = e.pt"""


# Roll-up lattice and trends ------------------------------------------------------------

LATTICE_LEVELS = [("stage", "date_day"), ("stage", "date_month", "store"), ("stage", "date_month", "sku"), ("stage", "date_month"),
                  ("stage", "date_year", "sku"), ("stage", "date_year"), ("date_month",), ("store",), ("stage",), ()]


def sales_lattice(facts: DataFrame) -> L.Lattice:
    dims = [L.plain("stage"), L.calendar("date", F.col("date")), L.plain("store"), L.plain("sku")]
    return L.Lattice(facts, dims, LATTICE_LEVELS, {"qty": 4, "value": 4})


def q_sales_lattice(spark, sf):
    """A8 the drill-down over stage, date (day, month, year), store and SKU from the facts of all three stages."""
    out = sales_lattice(_unified(spark, sf)).all_levels()
    return out.select(*[date_text(c).alias(c) if c.startswith("date_") else F.col(c) for c in out.columns])


def _lattice_sql() -> str:
    expr = {"date_day": "strftime(date, '%Y-%m-%d')", "date_month": "strftime(date_trunc('month', date), '%Y-%m-%d')",
            "date_year": "strftime(date_trunc('year', date), '%Y-%m-%d')", "stage": "stage", "store": "store", "sku": "sku"}
    names = ["stage", "date_day", "date_month", "date_year", "store", "sku"]
    level = " ".join(f"WHEN GROUPING({', '.join(names)}) = {sum(0 if c in lv else 1 << (len(names) - 1 - i) for i, c in enumerate(names))} "
                     f"THEN '{','.join(lv) or 'total'}'" for lv in LATTICE_LEVELS)
    sets = ", ".join("(" + ", ".join(lv) + ")" for lv in LATTICE_LEVELS)
    measures = ", ".join(f"{fsum(m, 4)} AS {m}, min({m}) AS {m}_min, max({m}) AS {m}_max" for m in ("qty", "value"))
    cols = ", ".join(f"{expr[c]} AS {c}" for c in names if c not in ("stage", "store", "sku"))
    return f"""WITH {_UNIFIED}, f AS (SELECT stage, store, sku, qty, value, {cols} FROM u)
SELECT CASE {level} END AS level, {', '.join(names)}, count(*) AS n_facts, {measures}
FROM f GROUP BY GROUPING SETS ({sets})"""


SALES_LATTICE = _lattice_sql()


def q_period_trend(spark, sf):
    """W3 order value per priority and day, month and year, the period before and the change; gaps show."""
    orders, out = _t(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice"), None
    for step in ("day", "month", "year"):
        one = W.calendar_change(orders, "o_orderdate", "o_totalprice", keys=["o_orderpriority"], step=step)
        one = one.select(F.lit(step).alias("step"), "o_orderpriority", date_text("period").alias("period"), "value", "prev_value", "change")
        out = one if out is None else out.unionByName(one)
    return out


def q_same_day_trend(spark, sf):
    """W3 order value per priority and day against the same day one and twelve months before."""
    orders, out = _t(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice"), None
    for months in (1, 12):
        one = W.same_day_change(orders, "o_orderdate", "o_totalprice", keys=["o_orderpriority"], months=months)
        one = one.select(F.lit(months).alias("months"), "o_orderpriority", date_text("day").alias("day"),
                         date_text("prior_day").alias("prior_day"), "value", "prior_value", "change")
        out = one if out is None else out.unionByName(one)
    return out


_CENTS = "CAST(1e2 AS DOUBLE)"
_UNITS = f"SUM(CAST(round_even(o_totalprice * {_CENTS}, 0) AS HUGEINT))"


def _period_sql(step: str) -> str:
    return f"""SELECT '{step}' AS step, s.p AS o_orderpriority, strftime(s.d, '%Y-%m-%d') AS period,
       CAST(v.u AS DOUBLE) / {_CENTS} AS value, CAST(b.u AS DOUBLE) / {_CENTS} AS prev_value, CAST(v.u - b.u AS DOUBLE) / {_CENTS} AS change
FROM (SELECT p, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 {step})) AS DATE) AS d FROM {step}_v GROUP BY p) s
LEFT JOIN {step}_v v ON v.p = s.p AND v.d = s.d
LEFT JOIN {step}_v b ON b.p = s.p AND b.d = CAST(s.d - INTERVAL 1 {step} AS DATE)"""


PERIOD_TREND = ("WITH " + ", ".join(
    f"{s}_v AS (SELECT o_orderpriority AS p, CAST(date_trunc('{s}', o_orderdate) AS DATE) AS d, {_UNITS} AS u FROM orders GROUP BY 1, 2)"
    for s in ("day", "month", "year")) + "\n" + "\nUNION ALL\n".join(_period_sql(s) for s in ("day", "month", "year")))

SAME_DAY_TREND = f"""WITH v AS (
  SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d, {_UNITS} AS u FROM orders GROUP BY 1, 2),
s AS (SELECT p, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM v GROUP BY p),
m AS (SELECT months, p, d, CAST(d - to_months(months) AS DATE) AS b FROM s, (VALUES (1), (12)) t(months))
SELECT CAST(m.months AS INTEGER) AS months, m.p AS o_orderpriority, strftime(m.d, '%Y-%m-%d') AS day, strftime(m.b, '%Y-%m-%d') AS prior_day,
       CAST(v.u AS DOUBLE) / {_CENTS} AS value, CAST(w.u AS DOUBLE) / {_CENTS} AS prior_value, CAST(v.u - w.u AS DOUBLE) / {_CENTS} AS change
FROM m LEFT JOIN v ON v.p = m.p AND v.d = m.d LEFT JOIN v w ON w.p = m.p AND w.d = m.b"""


# Keys, parameters, loads ---------------------------------------------------------------

def category_codes(customer: DataFrame) -> DataFrame:
    """Category rows whose ids differ from the customers' in case and trailing blanks."""
    seg = F.col("c_mktsegment")
    return customer.select(F.concat(F.lower(seg), F.lit("  ")).alias("szCategoryId"), F.initcap(seg).alias("szDescription")).distinct()


def q_collated_join(spark, sf):
    """2.9 item 2/F6/J1/J2: customers with their category, keys compared without regard to case and trailing blanks; and how
    many categories there are under either rule."""
    customer = _t(spark, sf, "customer")
    cat = schemas.collated(category_codes(customer), ["szCategoryId"])
    own = schemas.collated(customer.select("c_custkey", "c_mktsegment"), ["c_mktsegment"])
    both = own.select(F.col("c_mktsegment").alias("k")).unionByName(cat.select(F.col("szCategoryId").alias("k")))
    n = both.agg(F.count_distinct("k").alias("n_keys"), F.count_distinct(F.collate("k", "UTF8_BINARY")).alias("n_spellings"))
    j = own.join(cat, own["c_mktsegment"] == cat["szCategoryId"], "left")
    j = schemas.plain_text(j.select("c_custkey", "c_mktsegment", "szDescription"))
    return J.attach_single_row(j, n)


COLLATED_JOIN = """WITH cat AS (SELECT DISTINCT lower(c_mktsegment) || '  ' AS id, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS description FROM customer),
k AS (SELECT c_mktsegment AS k FROM customer UNION ALL SELECT id FROM cat)
SELECT c_custkey, c_mktsegment, cat.description AS szDescription,
       (SELECT count(DISTINCT lower(rtrim(k))) FROM k) AS n_keys, (SELECT count(DISTINCT k) FROM k) AS n_spellings
FROM customer LEFT JOIN cat ON lower(rtrim(id)) = lower(rtrim(c_mktsegment))"""

#: S6 the wide tracking's date logic as text: bonus since (strictly after), then the purchase and the sales orders' closed ranges.
TRACKED_ORDERS = """
SELECT si.szFSoId, si.szFPoId, si.szCustId, date_format(coalesce(po.dtmPO, so.dtmOrder), 'yyyy-MM-dd') AS order_date,
       coalesce(b.n_bonus, 0) AS n_bonus, b.bonus
FROM {si} si
LEFT JOIN {so} so ON si.szFSoId = so.szFSoId
LEFT JOIN {po} po ON si.szFPoId = po.szFPo_sId AND rtrim(si.szFPoId) <> ''
LEFT JOIN (SELECT bonus.szFSoId, count(*) AS n_bonus,
                  CAST(SUM(CAST(rint(bonus.decBonusAmount * 1e6D) AS DECIMAL(38,0))) AS DOUBLE) / 1e6D AS bonus
           FROM {bonus} bonus JOIN {so} o ON o.szFSoId = bonus.szFSoId WHERE o.dtmOrder > CAST(? AS TIMESTAMP_NTZ) GROUP BY bonus.szFSoId) b
       ON b.szFSoId = so.szFSoId
WHERE (rtrim(si.szFPoId) <> '' AND po.dtmPO >= CAST(? AS TIMESTAMP_NTZ) AND po.dtmPO <= CAST(? AS TIMESTAMP_NTZ))
   OR (rtrim(si.szFPoId) = '' AND so.dtmOrder >= CAST(? AS TIMESTAMP_NTZ) AND so.dtmOrder <= CAST(? AS TIMESTAMP_NTZ))"""
TRACKED_ARGS = ["1996-06-30", "1997-01-01", "1997-12-31", "1997-03-01", "1998-02-28"]


def q_bound_query(spark, sf):
    """S6 tracked orders and their bonus, a SQL text with five positional markers bound by Spark."""
    orders, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    return readers.bound_sql(spark, TRACKED_ORDERS, TRACKED_ARGS, si=R.inquiry(orders), so=R.sales_order(orders),
                             po=R.purchase_order(orders), bonus=R.tracking_so_item_bonus(li))


BOUND_QUERY = f"""WITH si AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS so,
         CASE WHEN o_orderstatus = 'F' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS po, o_custkey, o_orderkey, o_orderdate, o_orderstatus
  FROM orders),
b AS (SELECT l_orderkey, count(*) AS n, {fsum('l_extendedprice * l_discount', 6)} AS v
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      WHERE o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '1996-06-30' GROUP BY 1)
SELECT so AS szFSoId, po AS szFPoId, CAST(o_custkey AS VARCHAR) AS szCustId, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       coalesce(CASE WHEN so <> '' THEN b.n END, 0) AS n_bonus, CASE WHEN so <> '' THEN b.v END AS bonus
FROM si LEFT JOIN b ON b.l_orderkey = si.o_orderkey
WHERE (po <> '' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31')
   OR (po = '' AND o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate <= TIMESTAMP '1998-02-28')"""

EVENT_DDL = "event_id bigint, day date, event_type string, value double"


def event_lines(events: DataFrame) -> DataFrame:
    """Events as lines of JSON, a day a folder; some lines are cut short, some hold text for the number."""
    k = F.col("event_id")
    row = F.struct("event_id", F.to_date("ts").alias("day"), "event_type",
                   F.when(k % 75 == 1, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"))
    text = F.to_json(row)
    # A number is written without quotes, except where it is not one.
    text = F.when(k % 75 == 1, text).otherwise(F.regexp_replace(text, r'"value":"([^"]*)"', r'"value":$1'))
    text = F.when(k % 50 == 0, F.substring(text, 1, 25)).otherwise(text)
    return events.select(date_text("ts").alias("day_folder"), text.alias("line"))


def q_json_rejects(spark, sf):
    """S4/K6/K7 NDJSON files with bad lines: loaded and rejected lines per day's folder, and the loaded value."""
    root = _folder(spark, "json-rejects")
    event_lines(_t(spark, sf, "events")).write.partitionBy("day_folder").text(f"{root}/in")
    counts = readers.load_json_lines(spark, f"{root}/in/*", EVENT_DDL, f"{root}/loaded", f"{root}/rejects")
    def day_of(file):
        return F.regexp_extract(file, r"day_folder=([0-9-]+)", 1)
    counts = counts.groupBy(day_of("_file").alias("day")).agg(F.sum("n_loaded").alias("n_loaded"), F.sum("n_rejected").alias("n_rejected"))
    loaded = readers.read(spark, readers.SourceSpec(path=f"{root}/loaded", schema_ddl=EVENT_DDL))
    sums = loaded.groupBy(date_text("day").alias("_m")).agg(
        exact_sum("value", 6).alias("value"), F.max("event_id").alias("last_event"))
    bad = spark.read.parquet(f"{root}/rejects").groupBy(day_of("_file").alias("_b")).agg(
        F.sum(F.length("line")).alias("reject_chars"))
    return (counts.join(sums, counts["day"] == F.col("_m"), "left").join(bad, counts["day"] == F.col("_b"), "left")
            .select("day", "n_loaded", "n_rejected", "value", "last_event", (F.col("reject_chars") > 0).alias("has_rejects")))


JSON_REJECTS = f"""WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day, (event_id % 75 = 1 OR event_id % 50 = 0) AS bad FROM events)
SELECT day, CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS n_loaded, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected,
       {fsum('CASE WHEN NOT bad THEN value END', 6)} AS value, max(CASE WHEN NOT bad THEN event_id END) AS last_event,
       CASE WHEN bool_or(bad) THEN true END AS has_rejects
FROM e GROUP BY day"""


def q_bucketed_join(spark, sf):
    """K1/J13 lines and headers stored in equal buckets under table names, joined by merge without a shuffle."""
    root, tag = _folder(spark, "bucketed"), uuid.uuid4().hex[:12]
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = sinks.store_bucketed(li, f"lines_{tag}", ["l_orderkey"], 8, f"{root}/lines")
    heads = sinks.store_bucketed(o, f"heads_{tag}", ["o_orderkey"], 8, f"{root}/heads")
    j = lines.join(heads.hint("merge"), lines["l_orderkey"] == heads["o_orderkey"], "left")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "o_custkey", "o_orderstatus")


BUCKETED_JOIN = """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderstatus
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""


def q_loaded_tables(spark, sf):
    """K1-K5 a table with a declared schema, loaded, cleared and loaded again by eight tasks with its columns in another order;
    and one created from a frame's schema, partitioned. Both are read by name and counted per order."""
    root, tag = _folder(spark, "loads"), uuid.uuid4().hex[:12]
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    declared, framed = f"declared_{tag}", f"framed_{tag}"
    sinks.ensure_table(spark, declared, "l_quantity double, l_partkey bigint, l_orderkey bigint, l_linenumber int", f"{root}/declared")
    sinks.overwrite_table(li.where("l_linenumber = 1"), declared)
    sinks.overwrite_table(li, declared, partitions=8)
    sinks.ensure_table(spark, framed, li.schema, f"{root}/framed", partition_by=["l_linenumber"])
    sinks.overwrite_table(li, framed)
    out = None
    for name, label in ((declared, "declared"), (framed, "framed")):
        one = readers.read_named(spark, name, ["l_orderkey", "l_linenumber", "l_quantity"]).groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"), F.max("l_linenumber").alias("last_line"), exact_sum("l_quantity", 2).alias("qty"))
        one = one.select(F.lit(label).alias("loaded_as"), "*")
        out = one if out is None else out.unionByName(one)
    return out


LOADED_TABLES = f"""SELECT loaded_as, l_orderkey, count(*) AS n_lines, max(l_linenumber) AS last_line, {fsum('l_quantity', 2)} AS qty
FROM lineitem, (VALUES ('declared'), ('framed')) t(loaded_as) GROUP BY 1, 2"""


def q_published_sell_out(spark, sf):
    """K6-K9/S5 sell-out staged as NDJSON, published twice as a partitioned version and read through its name."""
    root, name = _folder(spark, "sell-out"), f"sell_out_{uuid.uuid4().hex[:12]}"
    docs = sell_out(R.sell_out_documents(_t(spark, sf, "events")), SELL_OUT_TWO_WEEKS, SELL_OUT_CHANNELS)
    publish_sell_out(docs.where(F.col("channel_name") != "view"), name, root, partition_by=["channel_name"])
    publish_sell_out(docs, name, root, staging_json=f"{root}/staging", partition_by=["channel_name"])
    return _sell_out_frame(readers.read_named(spark, name, schemas.SELL_OUT_FIELDS))


def q_order_bonus_strict(spark, sf):
    """M11 with ``strict``: an untaxed bonus has no tax part."""
    li, orders = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    return A.order_bonus(R.so_item(li), R.so_header(orders), R.so_item_bonus(li), order_since=BONUS_SINCE, strict=True)


ORDER_BONUS_STRICT = ORDER_BONUS.replace("ELSE 1.0 END AS wt1", "ELSE 0.0 END AS wt1")


def q_const_join_rows(spark, sf):
    """J11 as the source has it: every customer with every configuration row that the constants pick (regions with an A)."""
    regions = _t(spark, sf, "region").where(F.col("r_name").contains("A"))
    return J.attach_rows(_t(spark, sf, "customer").select("c_custkey", "c_name"), regions)


CONST_JOIN_ROWS = """SELECT c_custkey, c_name, r_regionkey, r_name FROM customer LEFT JOIN region ON r_name LIKE '%A%'"""


def q_approval_rows(spark, sf):
    """J18 as the source has it: a join a level, so levels given twice (lines of an order as approvals) show every combination."""
    orders, li = _t(spark, sf, "orders").select("o_orderkey"), _t(spark, sf, "lineitem")
    items = li.select("l_orderkey", (F.col("l_linenumber") % 3 + 1).alias("lv"), "l_linenumber", (F.col("l_tax") > 0.04).alias("ok"))
    out = J.join_levels(orders, "o_orderkey", items, "l_orderkey", "lv", [1, 2, 3], {"l_linenumber": "no", "ok": "approved"})
    return out.select("o_orderkey", *[c for n in (1, 2, 3) for c in (f"no{n}", f"approved{n}")])


APPROVAL_ROWS = """WITH i AS (SELECT l_orderkey, l_linenumber % 3 + 1 AS lv, l_linenumber AS no, l_tax > 0.04 AS ok FROM lineitem)
SELECT o_orderkey, a.no AS no1, a.ok AS approved1, b.no AS no2, b.ok AS approved2, c.no AS no3, c.ok AS approved3
FROM orders LEFT JOIN i a ON a.l_orderkey = o_orderkey AND a.lv = 1 LEFT JOIN i b ON b.l_orderkey = o_orderkey AND b.lv = 2
LEFT JOIN i c ON c.l_orderkey = o_orderkey AND c.lv = 3"""


def q_typed_fields(spark, sf):
    """E9/E15/E16 flags as tiny integers joined to a flag dimension (J10), document ids out of extended JSON, rows as JSON."""
    orders = _t(spark, sf, "orders")
    docs = orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("bCash"),
                         F.when(F.col("o_orderkey") % 2 == 0, F.format_string('{"$oid": "%d"}', "o_orderkey"))
                         .otherwise(F.col("o_orderkey").cast("string")).alias("_id"))
    flags = _t(spark, sf, "region").where("r_regionkey < 2").select(F.col("r_regionkey").cast("tinyint").alias("btFlag"),
                                                                    F.col("r_name").alias("szFlagName"))
    typed = docs.select("o_orderkey", bit_to_tiny("bCash").alias("btCash"), object_id_text("_id").alias("szId"))
    j = typed.join(flags, typed["btCash"] == flags["btFlag"], "left")
    return j.select("o_orderkey", F.col("btCash").cast("int").alias("btCash"), "szId", "szFlagName",
                    F.to_json(F.struct("szId", "btCash")).alias("json"))


TYPED_FIELDS = """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS btCash, CAST(o_orderkey AS VARCHAR) AS szId, r_name AS szFlagName,
       '{"szId":"' || o_orderkey || '","btCash":' || CAST(o_orderstatus = 'F' AS INTEGER) || '}' AS json
FROM orders LEFT JOIN region ON r_regionkey = CAST(o_orderstatus = 'F' AS INTEGER)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "org_climb": q_org_climb,
        "do_last_replacement": q_do_last_replacement,
        "sales_lattice": q_sales_lattice,
        "period_trend": q_period_trend,
        "same_day_trend": q_same_day_trend,
        "collated_join": q_collated_join,
        "bound_query": q_bound_query,
        "json_rejects": q_json_rejects,
        "bucketed_join": q_bucketed_join,
        "loaded_tables": q_loaded_tables,
        "published_sell_out": q_published_sell_out,
        "order_bonus_strict": q_order_bonus_strict,
        "const_join_rows": q_const_join_rows,
        "approval_rows": q_approval_rows,
        "typed_fields": q_typed_fields,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "org_climb": ORG_CLIMB,
        "do_last_replacement": DO_LAST_REPLACEMENT,
        "sales_lattice": SALES_LATTICE,
        "period_trend": PERIOD_TREND,
        "same_day_trend": SAME_DAY_TREND,
        "collated_join": COLLATED_JOIN,
        "bound_query": BOUND_QUERY,
        "json_rejects": JSON_REJECTS,
        "bucketed_join": BUCKETED_JOIN,
        "loaded_tables": LOADED_TABLES,
        "published_sell_out": SELL_OUT_SLICES,
        "order_bonus_strict": ORDER_BONUS_STRICT,
        "const_join_rows": CONST_JOIN_ROWS,
        "approval_rows": APPROVAL_ROWS,
        "typed_fields": TYPED_FIELDS,
    }
