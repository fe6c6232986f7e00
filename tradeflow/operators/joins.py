"""Join-shaped operators of the source queries, written as DataFrame plans.

Broadcast policy: an explicit ``F.broadcast`` is used only for a side whose
size is bounded by construction (a global aggregate of one row). Every other join
is left to Catalyst, whose ``autoBroadcastJoinThreshold`` checks the planned
size, and to AQE, which re-plans to a broadcast once a shuffle stage shows the
real size. Beyond the threshold the join is a sort-merge join, which AQE
splits when a key is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col, is_blank


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def filtered_lookup(df: DataFrame, dim: DataFrame, on: Column, right_pred: Column | None = None,
                    how: str = "left") -> DataFrame:
    """J1/J3 left join where constants on the right side of ON filter the
    right side *before* the join, so unmatched left rows are kept."""
    right = dim if right_pred is None else dim.where(right_pred)
    return df.join(right, on, how)


def without_reversed(docs: DataFrame, doc_key: str, reversals: DataFrame, *,
                     reversed_col: str, reversing_col: str, applied_col: str,
                     reversal_id_col: str | None = None, only_if: Column | None = None) -> DataFrame:
    """J7: keep documents that no applied reversal names, in either role.

    The source writes two left joins plus ``IS NULL`` tests on the reversal
    id; a match whose reversal id is null does not exclude the document, so
    such rows are ignored here as well. The two roles are merged into one key
    set, so the documents are shuffled for one anti join, not two.
    ``only_if`` limits the exclusion to rows where it holds (e.g. the
    delivery order was found by the preceding left join).
    """
    live = reversals.where(F.col(applied_col))
    if reversal_id_col is not None:
        live = live.where(F.col(reversal_id_col).isNotNull())
    keys = (live.select(F.explode(F.array(reversed_col, reversing_col)).alias("_rev_key"))
            .where(F.col("_rev_key").isNotNull()))
    cond = docs[doc_key] == keys["_rev_key"]
    if only_if is not None:
        cond = cond & only_if
    return docs.join(keys, cond, "left_anti")


def latest_per_key(df: DataFrame, keys, order_by: Sequence[str], values: Sequence[str],
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """W1/J15: one row per key, the one with the greatest ``order_by``
    (nulls last, as ``ORDER BY ... DESC`` puts them in the source dialect),
    ties broken by the greatest ``tie_break``.

    Written as a ``max`` over a struct, so Spark combines partial maxima on the
    map side: a key holding a third of all rows never lands in one task as a
    whole (a ``row_number`` window would sort and buffer it there).
    """
    keys = _cols(keys)
    ordered = list(order_by) + [t for t in tie_break if t not in order_by]
    payload = [v for v in values if v not in ordered and v not in keys]
    packed = F.struct(*[F.col(c) for c in ordered + payload]).alias("_best")
    out = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return out.select(*keys, *[F.col("_best." + c).alias(c) for c in ordered + payload])


def top1_global(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """J17/O2 ``SELECT TOP 1 ... ORDER BY``: each partition keeps its best
    row, the driver merges one row per partition."""
    return df.orderBy(*[col(c) for c in order_by]).limit(1)


def climb(df: DataFrame, start_col: str, org: DataFrame, org_key: str, parent_col: str,
          name_col: str, levels: int = 3, prefix: str = "lvl") -> DataFrame:
    """J8: follow a parent pointer ``levels`` times (sales organisation, line
    manager), adding ``{prefix}{n}_id`` and ``{prefix}{n}_name`` per level.
    Spark broadcasts the organisation table if its size allows."""
    side = org.select(F.col(org_key).alias("_k"), F.col(parent_col).alias("_p"), F.col(name_col).alias("_n"))
    out = df
    current = F.col(start_col)
    for n in range(1, levels + 1):
        lv = side.select(F.col("_k").alias(f"{prefix}{n}_id"),
                         F.col("_p").alias(f"_{prefix}{n}_parent"),
                         F.col("_n").alias(f"{prefix}{n}_name"))
        out = out.join(lv, current == lv[f"{prefix}{n}_id"], "left")
        current = F.col(f"_{prefix}{n}_parent")
    return out.drop(*[f"_{prefix}{n}_parent" for n in range(1, levels + 1)])


def _only(values: Column, count: Column, what: str) -> Column:
    """``values`` if ``count`` is at most one, else an error when the row is made."""
    return F.when(count > 1, F.raise_error(F.concat(F.lit(what + " has several rows: "), count.cast("string")))
                  ).otherwise(values)


def attach_single_row(df: DataFrame, side: DataFrame) -> DataFrame:
    """J11 join whose ON clause holds only constants on the right side.

    The right side must have at most one row; a global aggregate proves it,
    so the join is a broadcast of a one-row table and cannot multiply the
    left side. Several rows are an error, none yields nulls, as the left join
    does.
    """
    cols = side.columns
    packed = F.struct(*[F.col(c) for c in cols])
    one = side.agg(F.min(packed).alias("_one"), F.count(F.lit(1)).alias("_n"))
    one = one.select(_only(F.col("_one"), F.col("_n"), "the constant join").alias("_one"))
    one = one.select(*[F.col("_one." + c).alias(c) for c in cols])
    return df.join(F.broadcast(one), F.lit(True), "left")


def attach_rows(df: DataFrame, side: DataFrame, max_rows: int = 1000) -> DataFrame:
    """J11 in the source's own form: every row of ``df`` with every row of
    ``side`` (nulls if there is none), as a left join on constants gives them.

    The right side is packed into one row of at most ``max_rows`` structs (more
    are an error), so what is broadcast has a proven bound; each left row then
    unpacks it.
    """
    packed = F.struct(*[F.col(c) for c in side.columns])
    few = side.limit(max_rows + 1).agg(F.collect_list(packed).alias("_rows"))
    few = few.select(F.when(F.size("_rows") > max_rows, F.raise_error(F.lit(f"the constant join has over {max_rows} rows")))
                     .otherwise(F.col("_rows")).alias("_rows"))
    one = df.join(F.broadcast(few), F.lit(True), "left").withColumn("_row", F.explode_outer("_rows"))
    return one.select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in side.columns])


def settings_pivot(info: DataFrame, key_col: str, item_col: str, value_col: str,
                   items: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """J12: seven chained template/value lookups per workplace become one
    filtered scan and one grouped pass with a fixed item list (one row per
    key). An item given twice for a key is an error: the chained lookups
    would multiply the key's rows."""
    names = list(names) if names else [f"setting_{i}" for i in items]

    def one(item) -> Column:
        here = F.col(item_col) == item
        return _only(F.max(F.when(here, F.col(value_col))), F.count_if(here), f"setting {item}")
    return (info.where(F.col(item_col).isin(list(items))).groupBy(key_col)
            .agg(*[one(i).alias(n) for i, n in zip(items, names)]))


def pivot_levels(items: DataFrame, key_col: str, level_col: str, levels: Sequence[int],
                 values: dict[str, str]) -> DataFrame:
    """J18/M26: the source joins an approval table once per level. One
    grouped pass with a fixed level list gives one row per key. All values of
    a level, ``{alias}{level}``, come from one row: of a repeated level, the
    one with the greatest values in the order given (nulls lowest)."""
    best = F.struct(*[F.col(src).alias(alias) for src, alias in values.items()])
    aggs = [F.max(F.when(F.col(level_col) == lv, best)).alias(f"_{lv}") for lv in levels]
    picked = items.groupBy(key_col).agg(*aggs, F.max(level_col).alias("max_level"))
    return picked.select(key_col, *[F.col(f"_{lv}.{alias}").alias(f"{alias}{lv}") for lv in levels
                                    for alias in values.values()], "max_level")


def join_levels(df: DataFrame, key: Column | str, items: DataFrame, item_key: str, level_col: str,
                levels: Sequence[int], values: dict[str, str]) -> DataFrame:
    """J18 in the source's own form: the items are joined once per level, so a
    level given twice shows every combination."""
    out = df
    for lv in levels:
        one = items.where(F.col(level_col) == lv).select(
            F.col(item_key).alias(f"_key{lv}"), *[F.col(src).alias(f"{alias}{lv}") for src, alias in values.items()])
        out = out.join(one, col(key) == one[f"_key{lv}"], "left").drop(f"_key{lv}")
    return out


def fallback(current, alternative) -> Column:
    """J19/M23 prefer ``alternative`` unless it is blank."""
    return F.when(is_blank(alternative), col(current)).otherwise(col(alternative))


def either_side_lines(left_lines: DataFrame, right_lines: DataFrame, key: str,
                      left_pred: Column, right_pred: Column) -> DataFrame:
    """J20/F10 without the lines-by-lines product.

    The source joins both line tables to one document, filters
    ``left_pred OR right_pred`` on the pairs and shows only left columns under
    DISTINCT. A left line survives if it passes ``left_pred`` or if *any*
    right line of the document passes ``right_pred``. The right side is
    reduced to one flag per document first; no pair is ever built.
    """
    flags = (right_lines.groupBy(F.col(key).alias("_doc"))
             .agg(F.max(F.coalesce(right_pred, F.lit(False))).alias("_right_ok")))
    joined = left_lines.join(flags, left_lines[key] == flags["_doc"], "left")
    keep = F.coalesce(left_pred, F.lit(False)) | F.coalesce(F.col("_right_ok"), F.lit(False))
    return joined.where(keep).drop("_doc", "_right_ok")


def assert_unique(df: DataFrame, keys) -> None:
    """Raise if ``keys`` repeat. Dropping an unused left join is only
    row-preserving when the dimension key is unique; run this on the
    dimensions once per load."""
    dup = df.groupBy(*_cols(keys)).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dup[0].asDict()} in {list(_cols(keys))}")
