"""T7/T8 sales mart: one view over Sell-In, Sell-Through and Sell-Out at the
grain (stage, date, store, SKU), roll-ups, month-to-date trends, stage
pivots and top-N drill-downs.

Money is summed in fixed point (``exprs.exact_sum``) so every total is exact
and the same however the data is partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import exact_sum, fixed_units, units_value
from ..operators.windows import month_to_date, period_change, top_n_per_group

GRAIN = ["stage", "date", "store", "sku"]
STAGES = ("sell_in", "sell_through", "sell_out")
VALUE_SCALE = 4


def stage_frame(df: DataFrame, stage: str, date, store, sku, qty, value) -> DataFrame:
    """Project one stage's facts to the common grain."""
    return df.select(F.lit(stage).cast("string").alias("stage"), F.to_date(date).alias("date"),
                     F.col(store).cast("bigint").alias("store") if isinstance(store, str) else store.alias("store"),
                     F.col(sku).cast("bigint").alias("sku") if isinstance(sku, str) else sku.alias("sku"),
                     (F.col(qty) if isinstance(qty, str) else qty).cast("double").alias("qty"),
                     (F.col(value) if isinstance(value, str) else value).cast("double").alias("value"))


def stage_facts(df: DataFrame, stages: Sequence[tuple]) -> DataFrame:
    """Several stages of one scan: each row is written once per stage, as
    (stage, date, store, sku, qty, value, condition) given by ``stages``."""
    def one(stage, date, store, sku, qty, value, condition):
        fact = F.struct(F.lit(stage).cast("string").alias("stage"), F.to_date(date).alias("date"),
                        F.col(store).cast("bigint").alias("store"), F.col(sku).cast("bigint").alias("sku"),
                        F.col(qty).cast("double").alias("qty"), value.cast("double").alias("value"))
        return fact if condition is None else F.when(condition, fact)
    return (df.select(F.explode(F.array(*[one(*s) for s in stages])).alias("f")).where(F.col("f").isNotNull())
            .select("f.*"))


def all_stages(frames: Sequence[DataFrame]) -> DataFrame:
    """U2 union of the stages' facts."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def unified_sales(facts: DataFrame) -> DataFrame:
    """T7 the stages' facts summed at the grain."""
    return facts.groupBy(*GRAIN).agg(exact_sum("qty", VALUE_SCALE).alias("qty"),
                                   exact_sum("value", VALUE_SCALE).alias("value"))


def sales_summary(df: DataFrame, dims: Sequence[str], value: str, how: str = "cube",
                  scale: int = 2) -> DataFrame:
    """A8 multi-level roll-up (``cube`` or ``rollup``) with ``grouping_id``."""
    g = df.cube(*dims) if how == "cube" else df.rollup(*dims)
    return g.agg(exact_sum(value, scale).alias("total_value"), F.count(F.lit(1)).alias("n_rows"),
                 F.grouping_id(*dims).alias("grouping_id"))


def mtd_trend(df: DataFrame, date_col: str, value: str, keys: Sequence[str] = (), scale: int = 2) -> DataFrame:
    """W2/W3 per day: the day's value, the month-to-date running total, the
    previous day's value and the change. Sums run on whole units."""
    daily = (df.groupBy(*keys, F.to_date(date_col).alias("day"))
             .agg(F.sum(fixed_units(value, scale)).alias("_units")))
    mtd = month_to_date(daily, "day", "_units", keys=keys, alias="_mtd_units")
    mtd = mtd.select(*keys, "day", units_value("_units", scale).alias("day_value"),
                     units_value("_mtd_units", scale).alias("mtd_value"))
    return period_change(mtd, "day", "day_value", keys=keys,
                         prev_alias="prev_day_value", change_alias="day_change")


def stage_pivot(facts: DataFrame, by: Sequence[str] = ("date", "store", "sku"),
                stages: Sequence[str] = STAGES) -> DataFrame:
    """A9 value per stage side by side, one column per stage, straight from
    the stages' facts (:func:`all_stages`): one shuffle."""
    return facts.groupBy(*by).agg(*[
        exact_sum(F.when(F.col("stage") == s, F.col("value")), VALUE_SCALE).alias(f"{s}_value") for s in stages])


def top_n(df: DataFrame, group: Sequence[str], item: str, value: str, n: int = 3, scale: int = 4) -> DataFrame:
    """W4 the ``n`` items with the largest summed value per group (ties by the
    smaller item id), pruned in each task before the shuffle."""
    agg = df.groupBy(*group, item).agg(exact_sum(value, scale).alias("total_value"))
    return top_n_per_group(agg, group, [F.col("total_value").desc(), F.col(item).asc()], n)
