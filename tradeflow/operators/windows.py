"""Trends and rankings for the sales mart: month-to-date running totals,
period-over-period change, top-N per group.

Windows here only ever run over pre-aggregated rows whose count per window
partition is bounded by the calendar (at most 31 days per month and key), or
over a two-stage top-N that bounds what reaches the final ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import fixed_units, units_value


def month_to_date(daily: DataFrame, date_col: str, value_col: str, *, keys: Sequence[str] = (),
                  alias: str = "mtd_value") -> DataFrame:
    """W2 running total from the first day of the month to each day. Feed it
    one row per (keys, day): then a window partition holds at most 31 rows."""
    w = (Window.partitionBy(*keys, F.trunc(F.col(date_col), "month"))
         .orderBy(F.col(date_col)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumn(alias, F.sum(value_col).over(w))


def period_change(df: DataFrame, date_col: str, value_col: str, *, keys: Sequence[str] = (),
                  prev_alias: str = "prev_value", change_alias: str = "change") -> DataFrame:
    """W3 value of the calendar day before and the change against it; ``df``
    has one row per (keys, date). Months and years: :func:`calendar_change`.

    Each row is written under its own date and under the next day's, and
    the two meet in one grouped pass: the input is read once, and no
    partition ever holds a whole key's history."""
    shifted = F.date_add(F.col(date_col), 1)
    rest = [c for c in df.columns if c not in (*keys, date_col)]
    own = F.struct(F.col(date_col).alias("d"), F.struct(*[F.col(c) for c in rest]).alias("own"),
                   F.lit(None).cast(df.schema[value_col].dataType).alias("prev"))
    nxt = F.struct(shifted.alias("d"), F.lit(None).alias("own"), F.col(value_col).alias("prev"))
    both = df.select(*keys, F.explode(F.array(own, nxt)).alias("_r"))
    met = (both.groupBy(*keys, F.col("_r.d").alias(date_col))
           .agg(F.max("_r.own").alias("_own"), F.max("_r.prev").alias(prev_alias)).where(F.col("_own").isNotNull()))
    out = met.select(*keys, date_col, *[F.col("_own." + c).alias(c) for c in rest], prev_alias)
    return out.withColumn(change_alias, F.col(value_col) - F.col(prev_alias))


def calendar_spine(df: DataFrame, period: str, keys: Sequence[str], step: str) -> DataFrame:
    """Every calendar ``step`` (day, month, year) from a key's first period to its last: one row each, gaps included."""
    span = df.groupBy(*keys).agg(F.min(period).alias("_lo"), F.max(period).alias("_hi"))
    every = F.sequence("_lo", "_hi", F.expr(f"INTERVAL 1 {step.upper()}"))
    return span.select(*keys, F.explode(every).alias(period))


def calendar_change(df: DataFrame, date_col: str, value_col: str, *, keys: Sequence[str] = (), step: str = "month",
                    scale: int = 2) -> DataFrame:
    """W3 by calendar period: per key and period its sum, the sum of the period
    just before and the change. A period without rows shows with null values,
    and the one after it has no change.

    Periods are a day or the first day of a month or year, so month ends
    cannot meet. A window partition holds one key's periods, which the
    calendar bounds.
    """
    if step not in ("day", "month", "year"):
        raise ValueError(f"unknown step {step!r}")
    day = F.to_date(F.col(date_col))
    period = day if step == "day" else F.trunc(day, step)
    sums = (df.where(F.col(date_col).isNotNull()).groupBy(*keys, period.alias("period"))
            .agg(F.sum(fixed_units(value_col, scale)).alias("_units")))
    spine = calendar_spine(sums, "period", keys, step)
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"v.{k}")) for k in keys] + [F.col("s.period") == F.col("v.period")]
    rows = spine.alias("s").join(sums.alias("v"), same, "left").select(
        *[F.col(f"s.{k}").alias(k) for k in keys], F.col("s.period").alias("period"), "_units")
    before = F.lag("_units").over(Window.partitionBy(*keys).orderBy("period"))
    rows = rows.withColumn("_before", before)
    return rows.select(*keys, "period", units_value("_units", scale).alias("value"), units_value("_before", scale).alias("prev_value"),
                       units_value(F.col("_units") - F.col("_before"), scale).alias("change"))


def same_day_change(df: DataFrame, date_col: str, value_col: str, *, keys: Sequence[str] = (), months: int = 1,
                    scale: int = 2) -> DataFrame:
    """W3 day against day: per key and day its sum and that of the same day
    ``months`` before, or of that month's last day where it is shorter (31
    March looks at 29 or 28 February). Every day of the calendar between a
    key's first and last is there."""
    sums = (df.where(F.col(date_col).isNotNull()).groupBy(*keys, F.to_date(F.col(date_col)).alias("day"))
            .agg(F.sum(fixed_units(value_col, scale)).alias("_units")))
    spine = calendar_spine(sums, "day", keys, "day").withColumn("prior_day", F.add_months("day", -months))

    def meet(on: str, name: str):
        other = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("day").alias("_day"), F.col("_units").alias(name))
        cond = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(on) == F.col("_day")]
        return other, cond
    now, on_day = meet("day", "_now")
    rows = spine.join(now, on_day, "left").drop("_day", *[f"_{k}" for k in keys])
    then, on_prior = meet("prior_day", "_then")
    rows = rows.join(then, on_prior, "left").drop("_day", *[f"_{k}" for k in keys])
    return rows.select(*keys, "day", "prior_day", units_value("_now", scale).alias("value"),
                       units_value("_then", scale).alias("prior_value"), units_value(F.col("_now") - F.col("_then"), scale).alias("change"))


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], n: int, *,
                    rank_alias: str = "rank") -> DataFrame:
    """W4 the ``n`` best rows per group by ``order`` (which must end in a
    unique tie-break so the result is deterministic).

    Spark prunes to ``n`` rows per group in each task before the shuffle
    (``WindowGroupLimit``), so at most ``n`` rows per group and task meet.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_alias, F.row_number().over(w)).where(F.col(rank_alias) <= n)
