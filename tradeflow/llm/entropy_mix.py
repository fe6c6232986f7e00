"""Mixing sources to target weights by entropy balancing.

Each source gets a token target: a share of the mix by weight, never above
``max_repeat`` times what it has; the excess is reshared by weight until no
source is above. Rates are the closest to one (in Kullback-Leibler
divergence, counted in tokens) that meet the targets:

    minimise  sum_d size_d (r_d log r_d - r_d)   with   sum_{d in s} size_d r_d = target_s

Its dual is convex in one multiplier for each source, and the rates are
exponentially tilted: ``r_d = exp(lambda_source(d))``. Newton's method solves
the dual; each iteration is one distributed pass that sums tilted tokens over
the (source, size) histogram, so a hot source is combined before the shuffle
and the multipliers stay a table.

Rates become copies by systematic rounding along each source in the order of
size, then of an id hash: the k-th document takes
``floor(r(k+1) + 1/2) - floor(r k + 1/2)`` copies. Neighbours have nearly
equal sizes, so a source misses its target by less than its longest document,
and no document gets more than ``max_repeat`` copies. A few passes then shrink
what is missed: in each, every source adds or drops one copy of its longest
document that still fits in the gap. The place k comes from a range sort that
splits hot sources and sizes.

Cases: null text has size zero, and documents without words keep their rate
and take zero words. A null source is a source of its own, last in order. A
source without words has target zero. An empty table gives an empty result.
Repeated rows are separate documents. Only the id, text and source columns
are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import free_name, one_row, ranked, row_ids, saved, text_of, words_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
TOLERANCE = 1e-9
MAX_STEPS = 60
SETTLING_PASSES = 4
SALTS = 32


def source_targets(sources: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sources`` (source, place, tokens) with weight and target."""
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    s = sources.withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int")))
    cap = F.col("tokens") * F.lit(float(max_repeat))
    total, open_weight = one_row(s.agg(F.sum("tokens"), F.sum("weight")))
    level, closed = 0.0, -1
    if total:
        level = share * total / open_weight
        while True:
            full = F.col("weight") * F.lit(level) >= cap
            n, used, rest = one_row(s.agg(F.count_if(full), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))))
            if n == closed or not rest:
                break
            closed, level = n, (share * total - (used or 0.0)) / rest
    return s.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def balance(histogram: DataFrame, targets: DataFrame, *, tolerance: float = TOLERANCE,
            max_steps: int = MAX_STEPS) -> DataFrame:
    """Newton's method on the dual. histogram: (place, size, n); targets: (place, target). Returns (place, rate)."""
    dual = saved(targets.where("target > 0").select("place", "target", F.lit(0.0).alias("lam")), "dual")
    for _ in range(max_steps):
        tilted = histogram.join(dual, "place").groupBy("place").agg(
            F.sum(F.col("n") * F.col("size") * F.exp("lam")).alias("tokens"))
        step = (F.col("tokens") - F.col("target")) / F.col("tokens")
        dual = saved(dual.join(tilted, "place").select(
            "place", "target", (F.col("lam") - step).alias("lam"),
            F.abs(F.col("tokens") / F.col("target") - 1).alias("gap")), "dual")
        (gap,) = one_row(dual.agg(F.max("gap")))
        dual = dual.drop("gap")
        if gap is None or gap <= tolerance:
            break
    return dual.select("place", F.exp("lam").alias("rate"))


def settle(docs: DataFrame, *, max_repeat: int = MAX_REPEAT, passes: int = SETTLING_PASSES) -> DataFrame:
    """docs: (place, k, size, target, copies, ...). Moves each source's total towards its target."""
    for _ in range(passes):
        gaps = docs.groupBy("place").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & F.when(
            F.col("gap") > 0, F.col("copies") < max_repeat).otherwise(F.col("copies") > 0)
        # A hot source is dealt by salt, and only one row of each salt meets the others.
        spread = gaps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = docs.select("place", "k", "size", "copies", F.pmod("k", F.lit(SALTS)).cast("int").alias("salt"))
        pick, move = F.max(F.struct("size", "k")).alias("pick"), F.max(F.signum("gap")).cast("int").alias("move")
        best = (own.join(spread, ["place", "salt"]).where(fits).groupBy("place", "salt").agg(pick, move)
                .groupBy("place").agg(F.max("pick").alias("pick"), F.max("move").alias("move"))
                .select("place", F.col("pick.k").alias("k"), "move"))
        docs = saved(docs.join(best, ["place", "k"], "left").withColumn(
            "copies", F.col("copies") + F.coalesce("move", F.lit(0))).drop("move"), "settled")
    return docs


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, rate, copies, taken, row_id."""
    sizes = saved(docs.select(
        F.col(id_col).alias("id"), row_ids(docs).alias("row_id"), F.col(source_col).alias("source"),
        F.size(words_of(text_of(text_col))).cast("long").alias("size")), "sizes")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.xxhash64("id"), F.col("id"), F.col("row_id")]
    placed = ranked(sizes, order, "k")
    histogram = placed.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"))
    sources = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("tokens"),
                                              F.min("first").alias("first"))
    targets = saved(source_targets(ranked(sources, [F.col("first")], "place"), weights=weights, share=share,
                                   max_repeat=max_repeat), "targets")
    same = histogram.source.eqNullSafe(targets.source)
    rates = balance(saved(histogram.join(targets, same).select("place", "size", "n"), "histogram"), targets)
    plan = targets.join(rates, "place", "left").select(
        F.col("source").alias("of"), "place", "first", F.col("tokens").alias("source_size"), "target",
        F.least(F.coalesce("rate", F.lit(0.0)), F.lit(float(max_repeat))).alias("rate"))
    d = placed.join(plan, placed.source.eqNullSafe(plan.of))
    k = F.col("k") - F.col("first")
    copies = F.floor(F.col("rate") * (k + 1) + 0.5) - F.floor(F.col("rate") * k + 0.5)
    d = settle(saved(d.select("id", "row_id", "place", "k", "size", "source_size", "target", "rate",
                              copies.cast("int").alias("copies")), "copies"), max_repeat=max_repeat)
    return d.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "rate", "copies",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken"), "row_id")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as :func:`mix` says, all columns kept."""
    pos = free_name(docs, "row_id")
    times = free_name(docs, "copies")
    taken = mix(docs, **options).where("copies > 0").select(F.col("row_id").alias(pos), F.col("copies").alias(times))
    joined = docs.withColumn(pos, row_ids(docs)).join(taken, pos)
    again = free_name(joined, "copy")
    return joined.withColumn(again, F.explode_outer(F.array_repeat(F.lit(1), F.col(times)))).select(
        *(joined[c] for c in docs.columns))
