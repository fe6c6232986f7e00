"""Connected components of a link table, by repeated contraction.

In each round every linked node moves to the node of lowest hash among itself
and its neighbours; links are rewritten to where their ends went, and those
that vanish are dropped. Hash order makes the expected number of rounds
logarithmic, also for long chains, and a star of any size takes one round.
Rounds are grouped minima and joins, written to the shared folder: nothing is
collected, and a node with a great many links is combined map-side and its
links are split by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``links``: long columns (a, b). Returns (node, root) of every node that has a link; roots map to themselves."""
    now = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "links")
    moves = []
    while not now.isEmpty():
        both = now.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                          .alias("l")).select("l.a", "l.b")
        low = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), "b")).alias("low"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("b"))
        move = saved(low.select(F.col("a").alias("node"), F.least("low", own)["b"].alias("root")), "moves")
        moves.append(move)
        left, right = move.toDF("a", "x"), move.toDF("b", "y")
        now = saved(now.join(left, "a").join(right, "b").where("x <> y")
                    .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
    if not moves:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0]
    for move in moves[1:]:
        step = move.toDF("root", "next")
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
