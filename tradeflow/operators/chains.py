"""Pointer chains of any length: a manager's manager, a replacement's
replacement.

Each row names the next key. Pointer doubling follows all chains at once: in a
round every key takes over the pointer of the key it points at, so the
distance covered doubles, and chains of a million steps need twenty rounds.
A round is one equi join; its result is written to the shared folder, so plans
stay short and a lost executor costs a reread.

A key whose chain never ends (it is on a cycle or leads into one) has no end:
``end`` is null and ``in_cycle`` true. After as many rounds as the number of
keys has bits, every chain that ends has ended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import latest_per_key


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back: a lineage cut that survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/jobs/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def follow(links: DataFrame, key: str, next_key: str) -> DataFrame:
    """One row per distinct non-null ``key``: key, ``end`` (the last key of its
    chain), ``steps`` to it and ``in_cycle``.

    A chain ends at a key that has no row, or whose next is null. A key given
    twice takes its greatest next. A key that points at itself is a cycle.
    """
    at = (links.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(next_key).alias("next")))
    live = at.where(F.col("next").isNotNull())
    ends = at.where(F.col("next").isNull()).select("key", F.col("key").alias("end"), F.lit(0).cast("long").alias("steps"))
    state = written(live.select("key", F.col("next").alias("to"), F.lit(1).cast("long").alias("steps")), "chains")
    done = written(ends, "chain-ends")
    # ``state`` holds keys whose pointer still has to be followed; ``done`` those whose end is known.
    parts = [done]
    n = state.count()
    for _ in range(max(1, n.bit_length()) + 1):
        if n == 0:
            break
        own = state.select(F.col("key").alias("_k"), F.col("to").alias("_to"), F.col("steps").alias("_s"))
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        found = found.select(F.col("key").alias("_e"), F.col("end").alias("_end"), F.col("steps").alias("_es"))
        met = (state.join(own, state["to"] == own["_k"], "left").join(found, state["to"] == found["_e"], "left")
               .select("key", "to", "steps", "_k", "_to", "_s", "_e", "_end", "_es"))
        met = written(met, "chain-round")
        # The key pointed at is done (its end is ours), unknown (it is our end), or still on its way.
        over = met.where(F.col("_k").isNull()).select(
            "key", F.when(F.col("_e").isNotNull(), F.col("_end")).otherwise(F.col("to")).alias("end"),
            (F.col("steps") + F.coalesce("_es", F.lit(0))).alias("steps"))
        parts.append(over)
        state = met.where(F.col("_k").isNotNull()).select("key", F.col("_to").alias("to"), (F.col("steps") + F.col("_s")).alias("steps"))
        n = state.count()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select("key", "end", "steps", F.lit(False).alias("in_cycle"))
    lost = state.select("key", F.lit(None).cast(out.schema["end"].dataType).alias("end"),
                        F.lit(None).cast("long").alias("steps"), F.lit(True).alias("in_cycle"))
    return out.unionByName(lost)


def climb_to_top(df: DataFrame, start_col: str, org: DataFrame, org_key: str, parent_col: str) -> DataFrame:
    """J8 to any depth: ``df`` with the top of each row's hierarchy (``top``),
    its distance (``levels``, 0 for a top itself) and ``in_cycle``. A start key
    that the organisation does not have gets nulls."""
    known = org.select(F.col(org_key).alias("_k"))
    parent = org.join(known.distinct(), org[parent_col] == F.col("_k"), "left").select(
        F.col(org_key).alias("_key"), F.when(F.col("_k").isNotNull(), F.col(parent_col)).alias("_parent"))
    ends = follow(parent, "_key", "_parent").toDF("_key", "top", "levels", "in_cycle")
    return df.join(ends, df[start_col] == ends["_key"], "left").drop("_key")


def last_replacement(history: DataFrame, *, old_key: str = "szDoIdOld", new_key: str = "szDoId",
                     order_by: str = "dtmLastUpdated") -> DataFrame:
    """J17 for orders replaced more than once: per replaced order the last of
    its replacements (``hist_new``) and their number. Of several replacements
    of one order the latest counts, ties by the greater new id. Orders whose
    replacements run in a circle have no last one."""
    latest = latest_per_key(history, old_key, order_by=[order_by], tie_break=[new_key], values=[])
    ends = follow(latest, old_key, new_key)
    return ends.select(F.col("key").alias("hist_old"), F.col("end").alias("hist_new"),
                       F.col("steps").alias("replacements"), "in_cycle")
