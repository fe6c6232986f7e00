"""Quality rules with a hashed n-gram log-likelihood ratio.

Base rules look at one text: enough words, and not too many of them inside
repeated 3-word windows. The verdict on the rest compares two multinomials
over hashed 1- and 2-grams of letter runs and symbol runs: one counted over
trusted documents, one over the whole corpus. A document's score is the mean
of ``log(p_trusted / p_corpus)`` over its n-grams (length-normalised), and it
is kept when the score reaches a fixed threshold.

Everything is DataFrame functions. The counting pass sends at most
``buckets`` rows from each task; the scoring pass has no shuffle: the weight
table (``buckets`` numbers, whatever the corpus) is a constant of the plan.

Cases: null text counts as empty: no words, base_failed, not kept, no score.
No trusted documents: nothing to compare with, so the score is null and the
base rules decide. Repeated rows each get their own (equal) result. Only the
id and text columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import text_of, words_of

#: n-gram units: runs of letters, or runs of anything else but white space and letters.
UNITS = r"\p{L}+|[^\p{L}\s]+"
SYMBOLS = r"[#*$%&|<>]"
BUCKETS = 1 << 14
THRESHOLD = -0.25
#: At most so many trusted documents are used, taken by hash order; bounds the broadcast of their ids.
TRUSTED_LIMIT = 20_000


def _buckets(buckets: int):
    """Buckets of a unit and of it with the next; the last unit stands alone twice."""
    def pair(a: Column, b: Column) -> tuple[Column, Column]:
        return F.pmod(F.hash(a), F.lit(buckets)), F.pmod(F.hash(a, b), F.lit(buckets))
    return pair


def _with_next(units: Column, f) -> Column:
    return F.zip_with(units, F.slice(units, 2, F.greatest(F.size(units), F.lit(1))), f)


def _units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNITS), F.lit(0))


def trusted_sample(labels: DataFrame, *, id_col: str = "doc_id", limit: int = TRUSTED_LIMIT) -> DataFrame:
    """Ids of at most ``limit`` documents labelled good and not toxic."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col(id_col).alias("id"))
    return good.distinct().orderBy(F.xxhash64("id"), "id").limit(limit)


def gram_weights(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 buckets: int = BUCKETS) -> list[float] | None:
    """``log(p_trusted / p_corpus)`` of each bucket, add-one smoothed; None without trusted documents."""
    marked = docs.select(F.col(id_col).alias("id"), _units(text_of(text_col)).alias("units")).join(
        F.broadcast(trusted.withColumn("trusted", F.lit(1))), "id", "left")
    pair = _buckets(buckets)

    def packed(a: Column, b: Column) -> Column:
        one, two = pair(a, b)
        return one.cast("long") * buckets + two
    # explode_outer: a plain explode would infer a filter that repeats the whole expression.
    grams = marked.select("trusted", F.explode_outer(_with_next(F.col("units"), packed)).alias("p")).where("p IS NOT NULL")
    both = F.array(F.floor(F.col("p") / buckets).cast("int"), F.pmod("p", F.lit(buckets)).cast("int"))
    counts = (
        grams.select("trusted", F.explode(both).alias("bucket"))
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count("trusted").alias("t"))
    )
    raw, good = [1] * buckets, [1] * buckets
    for bucket, n, t in counts.collect():  # at most `buckets` rows
        raw[bucket] += n
        good[bucket] += t
    if sum(good) == buckets:
        return None
    shift = math.log(sum(raw)) - math.log(sum(good))
    return [math.log(g) - math.log(r) + shift for g, r in zip(good, raw)]


def base_measures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  whole: bool = False) -> DataFrame:
    """doc_id, doc (the whole row as a struct, if asked for), text, and the counts of the base rules."""
    doc = F.struct(*(docs[c] for c in docs.columns)) if whole else F.lit(None)
    d = docs.select(F.col(id_col).alias("doc_id"), doc.alias("doc"), text_of(text_col).alias("text"))
    d = d.withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.slice(F.transform("words", lambda w, i: F.xxhash64(
        w, F.get("words", i + 1), F.get("words", i + 2))), 1, F.greatest(F.size("words") - 2, F.lit(0)))
    d = d.select(
        "doc_id", "doc", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"), windows.alias("windows"))
    # Windows in the order of their hash, each with its place; equal neighbours are repeats.
    d = d.withColumn("placed", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.transform("placed", lambda e, k: F.when(
        (e.h == F.get("placed", k - 1).h) | (e.h == F.get("placed", k + 1).h), e.i))
    d = d.withColumn("again", F.sort_array(F.filter(again, lambda i: i.isNotNull())))
    covered = F.aggregate(
        "again", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a.n + F.least(F.lit(3), i - a.last)).alias("n"), i.alias("last")),
        lambda a: a.n)
    return d.select(
        "doc_id", "doc", "text", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def llr(units: Column, weights: list[float] | None) -> Column:
    """Mean weight of the n-grams of a text's units; null if it has none."""
    if weights is None:
        return F.lit(None).cast("double")
    table = F.split(F.lit(",".join(f"{w:.9g}" for w in weights)), ",").cast("array<double>")
    pair = _buckets(len(weights))

    def weight(a: Column, b: Column) -> Column:
        one, two = pair(a, b)
        return F.get(table, one) + F.get(table, two)
    total = F.aggregate(_with_next(units, weight), F.lit(0.0), lambda s, w: s + w)
    return F.when(F.size(units) > 0, total / (2 * F.size(units)))


def quality_rules(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  buckets: int = BUCKETS, threshold: float = THRESHOLD, whole: bool = False) -> DataFrame:
    """One row per document: its counts, base_failed, kept and llr (the score); doc is its row if ``whole``."""
    weights = gram_weights(docs, trusted, id_col=id_col, text_col=text_col, buckets=buckets)
    d = base_measures(docs, id_col=id_col, text_col=text_col, whole=whole)
    d = d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    d = d.withColumn("units", F.when(~F.col("base_failed"), _units(F.col("text")))).drop("text")
    # The row number keeps a later filter on `kept` above these columns: pushed below, it would write the word arrays
    # into every lambda that refers to them, and the work would grow with the square of a text.
    d = d.withColumn("llr", llr(F.col("units"), weights)).drop("units").withColumn("row", F.monotonically_increasing_id())
    good = ~F.col("base_failed") & (F.coalesce("llr", F.lit(0.0)) >= threshold)
    return d.withColumn("kept", good & (F.col("row") >= 0)).drop("row")


def keep_good(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`quality_rules` rejects, all columns kept."""
    found = quality_rules(docs, trusted, id_col=id_col, text_col=text_col, whole=True).where("kept")
    return found.select("doc.*")
