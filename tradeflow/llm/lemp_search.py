"""Ranked lexical search: the best documents of each query, by an integer BM25.

A document is a vector of impacts over the queries' terms, a query a vector of
term weights; a score is their inner product. Following LEMP, documents are
ordered by the length of their vectors, longest first, and cut into buckets:

* **Between buckets**, by Cauchy-Schwarz: no document of a bucket scores above
  the query's length times the bucket's longest vector. A bucket that cannot
  reach a query's tenth best score is skipped for that query.
* **Inside a bucket**, by coordinates: the greatest impact of each term in the
  bucket bounds what the term can add. The terms with the least bounds, which
  together cannot reach the tenth score, are set aside; only documents that
  hold one of the others are looked at, and those whose partial score, with
  the lesser of the set-aside terms' bound and Cauchy-Schwarz over them, falls
  short are dropped.
* **Survivors** are scored anew in 64-bit integers, all terms.

On Spark: one pass reads the texts and keeps, for each document, its length
and the terms that queries ask for; counts are summed. A second pass computes
impacts and lengths and deals the vectors by ranges of length, so a partition
is a run of buckets. The longest partition is searched first; the tenth best
scores found there are the floor from which all other partitions start. A
task keeps ten rows a query, and Spark merges them.

Queries are taken in blocks of bounded text, each block against all documents.
One item's terms are held whole.

Terms are the maximal runs of ASCII letters and digits and all non-ASCII
characters, with A-Z lower-cased. Cases: null and empty texts have no terms
and count for nothing; a null document id is ranked after all others of its
score; rows of equal id are documents of their own; items of equal or null id
are items of their own; an item without terms, or none of whose terms occurs,
has no row. An empty table on either side gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import one_row, saved, shared_path, text_of

TOP = 10
#: Text of the queries taken at once, documents of a bucket, bytes of vectors in a partition.
BLOCK_BYTES = 4 << 20
BUCKET = 8_192
PART_BYTES = 32 << 20
#: Fixed values of the score.
SCALE, TF_SCALE, TF_ADD, LEN_BASE, LEN_PART, WEIGHT_SCALE = 1_000_000_000, 1000, 8, 25, 75, 1000
NO_ID = (1 << 63) - 1

#: Bytes to terms: separators become a space, A-Z lower case; bytes of other characters stay.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


# Pass 1: lengths and the queries' terms --------------------------------------------

_VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"


def _int_lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _read_terms(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for b in batches:
            lengths, terms, tfs = [], [], []
            for text in b.column(1):
                words = text.as_buffer().to_pybytes().translate(TERM_BYTES).split()
                lengths.append(len(words))
                held = [(t, n) for t, n in ((known(w), n) for w, n in Counter(words).items()) if t is not None]
                held.sort()
                terms.append(np.array([t for t, _ in held], np.int32))
                tfs.append(np.array([n for _, n in held], np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths, pa.int64()), _int_lists(terms), _int_lists(tfs)],
                                             names=["doc_id", "n", "terms", "tfs"])
    return run


def _count_terms(size: int):
    """Documents of each term, summed in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])
    return run


# Pass 2: impacts and lengths of vectors ---------------------------------------------

def impacts_of(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(SCALE * tf) div (1000 * tf + 8 * m), m = 25 + (75 * n * N) div L, for arrays of equal length."""
    m = LEN_BASE + (LEN_PART * n.astype(np.int64) * n_docs) // max(n_terms, 1)
    tf = tf.astype(np.int64)
    return (SCALE * tf) // (TF_SCALE * tf + TF_ADD * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _lengths(weights: np.ndarray, n_docs: int, n_terms: int):
    """Adds the length of the vector of sqrt(weight) * impact, so that a query's side has sqrt(weight) * count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            terms, tfs = lists.flatten().to_numpy(), b.column(3).flatten().to_numpy()
            v = impacts_of(tfs, np.repeat(b.column(1).to_numpy(), sizes), n_docs, n_terms).astype(np.float64)
            row = np.repeat(np.arange(b.num_rows), sizes)
            norm = np.sqrt(np.bincount(row, weights=v * v * weights[terms], minlength=b.num_rows))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norm)], names=["doc_id", "n", "terms", "tfs", "norm"])
    return run


# Pass 3: search ---------------------------------------------------------------------

class Queries:
    """A block of queries: terms, counts and weights, and the score that a document must reach."""

    def __init__(self, items: list[tuple[int, Counter]], weights: np.ndarray):
        self.weights = weights
        self.items = []
        for number, counts in items:
            terms = np.array(sorted(t for t in counts if weights[t] > 0), np.int64)
            each = np.array([counts[t] for t in terms.tolist()], np.int64)
            self.items.append((number, terms, each * weights[terms], math.sqrt(float((each * each * weights[terms]).sum()))))


class Best:
    """The best ``TOP`` (score, doc_id) of a query, equal scores by ascending id."""

    def __init__(self, floor: int):
        self.floor, self.scores, self.ids = floor, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:TOP]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == TOP:
            self.floor = max(self.floor, int(self.scores[-1]))


class Bucket:
    """Vectors of neighbouring lengths, with the documents of each term."""

    def __init__(self, ids, n, sizes, terms, tfs, norms, n_docs, n_terms):
        self.ids, self.sizes, self.terms, self.norms = ids, sizes, terms, norms
        self.values = impacts_of(tfs, np.repeat(n, sizes), n_docs, n_terms)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.longest = float(norms.max(initial=0.0))
        row = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(terms, kind="stable")
        self.post_row, self.post_value = row[order], self.values[order]
        self.held, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(order))
        self.bound = np.maximum.reduceat(self.post_value, first) if len(first) else np.zeros(0, np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, length: float, all_weights: np.ndarray, best: Best) -> None:
        floor = max(best.floor, 1)
        if length * self.longest * (1 + 1e-9) < floor:  # Cauchy-Schwarz for the whole bucket
            return
        at = np.searchsorted(self.held, terms)
        there = at < len(self.held)
        there[there] = self.held[at[there]] == terms[there]
        if not there.any():
            return
        at, weights, terms = at[there], weights[there], terms[there]
        most = weights.astype(np.float64) * self.bound[at]
        order = np.argsort(-most, kind="stable")
        at, weights, terms, most = at[order], weights[order], terms[order], most[order]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0.0)  # rest[i]: bound of terms i and after
        if rest[0] * (1 + 1e-9) < floor:
            return
        needed = int(np.flatnonzero(rest * (1 + 1e-9) < floor)[0])  # terms that a document must hold one of
        rows = np.concatenate([self.post_row[self.first[i]:self.first[i + 1]] for i in at[:needed]])
        adds = np.concatenate([w * self.post_value[self.first[i]:self.first[i + 1]].astype(np.float64)
                               for i, w in zip(at[:needed], weights[:needed].tolist())])
        partial = np.bincount(rows, weights=adds, minlength=len(self.ids))
        seen = np.flatnonzero(partial > 0)
        left = weights[needed:].astype(np.float64)
        aside = np.sqrt((left * left / all_weights[terms[needed:]]).sum()) * self.norms[seen]
        reach = (partial[seen] + np.minimum(rest[needed], aside)) * (1 + 1e-9)
        rows = seen[reach >= floor]
        if len(rows):
            scores = self.exact(rows, terms, weights, len(all_weights))
            good = scores >= floor
            best.add(scores[good], self.ids[rows[good]])

    def exact(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
        """Scores of some documents in integers, all terms."""
        query = np.zeros(size, np.int64)
        query[terms] = weights
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        entry = np.arange(int(ends[-1])) + np.repeat(self.starts[rows] - (ends - sizes), sizes)
        sums = np.concatenate([[0], np.cumsum(query[self.terms[entry]] * self.values[entry])])
        return sums[ends] - sums[ends - sizes]


_FOUND = "item int, doc_id long, score long"


def _search(queries: Queries, floors: dict[int, int], n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(floors.get(number, 0)) for number, *_ in queries.items]
        for whole in batches:
            for i in range(0, whole.num_rows, BUCKET):
                b = whole.slice(i, BUCKET)
                sizes = np.diff(b.column(2).offsets.to_numpy())
                bucket = Bucket(b.column(0).to_numpy(), b.column(1).to_numpy(), sizes, b.column(2).flatten().to_numpy(),
                                b.column(3).flatten().to_numpy(), b.column(4).to_numpy(), n_docs, n_terms)
                for (_, terms, weights, length), found in zip(queries.items, best):
                    if len(terms):
                        bucket.search(terms, weights, length, queries.weights, found)
        numbers = [n for (n, *_), found in zip(queries.items, best) for _ in found.ids]
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64)] + [f.ids for f in best])),
             pa.array(np.concatenate([np.zeros(0, np.int64)] + [f.scores for f in best]))], names=["item", "doc_id", "score"])
    return run


def _top(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def _search_block(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    """docs: (doc_id, text); items: (number, text). item, rank, doc_id, score."""
    spark = docs.sparkSession
    words = [(number, Counter(terms_of(text))) for number, text in items]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*(c for _, c in words))))}
    size = len(vocabulary)
    vectors = saved(docs.mapInArrow(_read_terms(vocabulary), _VECTORS), "vectors")
    n_docs, n_terms = one_row(vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))))
    df = np.zeros(size, np.int64)
    held = vectors.select("terms").mapInArrow(_count_terms(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for term, n in held.collect():  # at most one row a term of this block
        df[term] = n
    weights = np.array([weight(n_docs, int(n)) if n else 0 for n in df], np.int64)
    queries = Queries([(number, Counter({vocabulary[w]: n for w, n in c.items()})) for number, c in words], weights)

    long_ = vectors.where(F.size("terms") > 0).mapInArrow(
        _lengths(weights.astype(np.float64), n_docs, n_terms), _VECTORS + ", norm double")
    (entries,) = one_row(vectors.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))))
    parts = max(1, -(-entries * 8 // PART_BYTES), min(4 * spark.sparkContext.defaultParallelism, -(-n_docs // BUCKET)))
    by_length = [F.desc("norm"), F.asc("doc_id")]
    path = saved_by(long_.repartitionByRange(parts, *by_length).sortWithinPartitions(*by_length)
                    .withColumn("part", F.spark_partition_id()), "part", "by-length")
    first = saved(_top(path.where("part = 0").select("doc_id", "n", "terms", "tfs", "norm").mapInArrow(
        _search(queries, {}, n_docs, n_terms), _FOUND)), "floors")
    floors = dict(first.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
                  .where(F.col("n") >= TOP).select("item", "low").collect())  # one row an item of this block
    others = path.where("part > 0").select("doc_id", "n", "terms", "tfs", "norm").mapInArrow(
        _search(queries, floors, n_docs, n_terms), _FOUND)
    return _top(first.drop("rank").unionByName(others))


def saved_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """As :func:`common.saved`, in a folder for each value of ``key``, so that a filter on it reads only those."""
    path = shared_path(df.sparkSession, name)
    df.write.partitionBy(key).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of each item's ten best documents."""
    spark = docs.sparkSession
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), text_of(text_col).alias("text"))
    named = saved(items.select(F.col(item_col).alias("item_id"), text_of(item_text_col).alias("text"))
                  .withColumn("item", F.monotonically_increasing_id()), "items")
    (size,) = one_row(named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))))
    blocks = max(1, -(-size // BLOCK_BYTES))
    block_of = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    for block in range(blocks):
        own = [(r.item, r.text) for r in named.where(block_of == block).select("item", "text").collect()]
        if not own:
            continue
        numbers = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(own)], "number int, item long")
        part = _search_block(d, [(i, text) for i, (_, text) in enumerate(own)])
        part = part.withColumnRenamed("item", "number").join(F.broadcast(numbers), "number").drop("number")
        part = saved(part, "found") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    if found is None:  # no items
        found = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    return found.join(named.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"),
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
