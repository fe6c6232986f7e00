"""SimHash near-dedup over pivot distance tables.

A document's 64-bit fingerprint is the majority bit of the XXH64 hashes of
its word shingles. Two fingerprints are linked when they differ in at most
``max_bits`` (2) bits; components of links are groups of near copies.

Candidate search. Each distinct fingerprint has a row of Hamming distances to
many reference fingerprints (pivots). By the triangle inequality a pair may
be linked only if no coordinate differs by more than ``max_bits``. Some
pivots are the zero fingerprint changed inside one 16-bit band only, so their
coordinates, taken relative to zero's, depend on that band alone. Two
differing bits touch at most two of the four bands; hence a linked pair has
equal coordinates in some pair of bands. Fingerprints are dealt by those six
coordinate groups, pairs of a bucket are discarded by their maximum
coordinate difference over all pivots, and survivors are verified bit by bit.
A bucket reports a spanning set of its verified links, never all pairs.

Buckets over ``bucket_limit`` fingerprints take an exact way without pairs:
each member is written under itself and its 64 one-bit neighbours; two
fingerprints share such a key exactly if they differ in at most two bits, and
every member of a key is linked to the key's smallest. Work is linear in the
members, and no key is held in one task.

Cases: null or empty text has fingerprint zero and links like any other;
fewer words than a shingle make one shingle of all. Equal fingerprints are
one node, so copies are never paired. component_id is the smallest id
reachable (nulls last; null only if all are). Repeated rows get equal
results. Only the id (cast to a long) and text columns are read. An empty table gives an
empty result. Rows are told apart by their position, so the input must be a
stored table or another repeatable frame.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import free_name, row_ids, saved, text_of
from tradeflow.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BANDS = 4
BAND_PIVOTS = 12
WIDE_PIVOTS = 15
BUCKET_LIMIT = 128
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the A-Z-lowered words' shingles; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only ASCII case and white space
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] = iter((b" ".join(words),))
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at:at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["id", "row_id", "fp"])
    return run


def pivots() -> np.ndarray:
    """The reference fingerprints: zero, then each band's, then some over all bits. Fixed by the seed."""
    rng = np.random.default_rng(SEED)
    width = 64 // BANDS
    inside = [rng.integers(1, 1 << width, BAND_PIVOTS, dtype=np.uint64) << np.uint64(width * b) for b in range(BANDS)]
    wide = rng.integers(0, 1 << 64, WIDE_PIVOTS, dtype=np.uint64)
    return np.concatenate([np.zeros(1, np.uint64), *inside, wide])


def pivot_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp): six keys for each fingerprint, one for each pair of bands."""
    refs = pivots()
    mix = np.random.default_rng(SEED + 1).integers(0, 1 << 63, (BANDS, BAND_PIVOTS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    pairs = [(i, j) for i in range(BANDS) for j in range(i + 1, BANDS)]
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        rows = pivot_table(fps, refs).astype(np.int64)
        own = (rows[:, 1:1 + BANDS * BAND_PIVOTS] - rows[:, :1]).view(np.uint64).reshape(-1, BANDS, BAND_PIVOTS)
        bands = (own * mix[None]).sum(axis=2, dtype=np.uint64)
        keys = []
        for k, (i, j) in enumerate(pairs):
            key = (bands[:, i] * np.uint64(0x9E3779B97F4A7C15)) ^ (bands[:, j] + np.uint64(k))
            keys.append(key ^ (key >> np.uint64(29)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fps.view(np.int64), len(pairs)))],
            names=["key", "fp"])


def bucket_links(fps: np.ndarray, refs: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning set of the links inside one bucket of distinct fingerprints."""
    table = pivot_table(fps, refs)
    group = np.arange(len(fps))
    out = []
    for i in range(len(fps) - 1):
        rest = table[i + 1:]
        near = np.flatnonzero((np.abs(rest - table[i]) <= max_bits).all(axis=1)) + i + 1
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= max_bits]
        for j in near:
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                out.append((i, int(j)))
    return out


def _verified(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        for b in batches:
            a, c = [], []
            for cell in b.column(0):
                fps = np.sort(np.array(cell.as_py(), np.int64)).view(np.uint64)
                for i, j in bucket_links(fps, refs, max_bits):
                    a.append(fps[i])
                    c.append(fps[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.uint64).view(np.int64)),
                                              pa.array(np.array(c, np.uint64).view(np.int64))], names=["a", "b"])
    return run


def links(nodes: DataFrame, *, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) among distinct fingerprints that connect all pairs within ``max_bits``."""
    if max_bits != 2:
        raise ValueError("four bands and one-bit neighbours are exact for max_bits = 2")
    keys = saved(nodes.select("fp").mapInArrow(_band_keys, "key long, fp long"), "band-keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = saved(keys.join(sizes, "key"), "buckets")
    small = (member.where(F.col("n") <= bucket_limit).groupBy("key").agg(F.collect_list("fp").alias("fps"))
             .select("fps").mapInArrow(_verified(max_bits), "a long, b long"))
    flips = F.transform(F.sequence(F.lit(-1), F.lit(63)), lambda i: F.when(i < 0, F.col("fp")).otherwise(
        F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    spread = (member.where(F.col("n") > bucket_limit).select("fp").distinct()
              .select("fp", F.explode_outer(flips).alias("near")))
    low = spread.groupBy("near").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    large = (spread.join(low, "near").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return small.union(large)


def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id, kept, row_id.

    ``kept`` marks one row of each component: the one with the smallest id.
    """
    fps = saved(
        docs.select(F.col(id_col).cast("long").alias("id"), row_ids(docs).alias("row_id"),
                    text_of(text_col).alias("text"))
        .mapInArrow(_fingerprints(shingle), "id long, row_id long, fp long"), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_id")).alias("first"))
    roots = components(links(nodes, max_bits=max_bits, bucket_limit=bucket_limit))
    placed = saved(nodes.join(roots, nodes.fp == roots.node, "left")
                   .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    heads = placed.groupBy("root").agg(F.min("first").alias("head"))
    of = placed.join(heads, "root").select("fp", F.col("head.id").alias("component_id"),
                                           F.col("head.row_id").alias("head_row"))
    return fps.join(of, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("row_id") == F.col("head_row")).alias("kept"), "row_id")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies, all columns kept."""
    pos = free_name(docs, "row_id")
    kept = near_copies(docs, id_col=id_col, text_col=text_col).where("kept").select(F.col("row_id").alias(pos))
    return docs.withColumn(pos, row_ids(docs)).join(kept, pos, "left_semi").drop(pos)
