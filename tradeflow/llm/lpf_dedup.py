"""Exact substring dedup with longest-previous-factor arrays.

A byte is repeated when a ``length``-byte string that covers it also starts
elsewhere. To find such strings without comparing all positions, every
``length``-byte window elects an anchor: the place of the smallest hash among
its ``GRAM``-byte grams. The choice depends on the window's bytes alone, so
equal windows elect the same place in them. A cell is the run of windows that
elect one anchor, and holds few hundred bytes.

1. Cells are counted by their anchor's gram; those of grams that occur once
   hold no repeated window.
2. Equal cells (same bytes) repeat as a whole.
3. For grams with several different cells, one of each kind is compared byte
   by byte. Bundles of such groups get a suffix array (prefix doubling), the
   array of common prefixes, and longest-previous-factor arrays from previous
   and next smaller positions in suffix order: a window whose factor reaches
   ``length`` repeats an earlier one. The same arrays over reversed positions
   give the later ones. Groups larger than ``group_bytes`` take an exact way
   without a group in one task: each of their windows is a row, counted by
   gram, offset and a 128-bit digest.
4. The repeated windows of a document, found in any way, are joined to its
   text once and cut out.

Positions are bytes of UTF-8. Matches never cross documents; a string may
repeat inside one document, also overlapping itself.

Cases: null or empty text has no bytes, and texts shorter than ``length``
have nothing to remove. Repeated rows are copies of each other. Only the id (cast to a long)
and text columns are read. An empty table gives an empty result. Rows are
told apart by their position, so the input must be a stored table or another
repeatable frame.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import row_ids, saved, text_of

LENGTH = 200
GRAM = 24
#: Bytes of text that anchors are chosen for at a time, if no document is longer.
SCAN = 1 << 18
#: Bytes of the groups that share a suffix array; of a group that gets one.
BUNDLE_BYTES, GROUP_BYTES = 1 << 19, 1 << 20
SPANS = "array<struct<start: long, stop: long>>"
#: Grams that occur more often than this, and in more than one of HOT_SHARE cells, are combined by cell before they
#: are dealt; there are fewer than HOT_SHARE of them, whatever the corpus.
HOT_GRAM, HOT_SHARE = 20_000, 10_000
_POWER = 0x9E3779B97F4A7C15 | 1
_MIX = 0xD6E8FEB86659FD93


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2**64."""
    inverse = pow(_POWER, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _POWER, np.uint64)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]), dtype=np.uint64)
    return up, down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(32))


class Scanner:
    """Cells of texts."""

    def __init__(self, length: int):
        self.length, self.width = length, length - GRAM + 1
        self.codes = np.random.default_rng(3).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.room = 0

    def cells(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, gram hash, cell hash, first window, windows, anchor's offset in the first window) of every cell."""
        L, W = self.length, self.width
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts) + bytes(L + W), np.uint8)
        n = len(data)
        if n > self.room:
            self.room = max(n, SCAN + (SCAN >> 2))
            self.up, self.down = _powers(self.room)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.codes[data] * self.up[:n], dtype=np.uint64)])
        hashes = _mixed((sums[GRAM:] - sums[:-GRAM]) * self.down[:n - GRAM + 1])
        # Smallest hash, then the first place, of W grams from each place on: by blocks of W, from both sides.
        m = (len(hashes) // W) * W
        low_bits = np.uint64((1 << 32) - 1)
        keys = (hashes[:m] & ~low_bits) | np.arange(m, dtype=np.uint64)
        block = keys.reshape(-1, W)
        ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
        back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        low = np.minimum(back[:m - W + 1], ahead[W - 1:])
        anchor = (low & low_bits).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        text = np.repeat(np.arange(len(texts)), np.maximum(sizes - L + 1, 0))
        if not len(text):
            return (np.zeros(0, np.int64),) * 6
        windows = np.maximum(sizes - L + 1, 0)
        within = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = starts[text] + within
        chosen = anchor[at]
        edge = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])]))
        count = np.diff(np.append(edge, len(text)))
        first = at[edge]
        span = count + L - 1
        body = (sums[first + span] - sums[first]) * self.down[first]
        offset = chosen[edge] - first
        cell = _mixed(_mixed(body + np.uint64(1)) + offset.astype(np.uint64) * np.uint64(_POWER) + count.astype(np.uint64))
        return text[edge], hashes[chosen[edge]], cell, within[edge], count, offset


def _scan(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(length)

        def out(rows: list[int], texts: list[bytes]) -> pa.RecordBatch:
            text, gram, cell, first, count, offset = scanner.cells(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(rows, np.int64)[text]), pa.array(gram.view(np.int64)), pa.array(cell.view(np.int64)),
                 pa.array(first.astype(np.int32)), pa.array(count.astype(np.int16)), pa.array(offset.astype(np.int16))],
                names=["row_id", "gram", "cell", "first", "count", "shift"])
        for b in batches:
            rows, texts, size = [], [], 0
            for row, cell in zip(b.column(0).to_pylist(), b.column(1)):
                data = cell.as_py().encode("utf-8")
                rows.append(row)
                texts.append(data)
                size += len(data)
                if size >= SCAN:
                    yield out(rows, texts)
                    rows, texts, size = [], [], 0
            if rows:
                yield out(rows, texts)
    return run


CELLS = "row_id long, gram long, cell long, first int, count short, shift short"


def scan(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs: (row_id, text). Cells of all documents."""
    return docs.select("row_id", "text").mapInArrow(_scan(length), CELLS)


# Equal cells --------------------------------------------------------------------

def repeated_cells(cells: DataFrame) -> DataFrame:
    """Cells whose gram occurs again: with n (equal cells), lead (first of them), mixed (the gram has others), kinds."""
    grams = saved(cells.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "grams")
    total = grams.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    hot = F.col("times") > max(HOT_GRAM, total // HOT_SHARE)
    kind = Window.partitionBy("gram", "cell")
    gram = Window.partitionBy("gram")
    hot_grams = F.broadcast(grams.where(hot).select("gram"))  # fewer than HOT_SHARE
    cold = (
        cells.join(hot_grams, "gram", "left_anti").join(grams.where(~hot).select("gram"), "gram")
        .withColumn("n", F.count(F.lit(1)).over(kind))
        .withColumn("lead", F.row_number().over(kind.orderBy("row_id", "first")) == 1)
        .withColumn("mixed", F.min("cell").over(gram) != F.max("cell").over(gram))
        .withColumn("kinds", F.count_if("lead").over(gram))
    )
    some = cells.join(hot_grams, "gram")
    kinds = some.groupBy("gram", "cell").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_id", "first")).alias("head"))
    all_kinds = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    # Written, so that the join has a shuffle of its own on both sides, which Spark can split at a frequent cell.
    kinds = saved(kinds.join(all_kinds, "gram"), "kinds")
    warm = some.join(kinds, ["gram", "cell"]).select(
        *cells.columns, "n", (F.struct("row_id", "first") == F.col("head")).alias("lead"),
        (F.col("kinds") > 1).alias("mixed"), "kinds")
    wanted = (F.col("n") > 1) | F.col("mixed")
    return cold.select(warm.columns).union(warm).where(wanted)


# Suffix arrays ------------------------------------------------------------------

def suffix_array(symbols: np.ndarray, reach: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes in the order of their first ``reach`` symbols, and the ranks by 4, 8, 16, ... symbols on the way."""
    n = len(symbols)
    s = np.concatenate([symbols.astype(np.uint64), np.zeros(4, np.uint64)])
    if n and int(s.max()) >> 16:
        s = np.unique(s, return_inverse=True)[1].astype(np.uint64)
        if int(s.max()) >> 16:
            raise ValueError("too many symbols")
    key = (s[:n] << np.uint64(48)) | (s[1:n + 1] << np.uint64(32)) | (s[2:n + 2] << np.uint64(16)) | s[3:n + 3]
    levels, h = [], 4
    while True:
        order = np.argsort(key)
        line = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], line[1:] != line[:-1]]))
        levels.append((h, rank))
        if h >= reach or not n or rank[order[-1]] == n:
            return order, levels
        after = np.zeros(n, np.int64)
        after[:max(n - h, 0)] = rank[h:]
        key = (rank * (n + 1) + after).astype(np.uint64)
        h *= 2


def common_prefixes(order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Symbols that each suffix shares with the one before it in order, in steps of 4 and up to the last level."""
    n = len(order)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    a, b = order[:-1].copy(), order[1:].copy()
    for h, rank in reversed(levels):
        padded = np.concatenate([rank, np.zeros(1, np.int64)])
        x, y = padded[np.minimum(a, n)], padded[np.minimum(b, n)]
        same = (x == y) & (x > 0)
        out[1:] += same * h
        a += same * h
        b += same * h
    return out


def _nearest_smaller(order: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """For each place in suffix order, the common prefix with the nearest place before it that holds a smaller position.

    All pointers jump at once; a pointer may jump over what its target jumped over. Prefixes below ``least`` count as 0.
    """
    to, best = np.arange(len(order)) - 1, np.where(common >= least, common, 0)
    to[best == 0] = -1
    move = np.flatnonzero(to >= 0)
    move = move[order[to[move]] > order[move]]
    while len(move):
        j = to[move]
        low, nxt = np.minimum(best[move], best[j]), to[j]
        best[move], to[move] = low, np.where(low > 0, nxt, -1)
        move = move[to[move] >= 0]
        move = move[order[to[move]] > order[move]]
    best[to < 0] = 0
    return best


def longest_previous_factors(order: np.ndarray, common: np.ndarray, least: int = 1) -> np.ndarray:
    """For each position, the longest prefix of its suffix that starts earlier too (0 if shorter than ``least``)."""
    n = len(order)
    before = _nearest_smaller(order, common, least)
    # From the other side: neighbours change sides, and each common prefix moves to the place before.
    after = _nearest_smaller(order[::-1], np.concatenate([[0], common[:0:-1]]) if n else common, least)[::-1]
    out = np.zeros(n, np.int64)
    out[order] = np.maximum(before, after)
    return out


def repeats(bodies: list[bytes], length: int, earlier_only: bool = False) -> list[np.ndarray]:
    """Of every body, whether the ``length`` bytes from each place on start elsewhere (or earlier) in the bodies."""
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    ends = np.cumsum(sizes)
    symbols = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(bodies), np.uint8) + 1
    symbols[ends - 1] = 257 + np.arange(len(bodies))  # each body ends in a symbol of its own
    order, levels = suffix_array(symbols, length)
    common = common_prefixes(order, levels)
    found = longest_previous_factors(order, common, length) >= length
    if not earlier_only:
        n = len(order)
        found |= (longest_previous_factors(n - 1 - order, common, length) >= length)[::-1]
    return [found[e - z:e - 1] for e, z in zip(ends, sizes)]


# Cells of several kinds ---------------------------------------------------------

def _bodies(length: int):
    """(row_id, text, cells) to one row for each cell with its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for row, text, cells in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                data = text.as_py().encode("utf-8")
                for c in cells:
                    out.append((c["gram"], row, c["first"], c["shift"], c["kinds"], data[c["first"]:c["first"] + c["count"] + length - 1]))
                if len(out) >= 4_000:
                    yield _batch(out, BODY_FIELDS)
                    out = []
            if out:
                yield _batch(out, BODY_FIELDS)
    return run


BODY_FIELDS = (("gram", pa.int64()), ("row_id", pa.int64()), ("first", pa.int32()), ("shift", pa.int16()), ("kinds", pa.int64()),
               ("body", pa.binary()))
BODY = "gram long, row_id long, first int, shift short, kinds long, body binary"
RUN_FIELDS = (("row_id", pa.int64()), ("first", pa.int32()), ("count", pa.int32()))
RUN = "row_id long, first int, count int"


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _runs(row: int, first: int, marks: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, first window, windows) of the runs of marks."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
    return [(row, first + int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


def _compare(length: int, earlier_only: bool):
    """Bundles of whole groups (rows arrive in the order of gram, row, place) to runs of repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            # Within a bundle, earlier means earlier in the corpus.
            held.sort(key=lambda x: (x[0], x[1]))
            found: list[tuple] = []
            for (row, first, body), marks in zip(held, repeats([x[2] for x in held], length, earlier_only)):
                found += _runs(row, first, np.ascontiguousarray(marks[:len(body) - length + 1]))
            held.clear()
            return _batch(found, RUN_FIELDS)
        last = None
        for b in batches:
            for gram, row, first, body in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 5))):
                if gram != last and size >= BUNDLE_BYTES:
                    yield out()
                    size = 0
                last = gram
                held.append((row, first, body))
                size += len(body)
        if held:
            yield out()
    return run


def _digests(length: int):
    """One row for each window of a body: gram, offset, digest, row, place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = (("gram", pa.int64()), ("shift", pa.int32()), ("digest", pa.binary()), ("row_id", pa.int64()), ("first", pa.int32()))
        for b in batches:
            rows: list[tuple] = []
            for gram, row, first, shift, body in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 3, 5))):
                for k in range(len(body) - length + 1):
                    rows.append((gram, shift - k, xxhash.xxh3_128_digest(body[k:k + length]), row, first + k))
                if len(rows) > 50_000:
                    yield _batch(rows, fields)
                    rows = []
            yield _batch(rows, fields)
    return run


def _mixed_runs(cells: DataFrame, docs: DataFrame, length: int, earlier_only: bool) -> DataFrame:
    """Runs of repeated windows among cells of several kinds, one cell of each kind."""
    wanted = cells.groupBy("row_id").agg(F.collect_list(F.struct("gram", "first", "count", "shift", "kinds")).alias("cells"))
    bodies = docs.join(wanted, "row_id").select("row_id", "text", "cells").mapInArrow(_bodies(length), BODY)
    per_body = 2 * length
    large = F.col("kinds") * per_body > GROUP_BYTES
    bodies = saved(bodies, "bodies")
    dealt = bodies.where(~large).repartition("gram").sortWithinPartitions("gram", "row_id", "first")
    small = dealt.mapInArrow(_compare(length, earlier_only), RUN)
    rows = bodies.where(large).mapInArrow(
        _digests(length), "gram long, shift int, digest binary, row_id long, first int")
    keys = ["gram", "shift", "digest"]
    head = F.min(F.struct("row_id", "first")).alias("head")
    again = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), head).where("n > 1").drop("n")
    place = F.struct("row_id", "first")
    marked = rows.join(again, keys).where(F.lit(not earlier_only) | (place != F.col("head")))
    return small.union(marked.select("row_id", "first", F.lit(1).alias("count")))


# Cutting ------------------------------------------------------------------------

def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for b in batches:
            sizes, spans, kept = [], [], []
            for text, firsts, counts in zip(b.column(2), b.column(3).to_pylist(), b.column(4).to_pylist()):
                data = text.as_py().encode("utf-8")
                sizes.append(len(data))
                own: list[dict] = []
                for first, count in sorted(zip(firsts or (), counts or ())):
                    stop = first + count + length - 1
                    if own and first <= own[-1]["stop"]:
                        own[-1]["stop"] = max(own[-1]["stop"], stop)
                    else:
                        own.append({"start": first, "stop": stop})
                spans.append(own)
                edges = [0, *(x for s in own for x in (s["start"], s["stop"])), len(data)]
                kept.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["row_id", "id", "n_bytes", "spans", "kept"])
    return run


def cut_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                keep_first: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed bytes, start and stop), kept (the rest, as bytes), row_id.

    Every byte of a repeated string goes; with ``keep_first``, strings stay where they come first (in row order).
    """
    d = docs.select(row_ids(docs).alias("row_id"), F.col(id_col).cast("long").alias("id"),
                    text_of(text_col).alias("text"))
    cells = saved(repeated_cells(saved(scan(d, length), "cells")), "repeated")
    whole = cells.where(~F.col("lead")) if keep_first else cells.where("n > 1")
    runs = whole.select("row_id", "first", F.col("count").cast("int").alias("count")).union(
        _mixed_runs(cells.where("mixed AND lead"), d.select("row_id", "text"), length, keep_first))
    found = runs.groupBy("row_id").agg(F.collect_list("first").alias("f"), F.collect_list("count").alias("c"))
    return d.join(found, "row_id", "left").select("row_id", "id", "text", "f", "c").mapInArrow(
        _cut(length), f"row_id long, id long, n_bytes long, spans {SPANS}, kept binary").withColumnRenamed("id", "doc_id")
