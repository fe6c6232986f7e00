"""Substring dedup by collinear chaining: passages that documents share, also with small changes.

Seeds are word ``SEED``-grams sampled by minimizers (the smallest hash of every
``WINDOW`` consecutive grams), so any shared run of ``SEED + WINDOW - 1`` (23)
words shares a seed. Each gram's first occurrence in the corpus is its
reference; every other occurrence is a match (place, reference place). Matches
of a document are thus as many as its own seeds, however often a passage
recurs, and no group of copies is paired with itself: all documents that share
a passage are linked to the document that has it first.

Pairs of minimizers ``LONG`` to ``LONG + 2 * WINDOW`` words apart are seeds too,
whatever stands between them. A pair spans more than a piece of under
``MIN_WORDS`` words, so the pieces that earlier documents quote do not hide a
passage of which every exact run is short, and a changed word between the two
does not part it.

Earlier documents may each quote a piece of a passage, and be the first to have
the piece's grams. Longer grams are therefore seeds as well: of ``LONG`` (40)
words, and of twice as many again and again. Their first occurrence has that
many words of the passage, so every shared run of 51 words or more is linked
to a document that shares 40 exact words with it, one of 119 words or more to
one that shares 80, one of 239 words to one that shares 160, and so on. A passage may so have several references.

Matches of a document with one reference are chained in order on both sides:
a Fenwick tree over reference places holds the best chain so far, with gap
costs that are linear on both sides. Chains are aligned word by word: seeds
and the words around them by equality, gaps by edit distance, and both ends
beyond the words around them by least edits, as far as the score of the ends
(a word each, less ``EDIT_COST`` an edit) grows. Ends lengthen a passage only
if it reaches the similarity with them. A passage of 51 words or more with one
changed word is thus found wherever the word stands; words before an edit that
is less than ``EDIT_COST`` words from an end may be left out. A passage is
reported when it has ``min_words`` on both sides, and the share of aligned
words and the similarity of 5-word shingles are both ``similarity`` or more; a
chain that falls short is parted at its widest gap and its parts are tried.

Seeds, matches and runs go from step to step as columns packed for each bucket
of hashes, or of documents. A gram's first occurrence is a minimum, combined for
each packed row before it is sent; seeds then pass their bucket's first
occurrences one packed row after the other, so that a frequent gram is not held.
Reference passages are fetched once for each range, not for each match.

A reference may not reach the similarity where another document would: earlier documents quote pieces that are too
short, or have more words changed. Places whose seeds led to no passage with their reference are therefore matched
again, with every other document that has a seed's reference at the same place. Two such documents are a match if they
share a run of ``RUN`` (23) words there, which every passage of ``min_words`` at a ``similarity`` of 0.8 has. Places
with equal words around them are one class: classes are paired by their first document, and the other documents of a class are
matched with it. A run in more than ``HOT_RUN`` places says little: of these, all that share ``MIN_WORDS`` words are matched
with their first, and all that have ``BESIDE`` more words in common, on the other side of up to ``SKIP`` changed ones, with
theirs. So documents that share ``MIN_WORDS`` equal words are linked, directly or over the documents that their passages are
linked to. A changed passage may still be missed if no run of it is in ``HOT_RUN`` places or fewer and the first of
those places is not near enough.

Equal texts also share one seed of the whole text, so that copies are found
whatever they consist of. Where a text repeats a short cycle of words, the
matches of a gram overlap; a few of them, spaced over the cycle, are enough.
Repeats inside a document are matched with the gram's occurrence before.

Words are compared by 32-bit hashes in the alignment (seeds by 64 bits): two
different words count as equal once in 2^32. An end takes at most ``EDITS``
edits and ``MARGIN`` words; what lies beyond is reached by the chain's own seeds.

Cases: null or empty text and texts under ``SEED`` words have no seeds, and so no
rows. Repeated rows are copies of each other and report a passage of all
their words. A passage repeated inside one document is reported, with the document
as its own reference, unless ``inside`` is false. Only the id (cast to a long) and text columns are read. An empty
table gives an empty result. Rows are told apart by their position, so the
input must be a stored table or another repeatable frame.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import dropped, row_ids, saved, text_of

#: Words of a shingle, of a seed; grams of a minimizer's window; words of a window, all of which share a seed.
K = 5
SEED = 8
WINDOW = 16
RUN = SEED + WINDOW - 1
#: Words of a reference that are looked at together when its seeds led to no passage.
TILE = 32
#: Runs of more places than this are matched by what is beside them: a passage has MIN_WORDS equal words, or a run of RUN words
#: and BESIDE words on the other side of up to SKIP changed ones, as its runs of under MIN_WORDS words have 48 words in all.
HOT_RUN = 16
BESIDE, SKIP = 9, 4
MIN_WORDS = 40
#: Words of the shortest long seed; a window of 3 starts in 10 words, so runs of 51 words share one.
LONG = 40
#: Grams of a window for pairs.
PAIR_WINDOW = 24
SIMILARITY = 0.8
#: A seed's worth in words, and the cost of a word of gap on either side; chains part at about 80 words.
SEED_WORTH, GAP_COST = 8.0, 0.05
#: Words around a chain that alignment may extend it by: from one seed of a passage of 65 words to both its ends.
MARGIN = 64
#: Words of texts whose seeds are found together, and rows that are packed together, about.
JOINED_WORDS, PACKED = 60_000, 500_000
#: Ranges of a document that are fetched together, about.
RANGES = 500
#: Edits in one end of a passage, at most; and the cost of each, in words.
EDITS, EDIT_COST = 8, 3


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8").lower().split()  # bytes: only ASCII case and white space
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _grams(words: np.ndarray) -> np.ndarray:
    """Hashes of a text's grams of ``SEED`` words."""
    n = max(len(words) - SEED + 1, 0)
    grams = np.zeros(n, np.uint64)
    for i in range(SEED):
        grams = (grams ^ words[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    return grams


def _sliding(values: np.ndarray, window: int, best: np.ufunc) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``window`` values: spans double, and two spans cover a window."""
    width = 1
    while 2 * width <= window:
        values, width = best(values[:-width], values[width:]), 2 * width
    return best(values[:len(values) - (window - width)], values[window - width:])


def _minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest of every ``window`` grams: a gram is one if some window's least is as great as it."""
    if len(grams) <= window:
        return np.array([int(grams.argmin())]) if len(grams) else np.zeros(0, np.int64)
    none = np.zeros(window - 1, np.uint64)
    least = np.concatenate([none, _sliding(grams, window, np.minimum), none])
    return np.flatnonzero(_sliding(least, window, np.maximum) == grams)


def _mixed(a: np.ndarray, b: np.ndarray, skip: int, factor: int, shift: int) -> np.ndarray:
    """Hashes of each of ``a`` with the one of ``b`` that is ``skip`` places on; zero where there is none."""
    out = np.zeros(len(a), np.uint64)
    n = max(len(a) - skip, 0)
    mixed = (a[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ b[skip:]
    mixed *= np.uint64(factor)
    out[:n] = mixed ^ (mixed >> np.uint64(shift))
    return out


class _Joined:
    """Texts' words end to end, and the grams that begin at each word; a gram that its text is too short for is not used."""

    def __init__(self, words: list[np.ndarray]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.text = np.arange(len(words))
        self._lay()
        joined = np.concatenate(words)
        self.grams = np.zeros(len(joined), np.uint64)
        n = max(len(joined) - SEED + 1, 0)
        self.grams[:n] = _grams(joined)

    def _lay(self) -> None:
        self.start = np.concatenate([[0], self.size.cumsum()])[:-1]
        self.of = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(self.of)) - self.start[self.of]
        self.left = self.size[self.of] - self.place

    def keep(self, size: int) -> None:
        """Only texts of ``size`` words or more, once they have less than half of all words."""
        long = self.size >= size
        if 2 * self.size[long].sum() < len(self.of):
            self.grams = self.grams[long[self.of]]
            self.size, self.text = self.size[long], self.text[long]
            self._lay()

    def minimizers(self, span: int, window: int) -> np.ndarray:
        """Places of all texts' :func:`_minimizers` of grams of ``span`` words."""
        inner = np.zeros(0, np.int64)
        if len(self.grams) > window:
            least = _sliding(self.grams, window, np.minimum)
            least[self.left[:len(least)] < span + window - 1] = 0  # a window of two texts
            none = np.zeros(window - 1, np.uint64)
            most = _sliding(np.concatenate([none, least, none]), window, np.maximum)
            inner = np.flatnonzero((most == self.grams) & (self.left >= span) & (self.size[self.of] >= span + window))
        few = np.flatnonzero((self.size >= span) & (self.size < span + window))  # texts of one window or less
        first = [a + int(self.grams[a:a + n].argmin()) for a, n in zip(self.start[few].tolist(), (self.size[few] - span + 1).tolist())]
        return np.sort(np.concatenate([inner, np.array(first, np.int64)])) if first else inner


def _all_seeds(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, gram, words of the gram) of all seeds of several texts: minimizers; pairs of minimizers of
    ``PAIR_WINDOW`` grams, each with the next that starts ``LONG`` words or more after it, if that is within ``LONG +
    PAIR_WINDOW`` (the words between do not count); minimizers among grams of LONG, 2 LONG, 4 LONG... words; whole texts."""
    j, found = _Joined(words), []

    def add(at: np.ndarray, grams: np.ndarray, span: int) -> None:
        found.append((j.text[j.of[at]], j.place[at], grams, np.full(len(at), span)))
    at = j.minimizers(SEED, WINDOW)
    add(at, j.grams[at], SEED)
    at = j.minimizers(SEED, PAIR_WINDOW)
    to = np.searchsorted(at, at + LONG)
    there = to < len(at)
    there[there] = (at[to[there]] - at[there] <= LONG + PAIR_WINDOW) & (j.of[at[to[there]]] == j.of[at[there]])
    pair = (j.grams[at[there]] * np.uint64(0x9E3779B97F4A7C15)) ^ j.grams[at[to[there]]]
    pair *= np.uint64(0xD6E8FEB86659FD93)
    add(at[there], pair ^ (pair >> np.uint64(32)), SEED)
    first, size = j.grams, SEED
    while size < LONG:
        j.grams, size = _mixed(j.grams, first, size, 0xC2B2AE3D27D4EB4F, 31), size + SEED
    while len(j.size) and j.size.max() >= size:
        at = j.minimizers(size, size * 3 // 10 if size == LONG else size // 2)
        add(at, j.grams[at], size)
        j.grams, size = _mixed(j.grams, j.grams, size, 0xC2B2AE3D27D4EB4F, 31), size * 2
        j.keep(size)
    # One more seed, of the whole text; its place tells the length.
    whole = [(i, -len(w), xxhash.xxh64_intdigest(w.tobytes(), 1), len(w)) for i, w in enumerate(words) if len(w) >= SEED]
    found.append(tuple(np.array(c, np.uint64 if k == 2 else np.int64) for k, c in enumerate(zip(*whole or [()] * 4))) if whole
                 else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found))


def _bucketed(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket: its number and, packed into a binary cell, its values of each column. Rows come by bucket."""
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    cells = [pa.array(bucket[start].astype(np.int32))]
    for values in columns.values():
        values = np.ascontiguousarray(values)
        ends = (np.append(start, len(values)) * values.itemsize).astype(np.int32)
        cells.append(pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(values)]))
    return pa.RecordBatch.from_arrays(cells, names=["bucket", *columns])


def _values(cell: pa.BinaryScalar, kind: str) -> np.ndarray:
    return np.frombuffer(cell.as_buffer() or b"", kind)


def _by_gram(grams: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each gram: as many equal ranges of the unsigned hash."""
    return ((grams.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _dealt(buckets: int, key: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Values packed by the hash of a number that goes with them."""
    bucket = _by_gram(key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), buckets)
    order = np.argsort(bucket, kind="stable")
    return _bucketed(bucket[order], {name: c[order] for name, c in columns.items()})


SEEDS = "bucket int, row_id binary, place binary, gram binary, span binary"


def _seeds(buckets: int):
    """Seeds packed by ranges of their grams: of each batch and range a row, ordered by gram, row and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(found):
            row, place, gram, span = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(gram, kind="stable")  # seeds of a kind come by row and place
            gram = gram[order]
            return _bucketed(_by_gram(gram, buckets), {"row_id": row[order], "place": place[order].astype(np.int32),
                                                       "gram": gram, "span": span[order].astype(np.int32)})
        for b in batches:
            rows, words, held, found, seeds = [], [], 0, [], 0
            for i, (row, cell) in enumerate(zip(b.column(0).to_pylist(), b.column(1))):
                rows.append(row)
                words.append(word_hashes(cell.as_py()))
                held += len(words[-1])
                if held > JOINED_WORDS or i + 1 == b.num_rows:
                    text, *rest = _all_seeds(words)
                    found.append((np.array(rows, np.int64)[text], *rest))
                    seeds += len(text)
                    rows, words, held = [], [], 0
                if seeds > PACKED or i + 1 == b.num_rows:
                    yield packed(found)
                    found, seeds = [], 0
    return run


HEADS = "bucket int, gram binary, ref binary, ref_place binary, n binary"


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys begins, of rows ordered by them."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _least(at: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row, and its first place, of each group of rows that begins at ``at``."""
    first = np.minimum.reduceat(row, at)
    own = row == np.repeat(first, np.diff(np.append(at, len(row))))
    return first, np.minimum.reduceat(np.where(own, place, np.iinfo(np.int32).max), at).astype(np.int32)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each packed row, every gram once: its first row and place there, and how often it occurs."""
    for b in batches:
        for bucket, *cells in zip(b.column(0).to_pylist(), *b.columns[1:]):
            row, place, gram = (_values(c, k) for c, k in zip(cells, ("<i8", "<i4", "<u8")))
            at = _starts(gram)
            yield _bucketed(np.full(len(at), bucket), {"gram": gram[at], "ref": row[at], "ref_place": place[at],
                                                       "n": np.diff(np.append(at, len(gram)))})


def _buckets(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows come by bucket: the values of each bucket."""
    last, held = None, []
    for b in batches:
        for bucket, *cells in zip(b.column(0).to_pylist(), *b.columns[1:]):
            if bucket != last and held:
                yield last, [np.concatenate(c) for c in zip(*held)]
                held = []
            last = bucket
            held.append([_values(c, k) for c, k in zip(cells, kinds)])
    if held:
        yield last, [np.concatenate(c) for c in zip(*held)]


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every gram that occurs twice or more the first row, and its first place there."""
    for bucket, (gram, ref, ref_place, n) in _buckets(batches, ("<u8", "<i8", "<i4", "<i8")):
        order = np.argsort(gram, kind="stable")
        gram = gram[order]
        at = _starts(gram)
        if len(at):
            often = np.add.reduceat(n[order], at) > 1
            first, place = _least(at, ref[order], ref_place[order])
            yield _bucketed(np.full(often.sum(), bucket), {"gram": gram[at[often]], "ref": first[often], "ref_place": place[often]})


MATCHES = "bucket int, row_id binary, ref binary, place binary, ref_place binary, span binary"


def _packed_matches(buckets: int, row, ref, place, ref_place, span) -> pa.RecordBatch:
    """Matches packed by their row."""
    return _dealt(buckets, row, {"row_id": row, "ref": ref, "place": place, "ref_place": ref_place, "span": span})


def _matched(buckets: int, inside: bool, same: int = 0):
    """Rows come by bucket, the bucket's heads before its seeds: every seed but its gram's first, with that. The span is a
    column, or the ``same`` for all."""
    kinds = ("<u8", "<i8", "<i4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, heads, held, waiting = None, None, 0, []
        for b in batches:
            for bucket, head, *cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *b.columns[2:]):
                if head:
                    last, heads = bucket, [_values(c, k) for c, k in zip(cells, kinds)]
                    continue
                if bucket != last or not len(heads[0]):
                    continue
                gram, row, place = (_values(c, k) for c, k in zip(cells, kinds))
                span = np.full(len(gram), same, np.int32) if same else _values(cells[3], "<i4")
                known, ref, ref_place = heads
                at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                other = (row != ref[at]) | (place != ref_place[at]) if inside else row != ref[at]
                hit = (known[at] == gram) & other
                at = at[hit]
                waiting.append((row[hit], ref[at], place[hit], ref_place[at], span[hit]))
                held += len(at)
                if held > PACKED:
                    yield _packed_matches(buckets, *(np.concatenate(c) for c in zip(*waiting)))
                    held, waiting = 0, []
        if held:
            yield _packed_matches(buckets, *(np.concatenate(c) for c in zip(*waiting)))
    return run


def _pack(buckets: int):
    """Matches as rows to packed ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _packed_matches(buckets, *(c.to_numpy(zero_copy_only=False) for c in b.columns))
    return run


def _bucket_count(df: DataFrame) -> int:
    """Buckets for packed rows: a few for each shuffle partition."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def matches(found: DataFrame, inside: bool = False) -> DataFrame:
    """found: packed seeds. Every occurrence but a gram's first, packed by row: row_id, ref, place, ref_place, span."""
    # A frequent gram is sent once for each packed row to find its first place; its occurrences then pass the bucket's heads one packed
    # row after the other.
    once = found.mapInArrow(_once, HEADS).repartition("bucket").sortWithinPartitions("bucket")
    heads = saved(once.mapInArrow(_heads, "bucket int, gram binary, ref binary, ref_place binary"), "heads", free_shuffles=True)
    return _headed(heads, found.select("bucket", "gram", "row_id", "place", "span")).mapInArrow(_matched(_bucket_count(found), inside), MATCHES)


class _Best:
    """Fenwick tree of prefix maxima."""

    def __init__(self, n: int):
        self.value, self.who = [-1e18] * (n + 1), [-1] * (n + 1)

    def put(self, i: int, value: float, who: int) -> None:
        i += 1
        while i < len(self.value):
            if value > self.value[i]:
                self.value[i], self.who[i] = value, who
            i += i & -i

    def get(self, i: int) -> tuple[float, int]:
        """The best of places below i."""
        value, who = -1e18, -1
        while i > 0:
            if self.value[i] > value:
                value, who = self.value[i], self.who[i]
            i -= i & -i
        return value, who


def chains(x: np.ndarray, y: np.ndarray, ordered: bool = False) -> list[list[tuple[int, int, int]]]:
    """Chains of matches (x, y): anchors (x, y, span) in order on both sides, best first."""
    if not ordered:
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
    # Neighbouring matches on one diagonal are one anchor.
    edge = np.ones(len(x), bool)
    edge[1:] = (x[1:] - x[:-1] != y[1:] - y[:-1]) | (x[1:] - x[:-1] > 2 * WINDOW)
    edge = np.flatnonzero(edge)
    last = np.append(edge[1:], len(x)) - 1
    if len(edge) == 1:
        return [[(int(x[0]), int(y[0]), int(x[-1] - x[0]) + SEED)]]
    ax, ay, bx, by = x[edge].tolist(), y[edge].tolist(), x[last].tolist(), y[last].tolist()
    worth = ((last - edge + 1) * SEED_WORTH).tolist()
    places = np.unique(np.concatenate([y[edge], y[last]]))
    start, end = np.searchsorted(places, y[edge]).tolist(), np.searchsorted(places, y[last]).tolist()
    tree, score, back = _Best(len(places)), [0.0] * len(edge), [-1] * len(edge)
    waiting = sorted(range(len(edge)), key=lambda i: bx[i])  # anchors enter the tree once their end is passed
    w = 0
    for i in range(len(edge)):
        while w < len(waiting) and bx[waiting[w]] < ax[i]:
            j = waiting[w]
            tree.put(end[j], score[j] + GAP_COST * (bx[j] + by[j]), j)
            w += 1
        value, j = tree.get(start[i])
        value -= GAP_COST * (ax[i] + ay[i])
        score[i], back[i] = (worth[i] + value, j) if value > 0 else (worth[i], -1)
    used, out = [False] * len(edge), []
    for i in sorted(range(len(edge)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append((ax[i], ay[i], bx[i] - ax[i] + SEED))
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


CHAIN = ("row_id long, ref long, a int, z int, ref_a int, ref_z int, "
         "anchors array<struct<x: int, y: int, n: int>>")
_ANCHORS = pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32()), ("n", pa.int32())]))


def _by_place(x: np.ndarray, y: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches by reference place, span and place, each once (a minimizer and its pair may give the same)."""
    order = np.lexsort((x, spans, y))
    x, y, spans = x[order], y[order], spans[order]
    new = np.concatenate([[True], (np.diff(x) != 0) | (np.diff(y) != 0) | (np.diff(spans) != 0)])
    return x[new], y[new], spans[new]


def _inside(x: np.ndarray, y: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches of a document with itself point at the gram's occurrence before, so that a cycle is one diagonal."""
    x, y, spans = _by_place(x, y, spans)
    again = np.flatnonzero((np.diff(y) == 0) & (np.diff(spans) == 0)) + 1
    y[again] = x[again - 1]
    return x, y, spans


def _without_cycles(x: np.ndarray, y: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a gram's occurrences that overlap (a short cycle of words), the first and last of each run, and one in as many
    words as the gram or a passage has: between them they reach all of the cycle."""
    x, y, spans = _by_place(x, y, spans)
    over = np.concatenate([[False], (np.diff(y) == 0) & (np.diff(spans) == 0) & (np.diff(x) < spans[1:])])
    if over.any():
        first = np.maximum.accumulate(np.where(over, 0, np.arange(len(x))))
        tile = (x - x[first]) // np.maximum(spans, MIN_WORDS)
        keep = ~over | np.concatenate([[True], np.diff(tile) != 0]) | np.concatenate([~over[1:], [True]])
        x, y, spans = x[keep], y[keep], spans[keep]
    return x, y, spans


def _chains(min_words: int):
    def prepared(row, ref, x, y, spans):
        """Matches of all documents of a bucket: groups' (row, ref), where each begins, and places in order, each once; and the
        words of equal whole texts, whose seeds say all."""
        order = np.lexsort((x, spans, y, ref, row))
        row, ref, x, y, spans = (c[order] for c in (row, ref, x, y, spans))
        at = _starts(row, ref, y, spans, x)
        row, ref, x, y, spans = (c[at] for c in (row, ref, x.astype(np.int64), y.astype(np.int64), spans.astype(np.int64)))
        at = _starts(row, ref)
        of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(row))))
        rows, refs = row[at], ref[at]
        whole = np.minimum.reduceat(x, at)
        again = np.concatenate([[False], (of[1:] == of[:-1]) & (y[1:] == y[:-1]) & (spans[1:] == spans[:-1]) & (
            (np.diff(x) < spans[1:]) | (row == ref)[1:])])
        odd = (np.logical_or.reduceat(again, at)) & (whole >= 0)
        plain = ~odd[of] & (whole >= 0)[of]
        parts = [(of[plain], x[plain], y[plain], spans[plain])]
        for g, s, e in zip(np.flatnonzero(odd).tolist(), at[odd].tolist(), np.append(at, len(row))[1:][odd].tolist()):
            part = (_inside if rows[g] == refs[g] else _without_cycles)(x[s:e], y[s:e], spans[s:e])
            parts.append((np.full(len(part[0]), g), *part))
        of, x, y, spans = (np.concatenate(c) for c in zip(*parts))
        more = spans - SEED  # a long seed is a match at both its ends
        far = more > 0
        of, x, y = np.append(of, of[far]), np.append(x, (x + more)[far]), np.append(y, (y + more)[far])
        order = np.lexsort((y, x, of))
        of, x, y = of[order], x[order], y[order]
        at = _starts(of, x, y)
        return rows, refs, whole, of[at], x[at], y[at]

    def batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), _ANCHORS)
        columns = list(zip(*rows)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          names=["row_id", "ref", "a", "z", "ref_a", "ref_z", "anchors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packed matches come by bucket."""
        out = []
        for _, packed in _buckets(batches, ("<i8", "<i8", "<i4", "<i4", "<i4")):
            if not len(packed[0]):
                continue
            rows, refs, whole, of, x, y = prepared(*packed)
            for g in np.flatnonzero(whole < 0).tolist():
                n = -int(whole[g])
                if n >= min_words:
                    out.append((int(rows[g]), int(refs[g]), 0, n, 0, n, [{"x": 0, "y": 0, "n": n}]))
            cut = _starts(of).tolist()
            for s, e in zip(cut, [*cut[1:], len(of)]):
                key = int(rows[of[s]]), int(refs[of[s]])
                for c in chains(x[s:e], y[s:e], True):
                    a, z, ra, rz = c[0][0], c[-1][0] + c[-1][2], c[0][1], c[-1][1] + c[-1][2]
                    if min(z - a, rz - ra) + 2 * MARGIN >= min_words:
                        out.append((*key, a, z, ra, rz, [{"x": p, "y": q, "n": n} for p, q, n in c]))
                if len(out) > 5_000:
                    yield batch(out)
                    out = []
        yield batch(out)
    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_id, text, ranges) to 32-bit word hashes of every range, with a margin where the text has one."""
    for b in batches:
        out = []
        for row, text, ranges in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            words = (word_hashes(text.as_py()) & np.uint64(0xFFFFFFFF)).astype("<u4")
            for r in ranges:
                first = max(0, r["a"] - MARGIN)
                out.append((row, r["a"], r["z"], first, words[first:r["z"] + MARGIN].tobytes()))
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
            names=["row_id", "a", "z", "first", "words"])


def _gap(a: list[int], b: list[int]) -> int:
    """Words kept in a least-edits alignment of two gaps."""
    n = min(len(a), len(b))
    head = tail = 0  # equal words at both ends belong to some best alignment
    while head < n and a[head] == b[head]:
        head += 1
    while tail < n - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if not a or not b:
        return head + tail
    places: dict[int, int] = {}
    for i, w in enumerate(b):
        places[w] = places.get(w, 0) | 1 << i
    every = row = (1 << len(b)) - 1  # longest common subsequence: a bit that is off for each step of its row
    for w in a:
        hit = row & places.get(w, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & every
    return head + len(b) - row.bit_count() + tail


def _shingles(words: np.ndarray) -> np.ndarray:
    """A hash for each place where a shingle of ``K`` words begins."""
    return _hash_runs(words.astype(np.uint64), K)


def _alike(own: np.ndarray, ref: np.ndarray) -> float:
    p, q = set(own.tolist()), set(ref.tolist())
    both = len(p & q)
    return both / max(1, len(p) + len(q) - both)


def _most_kept(a: list[int], b: list[int]) -> list[int]:
    """For each number of edits, words of ``a`` that a common beginning may keep at most: a word is kept on a diagonal
    within reach, and each that has no equal there costs an edit."""
    kept, most = 0, []
    for i, w in enumerate(a):
        if w in b[max(0, i - EDITS):i + EDITS + 1]:
            kept += 1
        else:
            most.append(kept)
            if len(most) > EDITS:
                return most
    return most + [kept] * (EDITS + 1 - len(most))


def _end(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """The best common beginning of two word lists: words of a, words of b, words kept. For each number of edits, the
    furthest place on every diagonal; a place is worth the mean of both lengths, less the edits' cost."""
    top, best = 0.0, (0, 0, 0)
    most_a, most_b = len(a), len(b)
    # An edit takes 2 words' worth or more: what ends with so many edits, or more, are worth at most.
    cost = [(EDIT_COST - 1) * e for e in range(EDITS + 1)]
    most = _most_kept(a, b)
    if all(m <= c for m, c in zip(most, cost)):
        return best
    limit = [min(m, n) - c for m, n, c in zip(most, _most_kept(b, a), cost)]
    for e in range(EDITS - 1, -1, -1):
        limit[e] = max(limit[e], limit[e + 1])
    reach = {0: (0, 0)}  # diagonal (place in b less place in a): place in a, words kept
    for edits in range(min(EDITS, max(most_a, most_b)) + 1):
        if limit[edits] <= top:
            break
        if edits:
            step: dict[int, tuple[int, int]] = {}
            get = step.get
            for k, (i, kept) in reach.items():
                for to, x in ((k, i + 1), (k + 1, i), (k - 1, i + 1)):  # changed, added, left out
                    if x <= most_a and x + to <= most_b:
                        old = get(to)
                        if old is None or (x, kept) > old:
                            step[to] = (x, kept)
            reach = step
        for k, (i, kept) in reach.items():
            x, stop = i, min(most_a, most_b - k)
            while x < stop and a[x] == b[x + k]:
                x += 1
            if x > i:
                reach[k] = (x, kept + x - i)
            worth = x + k / 2 - EDIT_COST * edits
            if worth > top:
                top, best = worth, (x, x + k, kept + x - i)
    return best


def align(own: np.ndarray, ref: np.ndarray, anchors: list[tuple[int, int, int]],
          min_words: int = 0) -> tuple[int, int, int, int, float, float] | None:
    """Aligns two word slices along a chain: (a, z, ref_a, ref_z, identity, shingle similarity) within the slices; None
    if it spans under ``min_words`` on a side."""
    found = _core(own.tolist(), ref.tolist(), anchors)
    if min(found[1] - found[0], found[3] - found[2]) < min_words:
        return None
    return _measured(_shingles(own), _shingles(ref), *found)


def _measured(own: np.ndarray, ref: np.ndarray, a: int, z: int, ra: int, rz: int, same: int):
    """own, ref: shingles of the slices. Equal runs are alike without a look."""
    if same == z - a == rz - ra:
        return a, z, ra, rz, 1.0, 1.0
    return a, z, ra, rz, same / max(z - a, rz - ra, 1), _alike(own[a:max(a, z - K + 1)], ref[ra:max(ra, rz - K + 1)])


def _core(own: list[int], ref: list[int], anchors: list[tuple[int, int, int]]) -> tuple[int, int, int, int, int]:
    """A chain and the equal words around it: (a, z, ref_a, ref_z, words kept)."""
    x, y, _ = anchors[0]
    while x and y and own[x - 1] == ref[y - 1]:
        x, y = x - 1, y - 1
    a, ra, same = x, y, anchors[0][0] - x
    x, y, _ = anchors[0]
    for p, q, n in anchors:
        skip = max(x - p, y - q, 0)  # anchors may overlap by a few words
        p, q, n = p + skip, q + skip, n - skip
        if n <= 0:
            continue
        left, right = own[p:p + n], ref[q:q + n]
        same += _gap(own[x:p], ref[y:q]) + (n if left == right else sum(map(eq, left, right)))
        x, y = p + n, q + n
    while x < len(own) and y < len(ref) and own[x] == ref[y]:
        x, y, same = x + 1, y + 1, same + 1
    return a, x, ra, y, same


def passages(own: list[int], ref: list[int], anchors: list[tuple[int, int, int]], min_words: int, similarity: float,
             shingles: tuple[np.ndarray, np.ndarray]):
    """Alignments of a chain that reach the similarity, with both ends, one end or none; one that does not is parted at
    its widest gap, in the end into exact runs."""
    todo = [(anchors, (0, 0), (len(own), len(ref)))]  # and the places that its ends may reach
    while todo:
        part, low, high = todo.pop()
        a, z, ra, rz, same = _core(own, ref, part)
        head = _end(own[max(low[0], a - MARGIN):a][::-1], ref[max(low[1], ra - MARGIN):ra][::-1])
        tail = _end(own[z:min(high[0], z + MARGIN)], ref[rz:min(high[1], rz + MARGIN)])
        if min(z - a + head[0] + tail[0], rz - ra + head[1] + tail[1]) < min_words:
            continue
        none = (0, 0, 0)
        tries = dict.fromkeys([(head, tail), *sorted([(head, none), (none, tail)], key=lambda e: -e[0][2] - e[1][2]), (none, none)])
        for (i, j, m), (k, l, n) in tries:
            if min(z + k - a + i, rz + l - ra + j) < min_words or same + m + n < similarity * max(z + k - a + i, rz + l - ra + j):
                continue
            found = _measured(*shingles, a - i, z + k, ra - j, rz + l, same + m + n)
            if found[5] >= similarity:
                yield found
                break
        else:
            if len(part) > 1:
                gap = [q[0] - p[0] - p[2] + q[1] - p[1] - p[2] for p, q in zip(part, part[1:])]
                cut = gap.index(max(gap)) + 1
                (p, q, n), (x, y, _) = part[cut - 1], part[cut]
                todo += [(part[cut:], (p + n, q + n), high), (part[:cut], low, (x, y))]
            else:
                n = min(z - a, rz - ra)
                if n < min_words:
                    continue
                same = np.concatenate([[0], np.equal(own[a:a + n], ref[ra:ra + n]), [0]]).astype(np.int8)
                edge = np.flatnonzero(np.diff(same))
                for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    if e - s >= min_words:
                        yield a + s, a + e, ra + s, ra + e, 1.0, 1.0


ALIGNED = ("row_id long, ref long, a int, z int, ref_a int, ref_z int, identity double, alike double, "
           "chain_a int, chain_z int")


def _texts(cells: pa.Array) -> tuple[np.ndarray, list[int]]:
    """The 32-bit words of all cells of a binary column, and where each cell begins and the last one ends."""
    lengths = np.array([len(c.as_buffer()) for c in cells], np.int64) // 4
    words = np.frombuffer(b"".join(c.as_buffer() for c in cells), "<u4")
    return words, np.concatenate([[0], lengths.cumsum()]).tolist()


def _align(min_words: int, similarity: float):
    """Passages of every chain; and, without an identity, its anchors that are in none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            out = []
            (own, at), (other, ref_at) = (_texts(b.column(name)) for name in ("words", "ref_words"))
            own_shingles, ref_shingles = _shingles(own), _shingles(other)  # of all rows at once; those over an end are not used
            places = [b.column("anchors").flatten().field(k).to_pylist() for k in range(3)]
            stop = b.column("anchors").value_lengths().to_numpy().cumsum().tolist()
            for k, (row, ref, first, ref_first, ca, cz) in enumerate(zip(*(b.column(c).to_pylist() for c in (
                    "row_id", "ref", "first", "ref_first", "a", "z")))):
                s, e, i, j = at[k], at[k + 1], ref_at[k], ref_at[k + 1]
                part = slice(stop[k - 1] if k else 0, stop[k])
                chain = [(p - first, q - ref_first, m) for p, q, m in zip(*(v[part] for v in places))]
                found = list(passages(own[s:e].tolist(), other[i:j].tolist(), chain, min_words, similarity,
                                      (own_shingles[s:e], ref_shingles[i:j])))
                for a, z, ra, rz, identity, alike in found:
                    out.append((row, ref, a + first, z + first, ra + ref_first, rz + ref_first, identity, alike, ca, cz))
                for x, y, n in chain:
                    if not any(a <= x and x + n <= z for a, z, *_ in found):
                        out.append((row, ref, x + first, x + n + first, y + ref_first, y + n + ref_first, None, None, ca, cz))
            columns = list(zip(*out)) or [()] * 10
            kinds = (pa.int64(), pa.int64(), *(pa.int32(),) * 4, pa.float64(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["row_id", "ref", "a", "z", "ref_a", "ref_z", "identity", "alike", "chain_a", "chain_z"])
    return run


def _hash_runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words."""
    out = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for i in range(n):
        out = (out ^ words[i:i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


RUNS = "bucket int, run binary, row_id binary, place binary, loose binary, part binary"


def _runs(buckets: int):
    """(part, row_id, a, size, at, words, loose), by row_id: the runs of ``RUN`` words that a run of up to ``MIN_WORDS`` words
    may have, which shares ``SEED`` words with the ``size`` words from place ``at`` of a slice; that is place ``a`` of the row.
    Each place of a row once, packed by ranges of the run's hash and ordered by it."""
    more = MIN_WORDS - SEED

    def packed(found):
        run, row, place, loose, part = (np.concatenate(c) for c in zip(*found))
        if not len(run):
            return _bucketed(np.zeros(0, np.int32), {"run": run, "row_id": row, "place": place, "loose": loose, "part": part})
        of = np.zeros(len(row), np.int64)  # rows come one after the other; a place has the same run in all parts of its row
        of[1:] = (row[1:] != row[:-1]).cumsum()
        key = of << 32 | place
        order = np.argsort(key, kind="stable")
        at = _starts(key[order])
        loose, part = np.logical_or.reduceat(loose[order], at), np.minimum.reduceat(part[order], at)
        at = order[at]
        run, row, place = run[at], row[at], place[at]
        order = np.argsort(run, kind="stable")
        return _bucketed(_by_gram(run[order], buckets), {name: c[order] for name, c in (
            ("run", run), ("row_id", row), ("place", place), ("loose", loose), ("part", part))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, last = [], 0, None
        for b in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            words, start = _texts(b.column("words"))
            runs = _hash_runs(words.astype(np.uint64), RUN)  # of all slices at once; those over an end are not used
            columns = (b.column(c).to_pylist() for c in ("part", "row_id", "a", "size", "at", "loose"))
            for part, row, a, size, at, free, begin, end in zip(*columns, start, start[1:]):
                if held > PACKED and row != last:
                    yield packed(found)
                    found, held = [], 0
                low, last = max(0, at - more), row
                n = max(0, min(end, begin + at + size + more) - RUN + 1 - begin - low)
                found.append((runs[begin + low:begin + low + n], np.full(n, row), np.arange(n, dtype=np.int32) + np.int32(a - at + low), np.full(n, free, bool),
                              np.full(n, part)))
                held += n
        if found:
            yield packed(found)
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each packed row, every run once: how many places it has there, and if one is loose."""
    for b in batches:
        for bucket, *cells in zip(b.column("bucket").to_pylist(), b.column("run"), b.column("loose")):
            run, loose = (_values(c, k) for c, k in zip(cells, ("<u8", "?")))
            at = _starts(run)
            if len(at):
                yield _bucketed(np.full(len(at), bucket), {"run": run[at], "n": np.diff(np.append(at, len(run))),
                                                           "loose": np.logical_or.reduceat(loose, at)})


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of two places or more, one of them loose, and their number of places."""
    for bucket, (run, n, loose) in _buckets(batches, ("<u8", "<i8", "?")):
        order = np.argsort(run, kind="stable")
        run = run[order]
        at = _starts(run)
        if len(at):
            n = np.add.reduceat(n[order], at)
            keep = (n > 1) & np.logical_or.reduceat(loose[order], at)
            yield _bucketed(np.full(keep.sum(), bucket), {"run": run[at[keep]], "n": n[keep]})


MET = "kind int, bucket int, a binary, b binary, c binary, d binary, e binary"


def _met(buckets: int, inside: bool):
    """Rows come by bucket, the bucket's often runs before their places. Kind 0: matches of every two places of a run, one of them
    loose (a pair of two loose places is met once, from the later one), packed by row. Kind 1: part, place and loose of
    runs in more than ``HOT_RUN`` places, packed by part."""
    def cells(kind, batch):
        columns = batch.columns[1:]
        columns += [pa.nulls(batch.num_rows, pa.binary())] * (5 - len(columns))
        return pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, kind, np.int32)), batch.column(0), *columns],
                                          names=["kind", "bucket", *"abcde"])

    def hot(found):
        part, place, loose = (np.concatenate(c) for c in zip(*found))
        return cells(1, _dealt(buckets, part, {"part": part, "place": place, "loose": loose}))

    def pairs(found):
        run, row, place, loose = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((place, row, run))
        run, row, place, loose = (c[order] for c in (run, row, place, loose))
        of, out = np.repeat(at := _starts(run), np.diff(np.append(at, len(run)))), []
        for gap in range(1, HOT_RUN):  # place by row and place: the later of two stands further on
            x = np.flatnonzero(of[gap:] == of[:-gap]) + gap
            y = x - gap
            there = (loose[x] | loose[y]) & ((row[x] != row[y]) | inside)
            out.append((row[x[there]], row[y[there]], place[x[there]], place[y[there]]))
        own, ref, place, ref_place = (np.concatenate(c) for c in zip(*out))
        return cells(0, _packed_matches(buckets, own, ref, place, ref_place, np.full(len(own), RUN, np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, often, warm, held, many, sent = None, None, [], 0, [], 0
        for b in batches:
            for bucket, head, *packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *b.columns[2:]):
                if head:
                    if held > PACKED:  # a bucket's runs are whole
                        yield pairs(warm)
                        warm, held = [], 0
                    last, often = bucket, [_values(c, k) for c, k in zip(packed, ("<u8", "<i8"))]
                    continue
                if bucket != last or not len(often[0]):
                    continue
                run, row, place, loose, part = (_values(c, k) for c, k in zip(packed, ("<u8", "<i8", "<i4", "?", "<i8")))
                at = np.minimum(np.searchsorted(often[0], run), len(often[0]) - 1)
                known, n = often[0][at] == run, often[1][at]
                few, many_places = known & (n <= HOT_RUN), known & (n > HOT_RUN)
                warm.append((run[few], row[few], place[few], loose[few]))
                many.append((part[many_places], place[many_places], loose[many_places]))
                held, sent = held + int(few.sum()), sent + int(many_places.sum())
                if sent > PACKED:
                    yield hot(many)
                    many, sent = [], 0
        if held:
            yield pairs(warm)
        if sent:
            yield hot(many)
    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, places, loose) of frequent runs."""
    for _, (part, place, loose) in _buckets(batches, ("<i8", "<i4", "?")):
        order = np.lexsort((place, part))
        part = part[order]
        b = _bucketed(part, {"place": place[order], "loose": loose[order]})
        yield pa.RecordBatch.from_arrays([pa.array(part[_starts(part)]), b.column(1), b.column(2)], names=["part", "places", "free"])


KEYS = "bucket int, key binary, row_id binary, place binary, loose binary"


def _beside(buckets: int):
    """(row_id, shift, words, places, loose) of frequent runs: keys that documents with a passage share. A run of ``MIN_WORDS``
    words; or a run with ``BESIDE`` words next to it, on either side of up to ``SKIP`` words. Packed by key."""
    def packed(found):
        key, row, place, loose = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(key, kind="stable")
        key = key[order]
        return _bucketed(_by_gram(key, buckets), {"key": key, "row_id": row[order], "place": place[order], "loose": loose[order]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for b in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            own, begin = _texts(b.column("words"))
            own, begin = own.astype(np.uint64), np.array(begin)
            place, free = (np.frombuffer(b"".join(c.as_buffer() for c in b.column(n)), k) for n, k in (("places", "<i4"), ("free", "?")))
            of = np.repeat(np.arange(b.num_rows), [len(c.as_buffer()) for c in b.column("free")])
            row, shift = (b.column(n).to_numpy(zero_copy_only=False).astype(np.int64)[of] for n in ("row_id", "shift"))
            at, low, high = place - shift + begin[of], begin[of], begin[of + 1]

            def add(key, there):
                out.append((key, row[there], place[there], free[there]))
            runs, whole, near = _hash_runs(own, RUN), _hash_runs(own, MIN_WORDS), _hash_runs(own, BESIDE)
            there = at + MIN_WORDS <= high
            add(whole[at[there]], there)
            for skip in range(SKIP + 1):
                for side, start in ((1, at + RUN + skip), (2, at - skip - BESIDE)):
                    there = (start >= low) & (start + BESIDE <= high)
                    key = (runs[at[there]] * np.uint64(0xD6E8FEB86659FD93 + 2 * side)) ^ near[start[there]]
                    add(key * np.uint64(0x9E3779B97F4A7C15), there)
            held += 11 * len(at)
            if held > PACKED:
                yield packed(out)
                out, held = [], 0
        if out:
            yield packed(out)
    return run


FIRST = "bucket int, key binary, row_id binary, place binary"


def _first_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each packed row, every key once: its first place, how many it has there, and if one is loose."""
    for b in batches:
        for bucket, *cells in zip(b.column(0).to_pylist(), *b.columns[1:]):
            key, row, place, loose = (_values(c, k) for c, k in zip(cells, ("<u8", "<i8", "<i4", "?")))
            at = _starts(key)
            if len(at):
                row, place = _least(at, row, place)
                yield _bucketed(np.full(len(at), bucket), {"key": key[at], "row_id": row, "place": place, "n": np.diff(
                    np.append(at, len(key))), "loose": np.logical_or.reduceat(loose, at)})


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first place of keys of two places or more, one of them loose."""
    for bucket, (key, row, place, n, loose) in _buckets(batches, ("<u8", "<i8", "<i4", "<i8", "?")):
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = _starts(key)
        if len(at):
            keep = (np.add.reduceat(n[order], at) > 1) & np.logical_or.reduceat(loose[order], at)
            row, place = _least(at, row[order], place[order])
            yield _bucketed(np.full(keep.sum(), bucket), {"key": key[at[keep]], "row_id": row[keep], "place": place[keep]})


def _headed(heads: DataFrame, rows: DataFrame) -> DataFrame:
    """Packed rows by bucket, those of ``heads`` first. ``heads`` has the first columns of ``rows``, by type."""
    names = rows.columns[1:]
    head = [F.col(c).alias(n) for c, n in zip(heads.columns[1:], names)]
    head += [F.lit(None).cast("binary").alias(n) for n in names[len(head):]]
    both = heads.select("bucket", F.lit(True).alias("head"), *head).union(rows.select("bucket", F.lit(False).alias("head"), *names))
    return both.repartition("bucket").sortWithinPartitions("bucket", F.desc("head"))


def loose_matches(aligned: DataFrame, slices: DataFrame, inside: bool = False) -> DataFrame:
    """aligned: passages and loose anchors of chains. Matches of places whose anchors are in no passage with other places that
    have the same reference, as :func:`matches` gives them, saved. The slices are dropped."""
    last = F.greatest(F.col("ref_z") - 1, F.col("ref_a"))
    tile = F.explode(F.sequence((F.col("ref_a") / TILE).cast("int"), (last / TILE).cast("int"))).alias("tile")
    tiles = aligned.select("row_id", "a", "z", "chain_a", "chain_z", F.isnull("identity").alias("loose"), "ref", tile)
    live = tiles.groupBy("ref", "tile").agg(F.max("loose").alias("loose"), F.count(F.lit(1)).alias("n")).where("loose AND n > 1")
    live = saved(live.select("ref", "tile"), "tiles", free_shuffles=True)
    places = ["row_id", "a", "z", "chain_a", "chain_z"]
    there = tiles.join(live, ["ref", "tile"], "left_semi").groupBy(*places).agg(F.max("loose").alias("loose"))
    own = slices.toDF("row_id", "chain_a", "chain_z", "first", "words")
    # Equal slices are one class; their words are in equal places of it.
    of = ["slice", "at", "size"]
    there = saved(there.join(own, ["row_id", "chain_a", "chain_z"]).select(
        F.xxhash64("words").alias("slice"), (F.col("a") - F.col("first")).alias("at"), (F.col("z") - F.col("a")).alias("size"),
        "row_id", "a", "loose", "words"), "loose", free_shuffles=True)
    dropped(live, slices)
    classes = saved(there.groupBy(*of).agg(F.min(F.struct("row_id", "a")).alias("head"), F.max("loose").alias("loose"),
                                           F.first("words").alias("words")), "classes", free_shuffles=True)
    heads = classes.where("loose").select(*of, F.col("head.row_id").alias("ref"), F.col("head.a").alias("ref_place"))
    other = (F.col("row_id") != F.col("ref")) | (F.lit(inside) & (F.col("a") != F.col("ref_place")))
    members = there.drop("loose", "words").join(heads, of).where(other).select(
        "row_id", "ref", F.col("a").alias("place"), "ref_place", F.col("size").alias("span"))
    parts = classes.select(row_ids(classes).alias("part"), "head.row_id", "head.a", "size", "at", "words", "loose")
    buckets = _bucket_count(parts)
    runs = saved(parts.repartition("row_id").sortWithinPartitions("row_id").mapInArrow(_runs(buckets), RUNS), "runs", free_shuffles=True)
    often = runs.mapInArrow(_counted, "bucket int, run binary, n binary, loose binary").repartition("bucket").sortWithinPartitions("bucket")
    often = saved(often.mapInArrow(_often, "bucket int, run binary, n binary"), "often", free_shuffles=True)
    both = saved(_headed(often, runs).mapInArrow(_met(buckets, inside), MET), "met", free_shuffles=True)
    dropped(runs, often)
    # Of a frequent run, only places are matched that share more than the run.
    hot = both.where("kind = 1").select("bucket", "a", "b", "c").repartition("bucket").sortWithinPartitions("bucket")
    hot = hot.mapInArrow(_by_part, "part long, places binary, free binary")
    keys = saved(parts.select("part", "row_id", (F.col("a") - F.col("at")).alias("shift"), "words").join(hot, "part").select(
        "row_id", "shift", "words", "places", "free").mapInArrow(_beside(buckets), KEYS), "beside", free_shuffles=True)
    # Pairs would be the square of a template's documents: all are matched with the first.
    first = keys.mapInArrow(_first_here, "bucket int, key binary, row_id binary, place binary, n binary, loose binary")
    first = saved(first.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_first, FIRST), "first", free_shuffles=True)
    warm = _headed(first, keys.drop("loose")).mapInArrow(_matched(buckets, inside, RUN), MATCHES)
    met = both.where("kind = 0").select("bucket", *[F.col(c).alias(n) for c, n in zip("abcde", ("row_id", "ref", "place", "ref_place", "span"))])
    found = saved(members.mapInArrow(_pack(buckets), MATCHES).union(met).union(warm), "again", free_shuffles=True)
    dropped(there, classes, keys, first, both)
    return found


def _aligned(d: DataFrame, found: DataFrame, min_words: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Passages and loose anchors of the chains of matches, and the chains' words. d: (row_id, id, text)."""
    dealt = found.repartition("bucket").sortWithinPartitions("bucket")
    linked = saved(dealt.mapInArrow(_chains(min_words), CHAIN), "chains", free_shuffles=True)
    ranges = linked.select("row_id", "a", "z").union(
        linked.select("ref", "ref_a", "ref_z").distinct().toDF("row_id", "a", "z"))
    # A document that many quote has its ranges dealt over several rows, each of about RANGES.
    once = saved(ranges.distinct(), "ranges", free_shuffles=True)
    parts = once.groupBy("row_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(RANGES)).alias("_parts"))
    part = F.pmod(F.xxhash64("a", "z"), F.col("_parts")).alias("_part")
    wanted = once.join(parts, "row_id").groupBy("row_id", part).agg(F.collect_list(F.struct("a", "z")).alias("ranges"))
    slices = saved(d.select("row_id", "text").join(wanted, "row_id").select("row_id", "text", "ranges").mapInArrow(
        _slices, "row_id long, a int, z int, first int, words binary"), "slices", free_shuffles=True)
    refs = slices.toDF("ref", "ref_a", "ref_z", "ref_first", "ref_words")
    pairs = linked.join(slices, ["row_id", "a", "z"]).join(refs, ["ref", "ref_a", "ref_z"]).select(
        "row_id", "ref", "first", "words", "ref_first", "ref_words", "anchors", "a", "z")
    aligned = saved(pairs.mapInArrow(_align(min_words, similarity), ALIGNED), "aligned", free_shuffles=True)
    dropped(linked, once)
    return aligned, slices


def shared_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                    similarity: float = SIMILARITY, inside: bool = True) -> DataFrame:
    """One row per passage (``inside``: also those that one document repeats): doc_id, word_start, word_stop, ref_doc_id, ref_start, ref_stop, identity, similarity."""
    d = docs.select(row_ids(docs).alias("row_id"), F.col(id_col).cast("long").alias("id"),
                    text_of(text_col).alias("text"))
    found = saved(d.select("row_id", "text").mapInArrow(_seeds(_bucket_count(d)), SEEDS), "seeds", compression="zstd")
    aligned, slices = _aligned(d, matches(found, inside), min_words, similarity)
    dropped(found)
    kept = aligned.where("identity IS NOT NULL").drop("chain_a", "chain_z")
    again = loose_matches(aligned, slices, inside)
    if not again.isEmpty():
        more, slices = _aligned(d, again, min_words, similarity)
        dropped(slices)
        more = more.where("identity IS NOT NULL").drop("chain_a", "chain_z")
        known = kept.select("row_id", "ref", *[F.col(c).alias("_" + c) for c in ("a", "z", "ref_a", "ref_z")])
        within = (F.col("a") >= F.col("_a")) & (F.col("z") <= F.col("_z")) & (F.col("ref_a") >= F.col("_ref_a")) & (
            F.col("ref_z") <= F.col("_ref_z"))
        held = [more["row_id"] == known["row_id"], more["ref"] == known["ref"], within]
        kept = kept.union(more.join(known, held, "left_anti"))
    ids = d.select("row_id", "id")
    return (kept.join(ids.select("row_id", F.col("id").alias("doc_id")), "row_id")
            .join(ids.select(F.col("row_id").alias("ref"), F.col("id").alias("ref_doc_id")), "ref")
            .select("doc_id", F.col("a").alias("word_start"), F.col("z").alias("word_stop"), "ref_doc_id",
                    F.col("ref_a").alias("ref_start"), F.col("ref_z").alias("ref_stop"), "identity",
                    F.col("alike").alias("similarity")))
