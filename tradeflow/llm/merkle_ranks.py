"""A Merkle manifest of a dataset: leaves are placed by rank queries on bitmaps, not by a sort.

Rows of a group (a language, say) ascend by their id. The place of a row is
the number of rows of its group with a smaller id. Every task packs the ids it
reads into compressed bitmaps, one for each 65,536 ids (a sorted list of
16-bit offsets while that is shorter, else the bits themselves, and the number
of repeats of repeated ids). Bitmaps of one range are merged; a directory of
counts, three levels of at most 65,536 children each, says how many rows lie
before a range. A row's place is then the directory's count plus the bits set
before its own.

Rows are dealt by (group, place >> 10) into slot arrays of 1,024 leaves, each
of which is reduced to one node; the nodes are reduced alike until one is left
for a group, its subroot. The subroots, in the order of their groups, make one
more tree, whose last node is the root. On the way down every block gets the
siblings above it once, and its leaves add their own.

A node is the lower-case hex sha256 of its children's hex digests in order; a
last run of one child becomes that child's digest hashed again. A lone leaf is
its group's subroot, and a lone subroot the root.

Cases: a null group comes first and is a group like any other; null ids come
before all others of their group and are equal to each other; rows of equal id
follow each other by leaf. An empty table has no rows. Only the columns named
are read. The id is cast to a long.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import one_row, ranked, saved

#: Ids of a bitmap, as a power of two; leaves of a slot array, likewise.
RANGE_BITS = 16
BLOCK_BITS = 10
#: A bitmap of this many offsets or more is held as bits.
DENSE = 4_096
#: Ids that a task packs at once, and rows of a range that go to one task.
PACKED = 1_000_000
RANGE_ROWS = 1 << 13
#: The range of null ids lies below all others.
NULL_RANGE = -(1 << 47) - 1


def digest(*parts: bytes) -> bytes:
    """Hex sha256 of the parts put together."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def field_text(col: Column) -> Column:
    """A value as the leaf shows it: ``-`` for null, else its length in bytes, a colon and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*cols: Column) -> Column:
    """Hex sha256 of the columns, each with its length."""
    return F.sha2(F.concat(*[field_text(c) for c in cols]), 256)


# Bitmaps -------------------------------------------------------------------------

def pack(offsets: np.ndarray, counts: np.ndarray) -> bytes:
    """A multiset of 16-bit offsets: the set as a list or as bits, then (offset, repeats) of those that repeat."""
    if len(offsets) < DENSE:
        head, body = len(offsets), offsets.astype("<u2").tobytes()
    else:
        bits = np.zeros(1 << RANGE_BITS, bool)
        bits[offsets] = True
        head, body = 1 << 31, np.packbits(bits, bitorder="little").tobytes()
    more = counts > 1
    extra = np.zeros(int(more.sum()), [("at", "<u2"), ("n", "<i8")])
    extra["at"], extra["n"] = offsets[more], counts[more] - 1
    return struct.pack("<I", head) + body + extra.tobytes()


def unpack(data: bytes) -> np.ndarray:
    """Rows of each of the 65,536 offsets."""
    (head,) = struct.unpack_from("<I", data)
    if head >> 31:
        body = 4 + (1 << RANGE_BITS) // 8
        counts = np.unpackbits(np.frombuffer(data[4:body], np.uint8), bitorder="little").astype(np.int64)
    else:
        body, counts = 4 + 2 * head, np.zeros(1 << RANGE_BITS, np.int64)
        counts[np.frombuffer(data[4:body], "<u2")] = 1
    extra = np.frombuffer(data[body:], [("at", "<u2"), ("n", "<i8")])
    counts[extra["at"]] += extra["n"]
    return counts


_BITMAP = "grp string, range long, bits binary"


def _pack_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, range, at) rows to one bitmap a group and range, as far as a task sees them together."""
    def flush(held):
        if not held:
            return
        t = pa.Table.from_batches(held).group_by(["grp", "range", "at"]).aggregate([([], "count_all")]).sort_by(
            [("grp", "ascending"), ("range", "ascending"), ("at", "ascending")])
        code = t.column("grp").combine_chunks().dictionary_encode().indices.to_numpy()
        ranges, at = t.column("range").to_numpy(), t.column("at").to_numpy()
        counts = t.column("count_all").to_numpy()
        starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (ranges[1:] != ranges[:-1])])
        ends = np.r_[starts[1:], len(at)]
        for i in range(0, len(starts), 1_000):
            some = slice(i, i + 1_000)
            yield pa.RecordBatch.from_arrays(
                [t.column("grp").combine_chunks().take(pa.array(starts[some])), pa.array(ranges[starts[some]]),
                 pa.array([pack(at[a:e], counts[a:e]) for a, e in zip(starts[some], ends[some])], pa.binary())],
                names=["grp", "range", "bits"])
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= PACKED:
            yield from flush(held)
            held, n = [], 0
    yield from flush(held)


def _merge_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps sorted by group and range to one for each, with its number of rows and whether ids repeat."""
    key, counts, out = None, None, []

    def row():
        at = np.flatnonzero(counts)
        return (*key, pack(at, counts[at]), int(counts.sum()), bool((counts > 1).any()))

    def batch():
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          names=["grp", "range", "bits", "rows", "repeats"])
    for b in batches:
        for g, r, bits in zip(*(c.to_pylist() for c in b.columns)):
            if key != (g, r):
                if key is not None:
                    out.append(row())
                key, counts = (g, r), np.zeros(1 << RANGE_BITS, np.int64)
            counts += unpack(bits)
            if len(out) >= 500:
                yield batch()
                out.clear()
    if key is not None:
        out.append(row())
        yield batch()


def bitmaps(rows: DataFrame) -> DataFrame:
    """rows: (grp, range, at). One bitmap a group and range: grp, range, bits, rows, repeats, start (rows of the group
    in lower ranges) and n (rows of the group)."""
    packed = rows.select("grp", "range", "at").mapInArrow(_pack_ids, _BITMAP)
    merged = saved(packed.repartition("grp", "range").sortWithinPartitions("grp", "range").mapInArrow(
        _merge_bitmaps, _BITMAP + ", rows long, repeats boolean"), "bitmaps")
    # The directory: each window holds the children of one node, at most 65,536 (and the null range).
    level, at = merged.select("grp", "range", "rows"), "range"
    starts = merged.withColumn("start", F.lit(0).cast("long"))
    for depth, parent in enumerate(("_p1", "_p2", None)):
        if parent is not None:
            level = level.withColumn(parent, F.shiftright(at, RANGE_BITS))
        keys = ["grp"] + ([parent] if parent else [])
        before = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumn(f"_s{depth}", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        starts = starts.join(own.drop("rows", *([parent] if parent else [])), ["grp", at])
        starts = starts.withColumn("start", F.col("start") + F.col(f"_s{depth}")).drop(f"_s{depth}")
        if parent is not None:
            starts = starts.withColumn(parent, F.shiftright(at, RANGE_BITS))
            level, at = level.groupBy("grp", parent).agg(F.sum("rows").alias("rows")), parent
    sizes = level.groupBy("grp").agg(F.sum("rows").alias("n"))
    return saved(starts.join(sizes, "grp").drop("_p1", "_p2"), "directory")


_PLACED = "grp string, pos long, n long, repeated boolean, doc_id long, leaf string, claim string"


def _rank_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each range's bitmap comes first, then its rows: (grp, range, bits, start, n, at, doc_id, leaf, claim)."""
    before = counts = None
    start = n = 0
    for b in batches:
        cols = {name: b.column(i) for i, name in enumerate(b.schema.names)}
        is_map = cols["bits"].is_valid().to_numpy(zero_copy_only=False)
        cuts = np.unique(np.r_[0, np.flatnonzero(is_map), b.num_rows]).tolist()
        for a, e in zip(cuts, cuts[1:]):
            if is_map[a]:
                counts = unpack(cols["bits"][a].as_py())
                before = np.cumsum(counts) - counts
                start, n = cols["start"][a].as_py(), cols["n"][a].as_py()
                a += 1
            if a < e:
                at = cols["at"].slice(a, e - a).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [cols["grp"].slice(a, e - a), pa.array(start + before[at]), pa.array(np.full(e - a, n, np.int64)),
                     pa.array(counts[at] > 1), *(cols[c].slice(a, e - a) for c in ("doc_id", "leaf", "claim"))],
                    names=["grp", "pos", "n", "repeated", "doc_id", "leaf", "claim"])


def place(rows: DataFrame) -> DataFrame:
    """rows: (grp, doc_id, leaf, claim). Adds pos, the row's place in its group, and n, the group's rows."""
    null = F.col("doc_id").isNull()
    keyed = rows.select("*", F.when(null, F.lit(NULL_RANGE)).otherwise(F.shiftright("doc_id", RANGE_BITS)).alias("range"),
                        F.when(null, F.lit(0)).otherwise(F.col("doc_id").bitwiseAND(F.lit((1 << RANGE_BITS) - 1)))
                        .cast("int").alias("at"))
    maps = bitmaps(keyed)
    # A range of many repeats is dealt over several tasks, each with the bitmap.
    parts = F.ceil(F.col("rows") / F.lit(RANGE_ROWS)).cast("int")
    wide = maps.where(F.col("rows") > RANGE_ROWS).select("grp", "range", parts.alias("_parts"))
    own = keyed.join(wide, ["grp", "range"], "left").withColumn(
        "part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.monotonically_increasing_id(), F.col("_parts"))).cast("int"))
    heads = maps.select("grp", "range", "bits", "start", "n", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    both = heads.unionByName(own.drop("_parts"), allowMissingColumns=True)
    dealt = both.repartition("grp", "range", "part").sortWithinPartitions("grp", "range", "part", F.col("bits").isNull())
    ranked_rows = dealt.select("grp", "bits", "start", "n", "at", "doc_id", "leaf", "claim").mapInArrow(_rank_rows, _PLACED)
    if maps.where("repeats").isEmpty():
        return ranked_rows.drop("repeated")
    ranked_rows = saved(ranked_rows, "ranks")
    # Rows of equal id share the first one's place; their own order is by leaf.
    again = ranked(ranked_rows.where("repeated"), [F.col("grp"), F.col("pos"), F.col("leaf"), F.col("claim"), F.rand(1)], "_at")
    again = saved(again, "repeats")
    first = again.groupBy("grp", "pos").agg(F.min("_at").alias("_first"))
    again = again.join(first, ["grp", "pos"]).withColumn("pos", F.col("pos") + F.col("_at") - F.col("_first"))
    return ranked_rows.where("not repeated").drop("repeated").unionByName(again.drop("repeated", "_at", "_first"))


# Slot arrays ---------------------------------------------------------------------

def height(n: int) -> int:
    """Levels that reduce ``n`` nodes to one."""
    return (n - 1).bit_length()


def levels_of(nodes: list[bytes], up: int) -> list[list[bytes]]:
    """The nodes and what they become, level by level."""
    found = [nodes]
    for _ in range(up):
        last = found[-1]
        found.append([digest(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return found


_BLOCK = ("grp string, block long, n long, up int, node string, leaves array<string>, "
          "ids array<long>, claims array<string>")


def _fill_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, block, pos, n, leaf, doc_id, claim) rows, block after block, to one row a block."""
    key, held = None, {}
    size = 1 << BLOCK_BITS

    def row():
        grp, block, n = key
        used = min(size, n - block * size)
        if sorted(held) != list(range(used)):
            raise ValueError("places of a block are not whole")
        slots = [held[i] for i in range(used)]
        up = min(BLOCK_BITS, height(n))
        node = levels_of([s[0].encode() for s in slots], up)[-1][0].decode()
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in
             ((grp, pa.string()), (block, pa.int64()), (n, pa.int64()), (up, pa.int32()), (node, pa.string()),
              ([s[0] for s in slots], pa.list_(pa.string())), ([s[1] for s in slots], pa.list_(pa.int64())),
              ([s[2] for s in slots], pa.list_(pa.string())))],
            names=["grp", "block", "n", "up", "node", "leaves", "ids", "claims"])
    for b in batches:
        for grp, block, pos, n, leaf, doc_id, claim in zip(*(c.to_pylist() for c in b.columns)):
            if key != (grp, block, n):
                if key is not None:
                    yield row()
                key, held = (grp, block, n), {}
            held[pos % size] = (leaf, doc_id, claim)
    if key is not None:
        yield row()


def reduce_levels(nodes: DataFrame) -> list[DataFrame]:
    """nodes: (grp, pos, n, leaf[, doc_id, claim]). Tables of blocks, the leaves' first, until each group has one node."""
    tables = []
    most = one_row(nodes.agg(F.max("n")))[0] or 0
    nodes = nodes.select("grp", "pos", "n", "leaf",
                         *(F.col(c) if c in nodes.columns else F.lit(None).cast(t).alias(c)
                           for c, t in (("doc_id", "long"), ("claim", "string"))))
    for i in range(max(1, math.ceil(height(max(most, 1)) / BLOCK_BITS))):
        dealt = nodes.withColumn("block", F.shiftright("pos", BLOCK_BITS)).repartition("grp", "block")
        blocks = saved(dealt.sortWithinPartitions("grp", "block").select("grp", "block", "pos", "n", "leaf", "doc_id", "claim")
                       .mapInArrow(_fill_slots, _BLOCK), f"blocks-{i}")
        tables.append(blocks)
        nodes = blocks.select("grp", F.col("block").alias("pos"),
                              F.shiftright(F.col("n") + ((1 << BLOCK_BITS) - 1), BLOCK_BITS).alias("n"),
                              F.col("node").alias("leaf"), F.lit(None).cast("long").alias("doc_id"),
                              F.lit(None).cast("string").alias("claim"))
    return tables


def steps(levels: list[list[bytes]], slot: int) -> list[tuple[str, bytes]]:
    """The siblings of one slot, level by level: ``<`` for one on the left, ``>`` on the right, ``-`` for none."""
    found = []
    for level in levels[:-1]:
        other = slot ^ 1
        found.append(("-", b"") if other >= len(level) else ("<" if slot & 1 else ">", level[other]))
        slot >>= 1
    return found


def path_text(found: list[tuple[str, bytes]]) -> bytes:
    """Steps as text: a side mark, then 64 hex digits unless there is no sibling."""
    return b"".join(side.encode() + node for side, node in found)


def path_steps(path: bytes) -> list[tuple[str, bytes]]:
    found, i = [], 0
    while i < len(path):
        side = chr(path[i])
        step = b"" if side == "-" else path[i + 1:i + 65]
        found.append((side, step))
        i += 1 + len(step)
    return found


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    for side, node in path_steps(path):
        leaf = digest(node, leaf) if side == "<" else digest(leaf, node)
    return leaf


_PATH = "grp string, pos long, path string, subroot string, root string"


def _pass_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, block, up, leaves, path, subroot, root) to one row a slot, with its path."""
    for b in batches:
        for grp, block, up, leaves, path, subroot, root in zip(*(c.to_pylist() for c in b.columns)):
            levels = levels_of([x.encode() for x in leaves], up)
            paths = [(path_text(steps(levels, s)) + path.encode()).decode() for s in range(len(leaves))]
            n = len(leaves)
            yield pa.RecordBatch.from_arrays(
                [pa.array([grp] * n, pa.string()), pa.array([(block << BLOCK_BITS) + s for s in range(n)], pa.int64()),
                 pa.array(paths, pa.string()), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string())],
                names=["grp", "pos", "path", "subroot", "root"])


_PROOF = "grp string, pos long, doc_id long, leaf string, subroot string, root string, path string, proof_sha256 string, folded_root string"


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for the leaves, with their own proof, folded from the claimed leaf."""
    names = [c.split()[0] for c in _PROOF.split(", ")]
    for b in batches:
        for grp, block, up, leaves, ids, claims, path, subroot, root in zip(*(c.to_pylist() for c in b.columns)):
            levels = levels_of([x.encode() for x in leaves], up)
            rows = []
            for s, (leaf, doc_id, claim) in enumerate(zip(leaves, ids, claims)):
                full = path_text(steps(levels, s)) + path.encode()
                proof = digest(*(node for _, node in path_steps(full))).decode()
                folded = fold((leaf if claim is None else claim).encode(), full).decode()
                rows.append((grp, (block << BLOCK_BITS) + s, doc_id, leaf, subroot, root, full.decode(), proof, folded))
            kinds = [pa.string(), pa.int64(), pa.int64()] + [pa.string()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def merkle_manifest(docs: DataFrame, leaf: Column, claim: Column | None = None, *, id_col: str = "doc_id",
                    group_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, group, pos (its place in the group), leaf, subroot, root, path (its siblings from
    leaf to root, each with a side mark), proof_sha256, folded_root (from ``claim`` where it is not null, else from
    ``leaf``) and verified."""
    grp = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))  # a null group, first, is "-"
    rows = saved(docs.select(grp.alias("grp"), F.col(id_col).cast("long").alias("doc_id"), leaf.alias("leaf"),
                             (F.lit(None).cast("string") if claim is None else claim).alias("claim")), "leaves")
    tables = reduce_levels(saved(place(rows), "places"))
    subroots = ranked(tables[-1].select("grp", F.col("node").alias("leaf")), [F.col("grp")], "pos")
    (n,) = one_row(subroots.agg(F.count(F.lit(1))))
    tops = reduce_levels(subroots.select(F.lit("").alias("grp"), "pos", F.lit(n).cast("long").alias("n"), "leaf"))
    down = tops[-1].select("grp", "block", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for table in reversed(tops):
        down = table.join(down, ["grp", "block"]).select("grp", "block", "up", "leaves", "path", "subroot", "root").mapInArrow(
            _pass_down, _PATH).withColumnRenamed("pos", "block")
    named = subroots.select(F.col("pos").alias("block"), F.col("grp").alias("_grp"), F.col("leaf").alias("_subroot"))
    down = saved(down.join(named, "block").select(F.col("_grp").alias("grp"), F.lit(0).cast("long").alias("block"), "path",
                                                  F.col("_subroot").alias("subroot"), "root"), "group-paths")
    for table in reversed(tables[1:]):
        down = saved(table.join(down, ["grp", "block"]).select("grp", "block", "up", "leaves", "path", "subroot", "root").mapInArrow(
            _pass_down, _PATH).withColumnRenamed("pos", "block"), "paths")
    out = tables[0].join(down, ["grp", "block"]).select(
        "grp", "block", "up", "leaves", "ids", "claims", "path", "subroot", "root").mapInArrow(_prove, _PROOF)
    group = F.when(F.col("grp") != "-", F.substring("grp", 2, 1 << 30)).alias("group")
    return out.select("doc_id", group, "pos", "leaf", "subroot", "root", "path", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
