"""Token ids in binary shards with a minimal perfect hash index.

Documents are dealt into shards by ranges of their id, so shards in order are
documents in ascending id. A shard file is a short header, the raw ids (two bytes each when
the vocabulary allows it, else four, little-endian), and a list of its
documents' keys and lengths. ``manifest`` names the shards with their documents,
ids and first id's place among all; it and ``index-size`` are written last, and a
store is opened from its folder alone.

The index maps a document id to the place of its ids in constant time. Keys
are dealt to index files by hash; in each file a minimal perfect hash (small
buckets, each with a displacement that sends its keys to free slots) gives a
key its slot, and the slot holds a fingerprint of the key, the shard, the
offset, the length and the number of equal keys. A fingerprint that differs
means that the key is not stored.

Executors write the files through pyarrow's file systems under the shared
folder: to a name of their own first, then moved into place, so a task that
runs again leaves the same file. Shards are cut by the bytes of their texts.

Ids are those of the library's plain ``encode`` of the whole text: its special
strings in a text are its special tokens. Words are encoded apart, which is
the same as no token crosses the tokenizer's white space, and remembered by the
worker. Of a word of letters below U+0530 that the tokenizer's normaliser
leaves letters, the ASCII marks at its end are encoded apart too.

Cases: null or empty text has the end id alone. A null id has no key of its
own and is stored under the largest long, after all others. Documents of
equal id lie next to each other, in the order of their text's hash; the key
finds the first and their number. Only the id (cast to a long) and text columns
are read. An empty table makes an empty store.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import kept_in_worker, one_row, saved, shared_path, text_of

END_ID = 1
MAGIC = b"IDSHARD1"
HEAD = "<8sII"  # magic, bytes of an id, shard
TAIL = "<8sQQ"  # magic, documents, ids
INDEX_MAGIC = b"IDINDEX1"
#: Bytes of text of a shard; shards are smaller, down to the second figure, where there would be less than one a core.
SHARD_BYTES, SMALL_SHARD_BYTES = 128 << 20, 4 << 20
#: Keys of an index file, about; keys of a hash bucket, about; words that a worker remembers.
KEYS_PER_FILE = 50_000
BUCKET_KEYS = 3
TRIES = 256
WORDS = 800_000
#: Texts that are encoded together.
TOGETHER = 64
#: Letter runs that are encoded together.
RUNS = 1_000
#: ASCII characters that are neither letters, digits nor white space.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: The tokenizer's white space; ``str.split`` also takes U+001C to U+001F.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
NOT_SPACE = re.compile("[\x1c-\x1f]")
NO_ID = (1 << 63) - 1
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8"), ("equal", "<u4"), ("pad", "<u4")])


# Files ---------------------------------------------------------------------------

class _Whole:
    """A file that appears as a whole: written under a name of its own, then moved."""

    def __init__(self, uri: str):
        self.where, self.path = fs.FileSystem.from_uri(uri)
        self.where.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.where.open_output_stream(self.own)
        self.write = self.out.write

    def done(self) -> None:
        self.out.close()
        self.where.move(self.own, self.path)


class Reader:
    """Random access to the store's files."""

    def __init__(self, root: str):
        self.root, self.files, self.index = root, {}, {}

    def _open(self, name: str):
        if name not in self.files:
            where, path = fs.FileSystem.from_uri(f"{self.root}/{name}")
            self.files[name] = where.open_input_file(path)
        return self.files[name]

    def find(self, keys: list[int], index_files: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows (shard, offset, ids, equal keys) of the keys, and whether each is stored."""
        rows, there = np.zeros(len(keys), SLOT), np.zeros(len(keys), bool)
        by_file: dict[int, list[int]] = {}
        for i, k in enumerate(keys):
            by_file.setdefault(file_of(k, index_files), []).append(i)
        for file, own in by_file.items():
            name = f"index/{file:05d}"
            if name not in self.index:
                if len(self.index) >= 4:
                    self.index.clear()
                self.index[name] = Index.load(self._open(name).read())
            rows[own], there[own] = self.index[name].find([keys[i] for i in own])
        return rows, there

    def ids(self, shard: int, offset: int, n: int) -> np.ndarray:
        f = self._open(f"shards/{shard:06d}")
        if not hasattr(self, "width") or self.width[0] != shard:
            f.seek(0)
            magic, width, number = struct.unpack(HEAD, f.read(struct.calcsize(HEAD)))
            if magic != MAGIC or number != shard:
                raise ValueError("not a shard of this store")
            self.width = (shard, width)
        width = self.width[1]
        f.seek(struct.calcsize(HEAD) + offset * width)
        return np.frombuffer(f.read(n * width), f"<u{width}").astype("<u4")

    def close(self) -> None:
        for f in self.files.values():
            f.close()
        self.files = {}


# Minimal perfect hash ------------------------------------------------------------

def _hash(key: int, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(struct.pack("<q", key), seed)


def _slot(hashes: np.ndarray, move: np.ndarray, n: int) -> np.ndarray:
    """The slot that a move sends a key's hash to."""
    x = hashes + (move + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


def file_of(key: int, files: int) -> int:
    """As ``pmod(xxhash64(key), files)`` in Spark."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    return (h - (1 << 64) if h >> 63 else h) % files


class Index:
    """Minimal perfect hash of distinct keys onto slots 0 .. n-1."""

    def __init__(self, moves: np.ndarray, slots: np.ndarray):
        self.moves, self.slots = moves, slots

    @classmethod
    def build(cls, keys: list[int], rows: np.ndarray) -> "Index":
        """rows: one SLOT row for each key; its print is filled in here."""
        n = len(keys)
        moves = np.zeros(max(1, -(-n // BUCKET_KEYS)), "<u4")
        used, place = np.zeros(n, bool), np.zeros(n, np.int64)
        hashes = np.array([_hash(k, 0) for k in keys], np.uint64)
        bucket = np.array([_hash(k, 1) % len(moves) for k in keys], np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=len(moves))) if n else np.zeros(len(moves), np.int64)
        sizes = np.diff(ends, prepend=0)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[ends[b] - sizes[b]:ends[b]]
            if len(own) < 2:
                break
            for first in range(0, 1 << 31, TRIES):
                at = _slot(hashes[own][None, :], np.arange(first, first + TRIES, dtype=np.uint64)[:, None], n)
                line = np.sort(at, axis=1)
                good = np.flatnonzero(~used[at].any(axis=1) & (line[:, 1:] != line[:, :-1]).all(axis=1))
                if len(good):
                    moves[b], place[own] = first + good[0], at[good[0]]
                    used[at[good[0]]] = True
                    break
        # Single keys need no search: the move names a free slot outright.
        lone = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(~used)
        moves[lone] = (1 << 31) | free[:len(lone)]
        place[order[ends[lone] - 1]] = free[:len(lone)]
        slots = np.zeros(n, SLOT)
        slots[place] = rows
        slots["print"][place] = hashes & np.uint64(0xFFFFFFFF)
        return cls(moves, slots)

    def find(self, keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The slots' rows of the keys, and whether each key is stored (its row means something)."""
        if not len(self.slots):
            return np.zeros(len(keys), SLOT), np.zeros(len(keys), bool)
        own = np.array([_hash(k, 0) for k in keys], np.uint64)
        moves = self.moves[[_hash(k, 1) % len(self.moves) for k in keys]]
        lone = (moves >> 31).astype(bool)
        rows = self.slots[np.where(lone, moves & 0x7FFFFFFF, _slot(own, moves.astype(np.uint64), len(self.slots)))]
        return rows, rows["print"] == (own & np.uint64(0xFFFFFFFF))

    def dump(self) -> list[bytes]:
        return [INDEX_MAGIC, struct.pack("<QQ", len(self.moves), len(self.slots)), self.moves.tobytes(), self.slots.tobytes()]

    @classmethod
    def load(cls, data: bytes) -> "Index":
        if data[:8] != INDEX_MAGIC:
            raise ValueError("not an index of this store")
        m, n = struct.unpack_from("<QQ", data, 8)
        return cls(np.frombuffer(data, "<u4", m, 24), np.frombuffer(data, SLOT, n, 24 + 4 * m))


# Encoding ------------------------------------------------------------------------

class WordEncoder:
    """Token ids of words, by the tokenizers library. ``known`` remembers the first ``WORDS`` words (frequent ones come
    early); beyond them a word is encoded again for each batch of texts that has it."""

    @classmethod
    def of_worker(cls, path: str) -> "WordEncoder":
        kept = kept_in_worker()
        if ("words", path) not in kept:
            kept["words", path] = cls(path)
        return kept["words", path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer
        self.known: dict[str, bytes] = {}  # a plain dict of text and bytes costs the garbage collector nothing
        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4

        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _lone(self, words: list[str]) -> None:
        """Encode words one by one."""
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self.known[w] = array(self.code, e.ids).tobytes()

    def _runs(self, words: list[str]) -> None:
        """Encode letter runs many at a time; each ends with the one token of its that ends a word."""
        for i in range(0, len(words), RUNS):
            own = words[i:i + RUNS]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, f"<u{self.width}")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(own):  # a letter that lower-casing breaks in two
                self._lone(own)
                continue
            data, at = ids.tobytes(), 0
            for w, end in zip(own, (ends * self.width).tolist()):
                self.known[w] = data[at:end]
                at = end

    def learn(self, words: list[str]) -> set[str]:
        """Words of letters with marks after them are taken apart as the tokenizer does, so that parts recur. Returns
        all words and parts that are new."""
        known, parts, runs, lone = self.known, [], {}, {}
        for w in words:
            core = w.rstrip(MARKS)
            mark = w[len(core):]
            if not core.isalpha():
                lone[w] = None
                continue
            if core.isascii():
                core = core.lower()
            elif max(core) >= "\u0530" or not self.tokenizer.normalizer.normalize_str(core).isalpha():
                lone[w] = None
                continue
            if core not in known:
                runs[core] = None
            if mark or core != w:
                parts.append((w, core, mark))
                if mark and mark not in known:
                    lone[mark] = None
        self._runs(list(runs))
        self._lone(list(lone))
        added = {*words, *runs, *lone}
        for w, core, mark in parts:
            known[w] = known[core] + known[mark] if mark else known[core]
        return added

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Each text's ids and the end id, as bytes."""
        words = [[w for w in SPACE.split(t) if w] if NOT_SPACE.search(t) else t.split() for t in texts]
        seen = set().union(*words)
        new = seen.difference(self.known)
        full, known = len(self.known) >= WORDS, self.known
        added = self.learn(list(new)) if new else []
        end, get = end_id.to_bytes(self.width, "little"), known.__getitem__
        out = [b"".join(map(get, w)) + end for w in words]
        if full:
            for w in added:
                del known[w]
        return out


def _write_shards(root: str, tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file, keys, counts = None, None, [], []
        for b in batches:
            encoder = encoder or WordEncoder.of_worker(tokenizer_path)
            for i in range(0, b.num_rows, TOGETHER):
                if file is None:  # a task holds one shard
                    shard = b.column(1)[i].as_py()
                    file = _Whole(f"{root}/shards/{shard:06d}")
                    file.write(struct.pack(HEAD, MAGIC, encoder.width, shard))
                coded = encoder.encode(b.column(2).slice(i, TOGETHER).to_pylist(), end_id)
                file.write(b"".join(coded))
                keys.append(b.column(0).slice(i, TOGETHER).to_numpy())
                counts.append(np.array([len(data) // encoder.width for data in coded], "<i8"))
        if file is not None:
            own, sizes = np.concatenate(keys).astype("<i8"), np.concatenate(counts)
            for part in (own.tobytes(), sizes.tobytes(), struct.pack(TAIL, MAGIC, len(own), int(sizes.sum()))):
                file.write(part)
            file.done()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(own)], pa.int64()),
                                              pa.array([int(sizes.sum())], pa.int64())], names=["shard", "docs", "ids"])
    return run


def _list_shards(root: str):
    """Each shard's documents, from its own list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column(0).to_pylist():
                where, path = fs.FileSystem.from_uri(f"{root}/shards/{shard:06d}")
                with where.open_input_file(path) as f:
                    size, tail = f.size(), struct.calcsize(TAIL)
                    f.seek(size - tail)
                    magic, docs, ids = struct.unpack(TAIL, f.read(tail))
                    if magic != MAGIC:
                        raise ValueError("not a whole shard of this store")
                    f.seek(size - tail - 16 * docs)
                    keys, counts = np.frombuffer(f.read(16 * docs), "<i8").reshape(2, docs)
                if counts.sum() != ids:
                    raise ValueError("lengths of a shard do not add up")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(docs, shard, np.int32)), pa.array(np.cumsum(counts) - counts), pa.array(counts)],
                    names=["key", "shard", "offset", "n"])
    return run


def _write_index(root: str, files: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for file, *row in zip(*(c.to_pylist() for c in b.columns)):
                held.setdefault(file, []).append(row)
        done = []
        for file, rows in held.items():
            slots = np.zeros(len(rows), SLOT)
            for name, values in zip(("shard", "offset", "n", "equal"), list(zip(*rows))[1:]):
                slots[name] = values
            whole = _Whole(f"{root}/index/{file:05d}")
            for part in Index.build([r[0] for r in rows], slots).dump():
                whole.write(part)
            whole.done()
            done.append((file, len(rows)))
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in done], pa.int32()), pa.array([n for _, n in done], pa.int64())],
                                         names=["file", "keys"])
    return run


def write_store(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID, root: str | None = None) -> dict:
    """Encode ``docs`` into shards and index them. Returns what :func:`read_back` needs."""
    spark = docs.sparkSession
    root = root or shared_path(spark, "ids")
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), text_of(text_col).alias("text"))
    order = ["key", F.xxhash64("text")]
    (size,) = one_row(d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))))
    shards = max(1, -(-size // SHARD_BYTES), min(spark.sparkContext.defaultParallelism * 2, size // SMALL_SHARD_BYTES))
    dealt = d.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    written = saved(dealt.select("key", F.spark_partition_id().alias("part"), "text").mapInArrow(
        _write_shards(root, tokenizer_path, end_id), "shard int, docs long, ids long"), "shards")
    # One entry for each key: its first document, and how many follow with the same key.
    first = F.min(F.struct("shard", "offset", "n")).alias("first")
    keys = saved(entries(written, root).groupBy("key").agg(first, F.count(F.lit(1)).alias("equal")), "keys")
    (n,) = one_row(keys.agg(F.count(F.lit(1))))
    files = max(1, -(-n // KEYS_PER_FILE))
    dealt_keys = keys.select(F.pmod(F.xxhash64("key"), F.lit(files)).cast("int").alias("file"), "key", "first.shard", "first.offset", "first.n", "equal")
    saved(dealt_keys.repartition(files, "file").mapInArrow(_write_index(root, files), "file int, keys long"), "index-files")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    written.select("*", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start")).write.parquet(f"{root}/manifest")
    spark.range(1).select(F.lit(files).alias("index_files")).write.parquet(f"{root}/index-size")
    return open_store(spark, root)


def open_store(spark: SparkSession, root: str) -> dict:
    """A store from its folder."""
    (files,) = one_row(spark.read.schema("index_files int").parquet(f"{root}/index-size"))
    return {"root": root, "index_files": files,
            "manifest": spark.read.schema("shard int, docs long, ids long, start long").parquet(f"{root}/manifest")}


def entries(shards: DataFrame, root: str) -> DataFrame:
    """shards: (shard, ...). Their documents as the files list them: key, shard, offset, n."""
    return shards.select("shard").repartition("shard").mapInArrow(_list_shards(root), "key long, shard int, offset long, n long")


def _lookup(root: str, files: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(root)
        for b in batches:
            rows, there = reader.find(b.column("key").to_pylist(), files)
            kinds = {"shard": pa.int32(), "offset": pa.int64(), "n": pa.int64(), "equal": pa.int32()}
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(rows[c].astype(np.int64), mask=~there).cast(t) for c, t in kinds.items())],
                names=[*b.schema.names, *kinds])
        reader.close()
    return run


def lookup(keys: DataFrame, store: dict) -> DataFrame:
    """keys: (key long, ...). Adds shard, offset, n and equal from the index; nulls for a key that is not stored."""
    files = store["index_files"]
    dealt = keys.withColumn("_file", F.pmod(F.xxhash64("key"), F.lit(files))).repartition("_file").sortWithinPartitions("_file")
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields)
    return dealt.drop("_file").mapInArrow(_lookup(store["root"], files), own + ", shard int, offset long, n long, equal int")


def _checksums(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last = Reader(root), None
        for b in batches:
            sums = []
            for shard, offset, n in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                if shard != last:
                    reader.close()
                    last = shard
                sums.append(zlib.crc32(reader.ids(shard, offset, n).tobytes()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums, pa.int64())],
                                             names=["key", "shard", "offset", "n", "ids_crc32"])
        reader.close()
    return run


def read_back(spark: SparkSession, store: dict) -> DataFrame:
    """One row per stored document, read from the files through the index: doc_id, start, n_tokens, ids_crc32."""
    listed = entries(store["manifest"], store["root"]).toDF("key", "own_shard", "own_offset", "own_n")
    found = lookup(listed, store)
    # The index holds the first of several documents of equal id; the others' places are in their shard's list.
    lone = F.col("equal") == 1
    rows = found.select("key", *(F.when(lone, F.col(c)).when(F.col("equal") > 1, F.col(f"own_{c}")).otherwise(
        F.raise_error(F.lit("a stored document is not in the index")).cast(t)).alias(c)
        for c, t in (("shard", "int"), ("offset", "long"), ("n", "long"))))
    sums = rows.repartition("shard").sortWithinPartitions("shard", "offset").mapInArrow(
        _checksums(store["root"]), "key long, shard int, offset long, n long, ids_crc32 long")
    return sums.join(store["manifest"].select("shard", "start"), "shard").select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), (F.col("start") + F.col("offset")).alias("start"),
        F.col("n").alias("n_tokens"), "ids_crc32")
