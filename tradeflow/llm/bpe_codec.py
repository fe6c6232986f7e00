"""Byte-level BPE encoding and decoding with a pattern-matching automaton.

The tokens, as Latin-1 strings of their bytes, fill a pyahocorasick automaton.
For each piece of the split pattern one automaton pass gives the longest token
at every byte. Encoding walks from the start with the longest token and goes
back to shorter ones where it must. A token may follow another only if merging
the two together would keep them apart; that test is memoised. Since the merge
result of every prefix is unique, a byte position that once led nowhere is
never tried again, so the work is linear in the piece, and the result equals
that of applying the merges in the order of their ranks.

Pieces recur, so each task keeps a bounded table of encoded pieces.

Cases: null or empty text has no ids and decodes to no bytes. Whole texts are
encoded, however long. Decoded bytes equal the UTF-8 text; a difference is an
error. Repeated rows get equal results. Only the id (cast to a long) and text columns are read.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import text_of

#: Pieces and token pairs that a task remembers at most.
PIECES = 600_000
PAIRS = 500_000
#: Rows and bytes of text in an output batch.
OUT_ROWS, OUT_BYTES = 1_000, 8 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class _Pieces(dict):
    """Encoded pieces; forgets all when full."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= PIECES:
            self.clear()
        self[piece] = ids = self.encode(piece)
        return ids


class Codec:
    """Encoder and decoder of one rank table. A token is its id; ``latin`` has its bytes as Latin-1 characters."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        size = max(ranks.values(), default=-1) + 1
        self.ranks = {t.decode("latin-1"): r for t, r in ranks.items()}
        self.token, self.latin = [b""] * size, [""] * size
        self.machine = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.token[r], self.latin[r] = t, t.decode("latin-1")
            if len(t) > 1:
                self.machine.add_word(self.latin[r], r)
        if len(self.machine):
            self.machine.make_automaton()
        self.length = list(map(len, self.token))
        self.before = [n - 1 for n in self.length]
        self.split = regex.compile(pattern).findall
        self.pieces = _Pieces(self._piece)
        self.sides: dict[str, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.shorter: list[int | None] = [-1] * size  # -1: not looked for yet

    # Merge trees -----------------------------------------------------------------

    def _sides(self, token: str) -> tuple[list, list] | None:
        """The token's parts that lie at its right and at its left end as its own merges go on, smallest first, each
        with the rank of the merge that swallows it; None if merging the token's bytes does not give the token."""
        if token in self.sides:
            return self.sides[token]
        ranks, parts = self.ranks, list(token)
        right, left = [], []
        while len(parts) > 1:
            best, at = min(((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if best == 1 << 60:
                self.sides[token] = None
                return None
            if at == len(parts) - 2:
                right.append((parts[-1], best))
            if at == 0:
                left.append((parts[0], best))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        never = 1 << 61
        self.sides[token] = found = (right + [(token, never)], left + [(token, never)])
        return found

    def _apart(self, a: str, b: str) -> bool:
        """Whether merging the bytes of ``a + b`` leaves the tokens a and b; of b alone, if a is empty."""
        if not a or not self._sides(b):
            return bool(self._sides(b))
        right, left, ranks = self._sides(a)[0], self._sides(b)[1], self.ranks
        i = j = 0
        good = True
        while True:
            (x, x_ends), (y, y_ends) = right[i], left[j]
            cross = ranks.get(x + y)
            # Equal ranks merge from the left: x's own merge comes before the pair, the pair before y's own.
            if cross is not None and cross < x_ends and cross <= y_ends:
                good = False
                break
            if i == len(right) - 1 and j == len(left) - 1:
                break
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        return good

    def _remember(self, key: int) -> bool:
        """Whether the pair of a key may be neighbours; the key's upper part is the first token + 1, 0 for none."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        a, b = key >> 24, key & 0xFFFFFF
        self.pairs[key] = good = self._apart(self.latin[a - 1] if a else "", self.latin[b])
        return good

    def _shorter(self, token: int) -> int | None:
        """The longest token that the token properly starts with."""
        text = self.latin[token]
        found = next((self.ranks[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ranks), None)
        self.shorter[token] = found
        return found

    # Encoding and decoding -------------------------------------------------------

    def _piece(self, piece: str) -> tuple[int, ...]:
        text = piece.encode("utf-8").decode("latin-1")
        whole = self.ranks.get(text)
        if whole is not None:
            return (whole,)
        size = len(text)
        longest: list[int | None] = [self.ranks.get(c) for c in text]
        if len(self.machine):
            before = self.before
            for end, token in self.machine.iter(text):
                longest[end - before[token]] = token  # ends rise, so the last is the longest
        length, shorter, pairs = self.length, self.shorter, self.pairs
        out: list[int] = []
        at, dead, token, left = 0, set(), longest[0], 0
        while True:
            while token is not None:
                end = at + length[token]
                if end not in dead:
                    good = pairs.get(left | token)
                    if good is None:
                        good = self._remember(left | token)
                    if good:
                        break
                token = shorter[token] if shorter[token] != -1 else self._shorter(token)
            if token is not None:
                out.append(token)
                at, left = end, token + 1 << 24
                if at == size:
                    return tuple(out)
                token = longest[at]
            elif out:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                left = out[-1] + 1 << 24 if out else 0
            else:
                raise ValueError("the vocabulary lacks a byte of the text")

    def encode(self, text: str) -> array:
        return array("i", chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _round_trip(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for b in batches:
            codec = codec or Codec(load_ranks(path), pattern)
            start, size, ids, back = 0, 0, [], []
            for i, cell in enumerate(b.column(1)):
                text = cell.as_py()
                own = codec.encode(text)  # whole texts, piece by piece
                data = codec.decode(own)
                if data != text.encode("utf-8"):
                    raise ValueError("decoded bytes differ from the text")
                ids.append(pa.Array.from_buffers(pa.int32(), len(own), [None, pa.py_buffer(own)]))
                back.append(data)
                size += len(data)
                if i + 1 == b.num_rows or i + 1 - start >= OUT_ROWS or size >= OUT_BYTES:
                    offsets = [0]
                    for x in ids:
                        offsets.append(offsets[-1] + len(x))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(start, i + 1 - start),
                         pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(ids)),
                         pa.array(back, pa.binary())], names=["id", "ids", "decoded"])
                    start, size, ids, back = i + 1, 0, [], []
    return run


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array of int) and decoded (the bytes the ids stand for)."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return (d.mapInArrow(_round_trip(ranks_path, pattern), "id long, ids array<int>, decoded binary")
            .withColumnRenamed("id", "doc_id"))


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of :func:`encode_decode`'s rows."""
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
