"""Mixing, byte-level BPE and the id store against plain Python and the public libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from odd_rows import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeflow.llm import bpe_codec, entropy_mix, mph_store
from tradeflow.llm.common import ranked

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over


def test_mix_targets_rates_and_rounding(spark, documents):
    rng = np.random.default_rng(3)
    rows, sizes = [], {}
    for i in range(600):
        source = [None, "b", "B", "ä", "c", "hot", "hot", "hot"][i % 8]
        n = int(rng.integers(0, 60))
        rows.append((i, " ".join(["w"] * n) or None, source))
        sizes[source] = sizes.get(source, 0) + n
    docs = documents(rows)
    got = {r.doc_id: r for r in entropy_mix.mix(docs).collect()}
    want = brute_targets(sizes)
    taken = {}
    for i, t, s in rows:
        r = got[i]
        assert r.size == len((t or "").split()) and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 2 for s in want)
    # the dual's rates meet the targets to the tolerance
    assert all(abs(r.rate * r.source_size - r.target) <= 1e-6 * r.target for r in got.values())
    again = {r.doc_id: r.taken for r in entropy_mix.mix(docs.repartition(5)).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_mix_cases_and_stage(documents):
    docs = documents([(i, t, "s") for i, t in ODD] + [(50, None, None), (51, "", "zero")])
    got = entropy_mix.mix(docs).collect()
    assert len(got) == len(ODD) + 2 and all(r.taken <= 2 * r.size for r in got)
    assert [r.target for r in got if r.doc_id == 51] == [0.0]
    out = entropy_mix.mixed_rows(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    empty = docs.where("false")
    assert entropy_mix.mix(empty).count() == 0 and entropy_mix.mixed_rows(empty).count() == 0
    words_less = documents([(1, None, "a"), (2, " ", "b")])
    assert [r.taken for r in entropy_mix.mix(words_less).collect()] == [0, 0]


def test_ranked_counts_places(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = ranked(df, [F.col("v").desc()], "place").collect()
    assert all(r.place == 999 - r.v for r in got)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.load_ranks(RANKS), special_tokens={})


def test_bpe_equals_tiktoken(spark, documents, reference):
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(80).collect()
    rows = ODD + [(100 + r.doc_id, r.text) for r in sample] + [
        (400, "  \n\n x y　z 12345 don't I'LL <|endoftext|> ́́ 漢字かな \U0001F469‍\U0001F4BB"), (401, "aAbB" * 4000)]
    coded = bpe_codec.encode_decode(documents(rows), RANKS, P.PATTERN)
    got = sorted((str(r.doc_id), tuple(r.ids), bytes(r.decoded)) for r in coded.collect())
    want = sorted((str(i), tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert got == want
    digest = {r.doc_id: r for r in bpe_codec.digests(coded).where("doc_id >= 400").collect()}
    ids = reference.encode_ordinary(rows[-1][1])
    assert digest[401].n_tokens == len(ids) and digest[401].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert digest[401].decoded_sha256 == hashlib.sha256(rows[-1][1].encode()).hexdigest()
    assert bpe_codec.encode_decode(documents(rows).where("false"), RANKS, P.PATTERN).count() == 0


def merge_by_rank(ranks, piece):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        at = min(pairs)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def test_backtracking_equals_merging_on_small_vocabularies():
    rng = np.random.default_rng(5)
    for _ in range(30):
        ranks = {bytes([c]): i for i, c in enumerate(b"abc")}
        while len(ranks) < 14:                                     # any table of concatenations, not only trained ones
            a, b = (list(ranks)[int(rng.integers(len(ranks)))] for _ in range(2))
            ranks.setdefault(a + b, len(ranks))
        codec = bpe_codec.Codec(ranks, r".+")
        for _ in range(40):
            text = "".join(rng.choice(list("abc"), int(rng.integers(1, 14))))
            whole = [ranks[text.encode()]] if text.encode() in ranks else merge_by_rank(ranks, text.encode())
            assert list(codec.encode(text)) == whole, (ranks, text)


def test_store_round_trip(spark, documents, monkeypatch):
    rows = ODD + [(1000 - i, f"Word number{i}, İstanbul don't THE ẞtrasse " * (i % 4)) for i in range(300)] + [
        (2000, "<|endoftext|> a"), (2001, "b<|startoftext|>c\x1cd"), (2002, "İ? Σ. x\x85y")]
    docs = documents(rows, 3)
    monkeypatch.setattr(mph_store, "KEYS_PER_FILE", 60)
    monkeypatch.setattr(mph_store, "SHARD_BYTES", 50_000)
    store = mph_store.write_store(docs, P.path("word_bpe_49k.json"))
    assert store["index_files"] > 3
    got = mph_store.read_back(spark, store).collect()
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want, start = [], 0
    coded = {x: t.encode(x or "", add_special_tokens=False).ids + [1] for _, x in rows}
    for i, x in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        want.append((i, start, len(coded[x]), zlib.crc32(np.array(coded[x], "<u4").tobytes())))
        start += len(coded[x])
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    again = mph_store.read_back(spark, mph_store.open_store(spark, store["root"])).collect()
    assert sorted(map(tuple, again), key=str) == sorted(want, key=str) and store["manifest"].count() > 2
    missing = mph_store.lookup(spark.createDataFrame([(77777,), (1000,)], "key long"), store).collect()
    assert {r.key: r.n is None for r in missing} == {77777: True, 1000: False}
    empty = mph_store.write_store(docs.where("false"), P.path("word_bpe_49k.json"))
    assert mph_store.read_back(spark, empty).count() == 0


def test_word_encoder_equals_the_plain_library():
    """Random strings over U+0000 to U+2FFF, letters that change their length in lower case, and both special strings."""
    rng = np.random.default_rng(11)
    path = P.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), mph_store.WordEncoder(path)
    marks, odd = list("?!.,'\"-)*<|>"), list("İıſßẞΣςÅΩKǅŉ\x1c\x1f\x85\xa0\u0301\u0307\u0338\u0958\u2028")
    special, words = ["<|endoftext|>", "<|startoftext|>"], ["don't", "Word", "the", "I'LL", "été", "Straße", "слово", "ΟΔΟΣ"]
    texts = []
    for i in range(6000):
        parts = []
        for _ in range(int(rng.integers(1, 14))):
            kind = int(rng.integers(0, 7))
            parts.append(chr(int(rng.integers(0, 0x3000))) if kind < 2 else str(rng.choice(odd)) if kind == 2 else
                         str(rng.choice(marks)) if kind == 3 else " " if kind == 4 else
                         str(rng.choice(words)) if kind == 5 or rng.random() < 0.7 else str(rng.choice(special)))
        texts.append("".join(parts))
    texts += [a + b + m for a in odd + words for b in ("", "a", "A") for m in ("", "?", "'", "?\u0301", " ?")]
    for i in range(0, len(texts), 50):
        some = texts[i:i + 50]
        got = [np.frombuffer(x, "<u2").tolist() for x in own.encode(some, 1)]
        want = [e.ids + [1] for e in plain.encode_batch(some, add_special_tokens=False)]
        assert got == want, [t for t, g, w in zip(some, got, want) if g != w][:3]


def test_index_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5, 500):
        keys = [int(k) for k in rng.choice(10 ** 9, n, replace=False) - 10 ** 6]
        rows = np.zeros(n, mph_store.SLOT)
        rows["offset"] = np.arange(n)
        index = mph_store.Index.load(b"".join(mph_store.Index.build(keys, rows).dump()))
        found, there = index.find(keys)
        assert len(index.slots) == n and there.all() and list(found["offset"]) == list(range(n))
        assert not index.find([10 ** 10 + k for k in range(200)])[1].any()
