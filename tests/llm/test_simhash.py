"""SimHash groups against all pairs; components against union-find."""

import random

import numpy as np
import pytest
import xxhash
from odd_rows import ODD

from tradeflow.llm import simhash_pivots as S
from tradeflow.llm.components import components


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, pairs):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        up[top(a)] = top(b)
    return [top(x) for x in range(n)]


def brute(rows):
    fp = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    pairs = [(i, int(j)) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= 2) + i + 1]
    root = roots(len(fp), pairs)
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return sorted(((i, f"{int(f):016x}", low.get(r)) for (i, _), f, r in zip(rows, fp, root)), key=str)


def near_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = list(ODD)
    for g in range(12):
        text = [rng.choice(words) for _ in range(rng.choice((40, 150, 400)))]
        for c in range(rng.choice((1, 3, 12))):
            own = list(text)
            if c:
                own[rng.randrange(len(own))] = "changed"
            rows.append((100 + 20 * g + c, " ".join(own)))
    return rows


@pytest.mark.parametrize("limit", [128, 1])
def test_groups_match_all_pairs(documents, limit):
    rows = near_rows()
    got = S.near_copies(documents(rows), bucket_limit=limit).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_links_connect_all_close_fingerprints(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    chain = [int(base[0]) ^ ((1 << k) - 1) for k in range(0, 40, 2)]           # a long chain at two bits a step
    fps = sorted({*map(int, base), *chain, *(int(b) ^ (1 << int(rng.integers(63))) for b in base for _ in range(6))})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    place = {f: i for i, f in enumerate(fps)}
    want = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    for limit in (128, 1):
        pairs = [(place[r.a], place[r.b]) for r in S.links(nodes, bucket_limit=limit).collect()]
        assert all((fps[a] ^ fps[b]).bit_count() <= 2 for a, b in pairs)
        have = roots(len(fps), pairs)
        assert len(set(zip(have, want))) == len(set(have)) == len(set(want))


def test_pivots_never_discard_a_close_pair():
    rng = np.random.default_rng(2)
    refs, fps = S.pivots(), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    other = fps ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))
    gap = np.abs(S.pivot_table(fps, refs).astype(int) - S.pivot_table(other, refs).astype(int)).max(axis=1)
    assert (gap <= 2).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[i] for i in range(100, 140)}) == 1 and got[200] == got[201]
    assert len(set(got.values())) == 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_one_of_each(documents):
    rows = near_rows()
    docs = documents(rows)
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r[2] for r in brute(rows)})
    assert S.near_copies(docs.where("false")).count() == 0
