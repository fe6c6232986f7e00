"""Exact dedup and quality rules against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from tradeflow.llm import exact_dedup, quality_llr

WS = re.compile(r"[\x20\x09-\x0D]")


def brute_exact(rows):
    groups = {}
    for at, (i, t) in enumerate(rows):
        groups.setdefault(WS.sub("", t or ""), []).append((-len(t or ""), i is None, i, at))
    out = []
    for at, (i, t) in enumerate(rows):
        norm = WS.sub("", t or "")
        best = min(groups[norm], key=lambda g: (g[0], g[1], g[2] or 0, g[3]))
        out.append((i, best[2], len(groups[norm]), best[3] == at, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = ODD + [(20, "a\tb"), (21, "a  b"), (22, "ab "), (23, "ab"), (24, "a b "), (25, "a   b")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.lit("same"), lambda t: F.pmod(F.length(t), F.lit(3)).cast("string")])
def test_exact_matches_brute_force_whatever_the_digest(documents, digest):
    got = exact_dedup.exact_dedup(documents(ROWS, 1), digest=digest).drop("row_id").collect()
    assert sorted(map(tuple, got), key=str) == brute_exact(ROWS)


def test_exact_hot_group_and_stage(documents):
    rows = [(i, "same text here") for i in range(400)] + [(1000 + i, f"text {i}") for i in range(50)]
    got = exact_dedup.exact_dedup(documents(rows, 4), salts=4)
    assert got.where("kept").count() == 51 and got.where("doc_id = 7").first().keep_id == 0
    stage = exact_dedup.keep_first_copies(documents(ROWS, 2))
    assert stage.columns == documents(ROWS).columns and stage.where("doc_id = 6").count() <= 1
    assert exact_dedup.exact_dedup(documents(ROWS).where("false")).count() == 0


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_match_brute_force(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(900 + i, t) for i, t in enumerate(
        ["a b c a b c", "a a a a a", "x\nx\n\nx \n y", "#*$% & |<>", "a b c d a b", " wide space here", *(t for _, t in ODD)])]
    found = quality_llr.base_measures(documents(rows)).drop("doc", "text").collect()
    got = Counter((r[0], *r[1:]) for r in found)
    assert got == Counter((i, *brute_measures(t)) for i, t in rows)


def test_quality_verdict_and_cases(spark, documents):
    rng = random.Random(3)
    voc = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(150)]
    clean = [(200 + i, " ".join(rng.choice(voc) + rng.choice(("", "", "", ",", ".")) for _ in range(120))) for i in range(30)]
    junk = [(100 + i, " ".join(rng.choice(voc) + rng.choice(("***", "###", "&&&")) for _ in range(120))) for i in range(10)]
    docs = documents(clean + junk + [r for r in ODD if r[0] != 7])  # without the text that would be most of the corpus
    labels = spark.createDataFrame([(200 + i, 1, 0) for i in range(30)] + [(100, 0, 0), (105, 1, 1)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality_llr.quality_rules(docs, quality_llr.trusted_sample(labels)).collect()}
    assert all(found[i].kept for i, _ in clean) and not any(found[i].kept for i, _ in junk)
    assert found[1].base_failed and found[1].llr is None and not found[1].kept and found[9].base_failed
    kept = quality_llr.keep_good(docs, quality_llr.trusted_sample(labels))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(200, 230))
    untrusted = quality_llr.quality_rules(docs, quality_llr.trusted_sample(labels.where("false")))
    assert untrusted.where("llr IS NOT NULL").count() == 0 and untrusted.where("kept").count() == 40
    assert quality_llr.quality_rules(docs.where("false"), quality_llr.trusted_sample(labels)).count() == 0


def test_quality_score_is_the_mean_log_ratio(spark, documents):
    """Scores and verdicts from counts made by hand; only the hash of a unit is Spark's."""
    import math
    import random
    rng = random.Random(8)
    good, bad = [f"word{i}" for i in range(30)], [f"junk{i}" for i in range(30)]
    texts = [" ".join(rng.choices(good if i % 3 else bad, k=rng.randint(55, 90))) + ("!!" if i % 4 == 0 else "") for i in range(40)]
    rows = list(enumerate(texts)) + [(100, "too short"), (101, None)]
    buckets, trusted = 256, [1, 2, 4]
    units = {i: re.findall(r"[A-Za-z]+|[^A-Za-z\s]+", t or "") for i, t in rows}  # ASCII texts
    pairs = sorted({(a, b) for u in units.values() for a, b in zip(u, [*u[1:], None])}, key=str)
    hashed = {(r.a, r.b): (r.one % buckets, r.two % buckets) for r in spark.createDataFrame(pairs, "a string, b string").selectExpr(
        "a", "b", "hash(a) AS one", "hash(a, b) AS two").collect()}
    grams = {i: [x for p in zip(u, [*u[1:], None]) for x in hashed[p]] for i, u in units.items()}
    raw, own = [1] * buckets, [1] * buckets
    for i, g in grams.items():
        for x in g:
            raw[x] += 1
            own[x] += i in trusted
    weights = [math.log(o / sum(own)) - math.log(r / sum(raw)) for o, r in zip(own, raw)]
    ids = spark.createDataFrame([(i,) for i in trusted], "id long")
    got = {r.doc_id: r for r in quality_llr.quality_rules(documents(rows), ids, buckets=buckets).collect()}
    for i, g in grams.items():
        if got[i].base_failed:
            assert i >= 100 and got[i].llr is None and not got[i].kept
            continue
        want = sum(weights[x] for x in g) / len(g)
        assert abs(got[i].llr - want) < 1e-6 and got[i].kept == (want >= quality_llr.THRESHOLD), i
    assert {got[i].kept for i in range(40)} == {True, False}
