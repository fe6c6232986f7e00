"""The pipeline's stages and its registered queries."""

import re

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from tradeflow.llm import bpe_codec, entropy_mix, quality_llr, simhash_pivots
from tradeflow.llm.common import table

SF = "/root/testdata/sf0.001"


def test_names():
    ours = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in ours) == list(range(1, 14)) and "pipeline" in E.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "simhash near-dedup", "mixing sources", "byte-level bpe"]


def test_run_equals_its_stages_by_hand(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality_llr.quality_rules(docs, quality_llr.trusted_sample(table(spark, SF, "labels"))).where("kept").collect()}
    best = {}
    for i in sorted(good):
        norm = re.sub(r"[\x20\x09-\x0D]", "", rows[i].text)
        if norm not in best or len(rows[i].text) > len(rows[best[norm]].text):
            best[norm] = i
    kept = sorted(best.values())
    prints = {i: simhash_pivots.fingerprint(rows[i].text) for i in kept}
    group = {}
    for i in kept:                                                 # grow groups until nothing joins
        near = {group[j] for j in group if (prints[i] ^ prints[j]).bit_count() <= 2}
        low = min(near | {i})
        group = {j: low if g in near else g for j, g in group.items()} | {i: low}
    heads = sorted(set(group.values()))
    copies = {r.doc_id: r.copies for r in entropy_mix.mix(docs.where(docs.doc_id.isin(heads))).collect()}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                              mergeable_ranks=bpe_codec.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    want = sorted((i, coder.encode_ordinary(rows[i].text)) for i in heads for _ in range(copies[i]))
    got = sorted((r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len(got) > 50


@pytest.mark.parametrize("name", [n for n in E.queries() if re.match(r"op(1|3|4|6|7|8|9|10)_", n)])
def test_one_row_for_each_document(spark, name):
    got = E.queries()[name](spark, SF)
    assert got.count() == table(spark, SF, "documents").count()


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name


def test_exact_dedup_oracle(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute("SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM (" + E.oracle_sql()["op10_exact_dedup"] + ")").fetchall()
    assert sorted(want) == sorted(map(tuple, E.queries()["op10_exact_dedup"](spark, SF).collect()))
