"""The operators bound to the test tables, as the driver's queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm import bpe_codec, chain_dedup, dom_gbt, entropy_mix, exact_dedup, lemp_search, lpf_dedup, merkle_ranks, mph_store, nce_lm, quality_llr, secret_scan, simhash_pivots
from tradeflow.llm.common import table

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivots.near_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op2_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_dedup.shared_passages(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(bpe_codec.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_llr.trusted_sample(table(spark, sf_dir, "labels"))
    found = quality_llr.quality_rules(table(spark, sf_dir, "documents"), trusted)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "llr")


def op5_dom_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom_gbt.main_text(table(spark, sf_dir, "pages"))


def op6_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lpf_dedup.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_mix.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_mph_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = mph_store.write_store(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return mph_store.read_back(spark, store).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_nce_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nce_lm.lm_scores(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op12_lemp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = merkle_ranks.leaf_of(*map(F.col, fields))
    # Tampering, where 7 divides the id's crc32: one more character is claimed.
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    claim = merkle_ranks.leaf_of(*(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields))
    found = merkle_ranks.merkle_manifest(table(spark, sf_dir, "documents"), leaf, F.when(tampered, claim))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_pivots": op1_simhash_pivots,
        "op2_chain_dedup": op2_chain_dedup,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_quality_rules": op4_quality_rules,
        "op5_dom_gbt": op5_dom_gbt,
        "op6_lpf_dedup": op6_lpf_dedup,
        "op7_entropy_mix": op7_entropy_mix,
        "op8_mph_store": op8_mph_store,
        "op9_nce_lm": op9_nce_lm,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_entropy_secrets": op11_entropy_secrets,
        "op12_lemp_search": op12_lemp_search,
        "op13_merkle_ranks": op13_merkle_ranks,
    }


OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST) AS keep_id,
         row_number() OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS d,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL),
tf AS (SELECT d, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM t GROUP BY d, term),
size AS (SELECT d, sum(tf)::BIGINT AS n FROM tf GROUP BY d),
total AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM size),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, total GROUP BY term, nn),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
s AS (
  SELECT item_id, tf.d, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size ON size.d = tf.d, total
  GROUP BY item_id, tf.d),
r AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

#: ``crc`` is CRC-32 by its definition, a bit at a time; ``tree`` holds the levels of each language's list of nodes,
#: ``top`` those of the subroots; ``up`` and ``over`` climb them from every claimed leaf.
OP13_SQL = r"""
WITH RECURSIVE f AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
         coalesce(strlen(text) || ':' || text, '-') AS body,
         xor(4294967295, list_reduce(
           [4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                                                          lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
           lambda a, v: xor(xor(a, v) >> 1, 3988292384 * (xor(a, v) & 1)))) AS crc
  FROM documents),
l AS (
  SELECT rid, doc_id, lang, pos, sha256(head || chars || body) AS leaf,
         sha256(head || CASE WHEN crc % 7 = 0 THEN more ELSE chars END || body) AS claim FROM f),
tree AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS nodes FROM l GROUP BY lang
  UNION ALL
  SELECT lang, lvl + 1, list_transform(range(1, (len(nodes) + 1) // 2 + 1),
                                       lambda i: sha256(nodes[2 * i - 1] || coalesce(nodes[2 * i], '')))
  FROM tree WHERE len(nodes) > 1),
sub AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM tree WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS lvl, list(subroot ORDER BY pos) AS nodes FROM sub
  UNION ALL
  SELECT lvl + 1, list_transform(range(1, (len(nodes) + 1) // 2 + 1), lambda i: sha256(nodes[2 * i - 1] || coalesce(nodes[2 * i], '')))
  FROM top WHERE len(nodes) > 1),
up AS (
  SELECT rid, lang, pos, 0 AS lvl, claim AS node, '' AS proof FROM l
  UNION ALL
  SELECT rid, up.lang, pos, up.lvl + 1,
         CASE WHEN (pos >> up.lvl) & 1 = 1 THEN sha256(nodes[pos >> up.lvl] || node)
              ELSE sha256(node || coalesce(nodes[(pos >> up.lvl) + 2], '')) END,
         proof || CASE WHEN (pos >> up.lvl) & 1 = 1 THEN nodes[pos >> up.lvl] ELSE coalesce(nodes[(pos >> up.lvl) + 2], '') END
  FROM up JOIN tree ON up.lang IS NOT DISTINCT FROM tree.lang AND up.lvl = tree.lvl WHERE len(nodes) > 1),
over AS (
  SELECT rid, sub.pos, 0 AS lvl, node, proof, subroot
  FROM up JOIN sub ON up.lang IS NOT DISTINCT FROM sub.lang
  JOIN tree ON up.lang IS NOT DISTINCT FROM tree.lang AND up.lvl = tree.lvl WHERE len(nodes) = 1
  UNION ALL
  SELECT rid, pos, over.lvl + 1,
         CASE WHEN (pos >> over.lvl) & 1 = 1 THEN sha256(nodes[pos >> over.lvl] || node)
              ELSE sha256(node || coalesce(nodes[(pos >> over.lvl) + 2], '')) END,
         proof || CASE WHEN (pos >> over.lvl) & 1 = 1 THEN nodes[pos >> over.lvl] ELSE coalesce(nodes[(pos >> over.lvl) + 2], '') END,
         subroot
  FROM over JOIN top ON over.lvl = top.lvl WHERE len(nodes) > 1)
SELECT doc_id, leaf, subroot, nodes[1] AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = nodes[1] AS verified
FROM over JOIN top ON over.lvl = top.lvl AND len(nodes) = 1 JOIN l USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_exact_dedup": OP10_SQL, "op12_lemp_search": OP12_SQL, "op13_merkle_ranks": OP13_SQL}
