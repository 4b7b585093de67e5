"""The registered queries of this folder, each over its whole table, with
production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ferry.llm import (bpe, exact_radix, hard_negatives, language_mixture, lm_automaton, merkle_manifest, ngram_join, packing,
                       quality_trees, secret_ledger, suffix_dedup, token_counts, url_model)
from ferry.llm.textbatch import documents

#: The tokenizer file of operators 2 and 9; a parameter, never copied here.
TOKENIZER = "byte_bpe_50k.json"
#: The tokenizer file of operator 11.
WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def _docs(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return documents(spark, sf_dir, table)


def op1_url_language_model(spark, sf_dir):
    return url_model.judge_urls(_docs(spark, sf_dir, "pages"))


def op2_bpe_pair_index(spark, sf_dir):
    return bpe.encode_documents(_docs(spark, sf_dir), tokenizer_path())


def op3_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_docs(spark, sf_dir))


def op4_exact_radix(spark, sf_dir):
    return exact_radix.exact_groups(_docs(spark, sf_dir))


def op5_language_mixture(spark, sf_dir):
    return language_mixture.predict_languages(_docs(spark, sf_dir))


def op6_secret_ledger(spark, sf_dir):
    return secret_ledger.secret_digest(_docs(spark, sf_dir))


def op7_quality_trees(spark, sf_dir):
    return quality_trees.judge_quality(_docs(spark, sf_dir), _docs(spark, sf_dir, "labels"))


def op8_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(_docs(spark, sf_dir))


def op9_lexical_packing(spark, sf_dir):
    return packing.pack_documents(_docs(spark, sf_dir), tokenizer_path())


def op10_lm_automaton(spark, sf_dir):
    return lm_automaton.score_documents(_docs(spark, sf_dir))


def op11_prefix_token_counts(spark, sf_dir):
    return token_counts.count_documents(_docs(spark, sf_dir), public_tokenizers.path(WORD_TOKENIZER))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine_negatives(hard_negatives.relabelled(_docs(spark, sf_dir, "embeddings")))


def op13_merkle_manifest(spark, sf_dir):
    proofs = merkle_manifest.manifest(_docs(spark, sf_dir))
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (
    op1_url_language_model, op2_bpe_pair_index, op3_suffix_array_dedup, op4_exact_radix, op5_language_mixture,
    op6_secret_ledger, op7_quality_trees, op8_ngram_join, op9_lexical_packing, op10_lm_automaton,
    op11_prefix_token_counts, op12_hard_negatives, op13_merkle_manifest)}

ORACLE = {
    "op4_exact_radix": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op8_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) c USING (doc_id)""",
    "op12_hard_negatives": """
WITH t AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS k
      FROM t a JOIN t b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, k FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY k DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.k DESC, s.b) AS INTEGER) AS rank,
       s.b AS negative_id, p.k AS positive_score, s.k AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.k <= 100 * s.k AND s.k <= p.k
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.k DESC, s.b) <= 5""",
    "op13_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, concat_ws('',
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
         list_reduce([4294967295] || [ascii(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')], lambda crc, b:
           list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i:
             xor(x >> 1, 3988292384 * (x & 1)))) AS not_crc
  FROM documents),
l AS (
  SELECT doc_id, source, head || coalesce(strlen(text) || ':' || text, '-') AS whole,
         head || coalesce(strlen(cut) || ':' || cut, '-') AS changed
  FROM (SELECT *, CASE WHEN not_crc % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS cut FROM d)),
leaf AS (SELECT doc_id, source, sha256(whole) AS h, sha256(changed) AS g,
                row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM l),
up AS (
  SELECT source, 0 AS lev, i, h, count(*) OVER (PARTITION BY source) AS n FROM leaf
  UNION ALL
  SELECT source, lev + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM up
  WHERE n > 1 GROUP BY source, lev, i // 3),
sub AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lev, i, h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT lev + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM top
  WHERE n > 1 GROUP BY lev, i // 3),
node AS (SELECT source, lev, i, h, n, false AS high FROM up UNION ALL SELECT NULL, lev, i, h, n, true FROM top),
step AS (
  SELECT a.source, a.high, a.lev, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lo,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS hi
  FROM node a JOIN node b ON a.source IS NOT DISTINCT FROM b.source AND a.high = b.high AND a.lev = b.lev
       AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL),
levels AS (SELECT source, max(lev) AS n FROM up GROUP BY source),
fold AS (
  SELECT leaf.doc_id, leaf.source, leaf.h AS leaf, sub.h AS subroot, sub.i AS pos, levels.n AS own, 0 AS k, leaf.i, leaf.g AS acc, '' AS proof
  FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source JOIN levels ON leaf.source IS NOT DISTINCT FROM levels.source
  UNION ALL
  SELECT f.doc_id, f.source, f.leaf, f.subroot, f.pos, f.own, f.k + 1, f.i // 3, sha256(lo || acc || hi), proof || lo || hi
  FROM fold f JOIN step s ON CASE WHEN f.k < f.own
    THEN NOT s.high AND s.source IS NOT DISTINCT FROM f.source AND s.lev = f.k AND s.i = f.i
    ELSE s.high AND s.lev = f.k - f.own AND s.i = f.pos // CAST(pow(3, f.k - f.own) AS BIGINT) END)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = r.h AS verified
FROM fold f JOIN (SELECT h, lev FROM top WHERE n = 1) r ON f.k = f.own + r.lev""",
}
