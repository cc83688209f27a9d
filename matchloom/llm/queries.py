"""The operators applied to their tables, with the columns that their contracts name.

`QUERIES` maps a name to a function of (spark, folder). None of them limits its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import chat, fim, hard_negatives, ngram_join, packing, pieces, pii, quality_rules, secret_scan, simhash, topk, toxicity, url_filter
from matchloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens by minimum bin slack; one row per piece."""
    return packing.pack(table(spark, folder, "documents"))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and the added one formatted, and read back."""
    return chat.digest_conversations(chat.with_probe(table(spark, folder, "conversations")))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents, by fixed patterns and a tagger trained on a sample of them."""
    docs = table(spark, folder, "documents")
    return pii.find(docs, pii.train(docs))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages, by rules and by trust over links between hosts."""
    return url_filter.judge(table(spark, folder, "pages"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Fixed counts of all documents, and whether their statistics are ordinary for language and source."""
    return quality_rules.assess(table(spark, folder, "documents"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents, by fixed patterns and windows of high entropy."""
    return secret_scan.scan(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from confirmed examples outside the held-out fifth."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best vectors for every hundredth one."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded to pieces and decoded."""
    return pieces.digests(table(spark, folder, "documents"))


def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut and arranged for filling in the middle, and restored."""
    return fim.digests(table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives for the positives of every hundredth vector; some labels are changed first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents linked by a similarity of 0.9 of their three-word shingles."""
    return ngram_join.join_documents(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_packing,
        op2_chat_format,
        op3_pii,
        op4_url_filter,
        op5_quality_rules,
        op6_secret_scan,
        op7_toxicity,
        op8_simhash,
        op9_topk,
        op10_pieces,
        op11_fim,
        op12_hard_negatives,
        op13_ngram_join,
    )
}

SQL: dict[str, str] = {}

SQL["op11_fim"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents),
drawn AS (
  SELECT *, len(tokens) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM t),
placed AS (
  SELECT doc_id, text, n, tokens,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM drawn),
parts AS (
  SELECT doc_id, text, n, form,
         coalesce(array_to_string(list_slice(tokens, 1, a), ''), '') AS prefix,
         coalesce(array_to_string(list_slice(tokens, a + 1, b), ''), '') AS middle,
         coalesce(array_to_string(list_slice(tokens, b + 1, n), ''), '') AS suffix
  FROM placed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""

SQL["op12_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, x.vec_id, x.label,
         CAST(list_dot_product(a.v, x.v) AS BIGINT) AS score
  FROM usable a JOIN usable x ON a.vec_id % 100 = 0 AND x.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""

SQL["op13_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS joint
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * joint >= 90 * (a.n + b.n - joint)),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM sizes
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v)
SELECT sizes.doc_id, CAST(n AS BIGINT) AS n_shingles, min(reach.v) AS component_id
FROM sizes JOIN reach ON reach.u = sizes.doc_id GROUP BY ALL
"""
