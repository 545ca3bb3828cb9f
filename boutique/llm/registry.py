"""Queries of the operators, one for each, and the oracles that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boutique.llm import (decontaminate, dedup, extract, fingerprint, hard_negatives, langid, lexical, licenses, mixing,
                          secrets, simhash, tokens, toxicity)
from boutique.llm.common import documents, scratch_path
from boutique.sources.tables import read_table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollup by two vocabularies after three batches, of which two come again: all
    documents are inserted; then two tenths of the ids are deleted and two tenths revised to
    their second half, one tenth of them both."""
    docs = documents(spark, sf_dir)
    ledger = tokens.Ledger(spark, scratch_path(spark, "tokens"), tokens.VERSIONS)
    half = F.substring("text", F.floor(F.length("text") / 2).cast("int") + 1, F.length("text"))
    revised = docs.where("pmod(doc_id, 10) in (1, 7)").withColumn("text", half)
    for _ in range(2):
        ledger.commit("load", inserts=docs)
        ledger.commit("change", deletes=docs.where("pmod(doc_id, 10) in (3, 7)"), revisions=revised)
    return ledger.rollup()


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read_table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(documents(spark, sf_dir), size=4, percent=80)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.document_fingerprints(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.relabelled(read_table(spark, sf_dir, "embeddings")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_token_counts, op2_html_extraction, op3_toxicity, op4_license_scan, op5_near_duplicates,
           op6_secret_scan, op7_language_id, op8_source_mix, op9_decontamination, op10_fingerprints,
           op11_hard_negatives, op12_ranked_search, op13_simhash, pipeline]
    return {f.__name__: f for f in own}


#: Documents of a common component: the exact join of shingle sets, closed by
#: spreading the smallest id.
NEAR_DUPLICATES_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id AND r.c < l.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id,
       min(r.c) = d.doc_id AS kept
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id, n.n
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_near_duplicates": NEAR_DUPLICATES_SQL, "op8_source_mix": mixing.MIX_SQL,
            "op11_hard_negatives": hard_negatives.HARD_NEGATIVES_SQL, "op12_ranked_search": lexical.RANKED_SQL}
