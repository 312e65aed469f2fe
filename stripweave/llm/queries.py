"""The corpus operators as registered queries: thin, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, htmltext, language, mixing, neardup, neighbours, packing, pii, repeats, secrets
from .common import documents


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.linked(documents(spark, sf_dir))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(documents(spark, sf_dir))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf_dir)))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(documents(spark, sf_dir))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), htmltext.trained())


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.fit(docs))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "source"))
    return mixed.select("doc_id", "source", *(F.col(c).alias(c[4:]) for c in mixed.columns if c.startswith("mix_")))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_minhash": op2_minhash,
    "op3_repeats": op3_repeats,
    "op4_neighbours": op4_neighbours,
    "op5_packing": op5_packing,
    "op6_secrets": op6_secrets,
    "op7_fingerprints": op7_fingerprints,
    "op8_html": op8_html,
    "op9_language": op9_language,
    "op10_mixing": op10_mixing,
}

#: The links by their definition: all pairs that share a shingle, and all that can be reached over links.
NEAR_DUPLICATES = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
               ELSE list_distinct([array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)]) END AS shingles FROM w),
  x AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
  pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM pairs JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * shared >= 85 * (len(p.shingles) + len(q.shingles) - shared)),
  ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reach AS (SELECT doc_id AS id, doc_id AS found FROM s UNION SELECT reach.id, ways.b FROM reach JOIN ways ON ways.a = reach.found)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN (SELECT id, min(found) AS component_id FROM reach GROUP BY 1) ON id = doc_id"""

#: The other contracts can't be written in SQL without user code, or are approximate; tests hold them against brute force.
ORACLES: dict[str, str] = {"op2_minhash": NEAR_DUPLICATES}
