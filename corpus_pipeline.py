"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. language: documents in which no learned language stands out (no letters, or all are as likely) go;
2. near-dedup: of each group of linked near-duplicates the document with the least id stays, and nothing
   goes without a text like it that stays;
3. secrets: what the scan finds is replaced in the text by its kind;
4. mixing: the rows are put in the order of the Pfair schedule of their sources;
5. packing: the texts become token sequences in the order of the rows, one row for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stripweave.llm import language, mixing, neardup, packing, secrets
from stripweave.llm.common import documents, fresh, quoted, written
from stripweave.llm.queries import tokenizer_path

#: A language stands out if its share of the posterior is so many times an equal share.
LEAST_LIFT = 1.1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which a learned language stands out, with the columns of ``docs``, whatever their names.

    Null and empty texts and those without a letter go; rows with null or repeated ids are judged each by itself. Where
    no row has a label (an empty table, say) nothing is learned, and all go.
    """
    lang, score = fresh("lang_pred", docs.columns), fresh("score", docs.columns)
    model = language.fit(docs)
    least = min(1.0, LEAST_LIFT / max(1, len(model.langs)))
    found = language.identify(docs, model, keep=(lang, score))
    return found.where((F.col(lang) != language.UNKNOWN) & (F.col(score) >= least)).select(*map(quoted, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts stays, the one with the least id; of rows equal in id and text one.

    A row goes only if a text like its own stays: rows that share an id but not a text are documents by themselves.
    Rows with a null id stay, as do texts without words, once for each id. Columns may have any name.
    """
    key = ["doc_id", "text_hash"]
    gone = written(neardup.duplicates(docs), name="gone")
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    kept = rows.join(gone, key, "left_anti")
    again = written(rows.where("doc_id is not null").groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), name="again")
    if not again.isEmpty():
        # Of several rows the one with the least hash of all columns; rows that are equal in all are alike.
        whole = [f"row.`{f.name.replace('`', '``')}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
        order = Window.partitionBy(*key).orderBy(F.xxhash64(*whole))
        once = kept.join(again, key, "left_semi").withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")
        kept = kept.join(again, key, "left_anti").unionByName(once)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in ``text`` replaced by their kind (see ``secrets.redact``); null texts stay null."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the schedule (see ``mixing.mix``); a null source is one of its own, and rows may repeat."""
    return mixing.in_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece, in the order of the rows (see ``packing.pack_in_order``); a null text is an empty one."""
    return packing.pack_in_order(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language models, MinHash and byte-level BPE can't be written in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name=f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
