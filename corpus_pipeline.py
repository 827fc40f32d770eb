"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again for
the next. All but the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse.llm import jaccard_join, lang_id, line_dedup, packing, secret_scan
from toolpulse.sources.durable import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "byte_bpe_50k.json"
DUPLICATES = jaccard_join.Similarity(words=5, percent=80)


def _with_text(docs: DataFrame, text) -> DataFrame:
    return docs.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is clear; null texts, texts without a letter and ambiguous ones go.

    Without any labelled document no language can be told, and only texts without a letter go.
    """
    model = lang_id.train(lang_id.labelled_part(docs))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = lang_id.identify(docs.select(*COLUMNS), model)
    return found.where(~F.col("ambiguous") & (F.col("lang_pred") != lang_id.UNKNOWN)).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out; documents of which nothing else is left go.

    Null and empty texts stay as they are. Repeated rows and null ids are
    documents of their own; a line counts once per source, and a null source is none.
    """
    found = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return _with_text(found.where("n_removed = 0 OR trim(BOTH ' \n\t\r' FROM text) <> ''"), F.col("text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar documents the one with the smallest doc_id stays.

    Null, empty and blank texts are like nothing and stay. Rows that share an id
    are one document and stay or go together; rows without an id stay.
    """
    found = jaccard_join.similar_documents(docs.select("doc_id", "text"), DUPLICATES)
    others = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(others, "doc_id", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every row stays, and ``n_chars`` follows the text.

    Null and empty texts hold none. Equal rows get equal texts.
    """
    return _with_text(secret_scan.redact(docs.select(*COLUMNS)), F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence, with its ids.

    A null or empty text has the end token alone. Repeated rows and null ids
    are packed each for itself.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# Classifiers and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
