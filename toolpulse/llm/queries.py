"""Registered queries of the operators and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse.llm import (
    byte_bpe,
    embedding_dups,
    jaccard_join,
    lang_id,
    line_dedup,
    packing,
    quality_rules,
    secret_scan,
    spelling_variants,
    token_alignment,
    topk,
    url_filters,
    warc,
)
from toolpulse.llm.common import table
from toolpulse.sources.durable import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    url_filters.Rule("org", "/", "allow"),
    url_filters.Rule("example.org", "/es/", "block"),
    url_filters.Rule("example.org", "/en/1", "block"),
    url_filters.Rule("com", "/fr/", "allow"),
    url_filters.Rule("com", "/de/", "block"),
]


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_url_filters", url_filters.judge_sql(URL_RULES))
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op2_line_dedup", line_dedup.dedup_sql())
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


@query("op3_embedding_near_dedup", embedding_dups.near_duplicates_sql())
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_lang_id")
def op4_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lang_id.train(lang_id.labelled_part(docs))
    found = lang_id.identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.withColumn("held_out", lang_id.held_out(F.col("doc_id")))


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    encoded = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) / 4 AS long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_exact_top_k", topk.top_k_sql())
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k_of_table(table(spark, sf_dir, "embeddings"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack_documents(docs, tokenizer, public_tokenizers.PATTERN, known_words=700_000)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op8_ngram_jaccard_join", jaccard_join.similar_documents_sql(3, 90))
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"), jaccard_join.Similarity(3, 90))


@query("op9_warc", warc.round_trip_sql())
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.resolve_revisits(warc.assemble(warc.read_records(spark, path)))


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op11_quality_rules", quality_rules.judge_sql())
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    bytes_bpe, pieces = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), bytes_bpe, pieces)


DELETE_EVERY = 97


@query("op13_spelling_variants", spelling_variants.variants_sql(DELETE_EVERY))
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"), delete_every=DELETE_EVERY)
