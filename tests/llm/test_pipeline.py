"""The corpus pipeline, stage by stage and whole."""

import public_tokenizers
from helpers import docs_frame
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == pipeline.COLUMNS, name
        kept = out.cache()
        assert 0.5 * docs.count() < kept.count() <= docs.count(), name
        docs = kept
    pieces = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r["length"] for r in pieces) == sum(len(tokenizer.encode(r["text"]).ids) + 1 for r in docs.collect())


def test_decisions_take_effect(spark):
    clean = [(i, " ".join(f"word{i * 50 + j}" for j in range(40)), "en", f"s{i % 9}") for i in range(40)]
    menu = [(100 + i, f"own words here number {i} {i + 1} {i + 2}\nhome menu about", "en", f"s{i}") for i in range(8)]
    copies = [(200 + i, clean[0][1] + f" tail{i}", "en", "s1") for i in range(3)]
    secrets = [(300 + i, f'text {i} with token = "{i:040x}" inside and more words {i * 7}', "en", "s2") for i in range(12)]
    rows = clean + menu + copies + secrets + [(400, None, "en", "s1"), (401, "123 456", "en", "s1"), (402, "", None, None)]
    docs = docs_frame(spark, rows)
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {400, 401, 402, 200, 201, 202} & set(texts) == set()
    assert {i for i, *_ in clean} <= set(texts)
    assert all(texts[i] == t for i, t, *_ in clean)
    assert "home menu" in texts[100] and not any("home menu" in texts[100 + i] for i in range(1, 8))
    assert all("<SECRET>" in texts[300 + i] and f"{i:040x}" not in texts[300 + i] for i in range(12))
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())


def test_run_on_the_small_table(spark):
    assert pipeline.run(spark, SF).where("length <= 0 OR offset + length > 2048").count() == 0


def test_language_stage_without_labels(spark):
    docs = docs_frame(spark, [(1, "some words", None, "a"), (2, "12 !", None, "a"), (3, None, None, "a"), (4, "", None, "a")])
    assert [r["doc_id"] for r in pipeline.identify_language(spark, docs, SF).collect()] == [1]
