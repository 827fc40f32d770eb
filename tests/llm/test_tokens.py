"""Byte-level BPE and packing against the public libraries."""

import math
from array import array
from zlib import crc32

import public_tokenizers
import pytest
import regex
import tiktoken
from helpers import odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from toolpulse.llm import byte_bpe, packing, queries
from toolpulse.llm.pretokens import splitter

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
REPLAY = byte_bpe.replay_of(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=REPLAY.ranks, special_tokens={})
TEXTS = st.text(alphabet=st.one_of(st.sampled_from("aabbst'lre \n\t1\x1c\x85\xa0é"), st.characters(exclude_categories=["Cs"])), max_size=80)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=8))
def test_replay_equals_library(texts):
    ids = REPLAY.encode(texts, PATTERN)
    assert [list(array("I", x)) for x in ids] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [REPLAY.decode(x).decode() for x in ids] == texts


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_fast_split_equals_general(text):
    assert splitter(PATTERN)(text) == regex.findall(PATTERN, text)


def test_long_words_and_full_table(monkeypatch):
    texts = ["a" * 20_000, " " * 5_000 + "x", "abc" * 4_000, "".join(map(chr, range(33, 500)))]
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 3)
    assert [list(array("I", x)) for x in REPLAY.encode(texts, PATTERN)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_lower_rank_made_by_a_merge_goes_first():
    """Ranks that no training would give: the merge of b and c makes a pair that outranks it."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"abcb": 258}
    library = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    replay = byte_bpe.MergeReplay(ranks)
    for text in ("abcbc", "bcabcbcabc", "abcabcbcbc"):
        assert replay.replay([text.encode()])[0] == library.encode_ordinary(text)


def test_encoded_rows(spark):
    docs = odd_docs(spark)
    got = byte_bpe.encode_documents(docs, RANKS, PATTERN, decoded=True).collect()
    assert len(got) == docs.count()
    texts = [r["text"] or "" for r in docs.collect()]
    assert [bytes(r["decoded"]).decode() for r in got] == texts
    assert [list(array("I", bytes(r["ids"]))) for r in got] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, PATTERN).count() == 0


def check_packing(pieces, wanted):
    """Every id once, no sequence over its size, no gap, and few pads."""
    sequences, ids_of = {}, {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids_of.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"]), r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.SEQUENCE
    for key, ids in wanted.items():
        parts = sorted(ids_of[key])
        assert b"".join(p[1] for p in parts) == ids and all(len(p[1]) == 4 * p[2] for p in parts)
    return sum(packing.SEQUENCE - sum(n for _, n in parts) for parts in sequences.values())


def test_packed_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = {}
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        wanted[r["doc_id"], len(ids)] = array("I", ids).tobytes()
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), PATTERN).collect()
    pads = check_packing(pieces, wanted)
    assert pads < packing.SEQUENCE * docs.rdd.getNumPartitions()
    got = queries.QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").collect()
    whole = {(r["doc_id"], r["start"]): bytes(r["ids"]) for r in pieces}
    assert all(crc32(whole[r["doc_id"], r["start"]]) == r["ids_crc32"] for r in got)


def test_packed_odd_rows(spark):
    docs = odd_docs(spark)
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), PATTERN)
    assert pieces.where("doc_tokens = 1").count() == 3  # null and empty texts
    assert pieces.where("doc_id = 1").count() >= 2
    assert packing.pack_documents(docs.limit(0), public_tokenizers.path("byte_bpe_50k.json"), PATTERN).count() == 0


def test_special_strings_are_encoded_as_the_library_does():
    encoder = packing.encoder_of(public_tokenizers.path("byte_bpe_50k.json"), PATTERN)
    texts = ["a <|endoftext|> b", "plain", "", "漢字 ok"]
    wanted = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [list(array("I", x)) for x in encoder.encode(texts)] == wanted


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 99), max_size=60))
def test_assignment_keeps_room_and_balances(lengths):
    pieces = packing.assign(lengths, 100)
    rooms = {}
    for item, start, n, to, offset in pieces:
        rooms.setdefault(to, []).append((offset, n))
    assert len(rooms) == math.ceil(sum(lengths) / 100)
    assert all(sum(n for _, n in parts) <= 100 for parts in rooms.values())
    assert sorted((i, n) for i, n in enumerate(lengths)) == sorted(
        (i, sum(n for item, _, n, _, _ in pieces if item == i)) for i in range(len(lengths))
    )


def test_equal_documents_spread_evenly():
    pieces = packing.assign([30] * 30, 100)
    counts = {}
    for _, _, n, to, _ in pieces:
        counts[to] = counts.get(to, 0) + n
    assert set(counts.values()) == {100}


@pytest.mark.parametrize("name", ["op5_byte_bpe", "op7_packing"])
def test_query_has_its_columns(spark, name):
    columns = {
        "op5_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
        "op7_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    }
    assert set(queries.QUERIES[name](spark, "/root/testdata/sf0.001").columns) == columns[name]
