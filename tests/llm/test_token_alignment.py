import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from helpers import as_rows, docs_frame, odd_docs
from tokenizers import Tokenizer

from toolpulse.llm import token_alignment as A
from toolpulse.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "plain words and  two spaces, (brackets) 1234 'll",
    " leading and trailing ",
    "\n\n\tlines\r\nand\ttabs \n  x",
    "Größe façade ångström 漢字 🙂 é   x",
    "a▁b is not spelled",
    "<|endoftext|> <s> </s> <unk> <0x41> text",
    "x" * 500 + " " + "ab" * 300,
    "the the the the",
    "",
    None,
    " ",
]


def brute(texts):
    """Whole texts through both libraries, offsets compared one by one."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = A.byte_alphabet()
    rows, links = [], []
    for text in texts:
        groups, own, ids_a, ids_b = [], [], [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            spelled_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
            if b"".join(spelled_a) != (" " + text).encode() or b"".join(spelled_b) != (" " + text).encode():
                ids_a, ids_b = [], []
            ends_a, ends_b = {}, {}
            for ends, spelled in ((ends_a, spelled_a), (ends_b, spelled_b)):
                at = 0
                for k, token in enumerate(spelled if ids_a else []):
                    at += len(token)
                    ends[at] = k
            i = j = 0
            for at in sorted(ends_a.keys() & ends_b.keys()):
                p, q = ends_a[at] + 1, ends_b[at] + 1
                groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
                own.append((ids_a[p - 1], ids_b[q - 1]))
                i, j = p, q
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
        rows.append((len(ids_a), len(ids_b), len(groups), digest))
        links.append(own)
    count = Counter(pair for own in links for pair in own)
    best = defaultdict(int)
    for (_, right), n in count.items():
        best[right] = max(best[right], n)
    return [
        (*row[:3], len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), row[3])
        for row, own in zip(rows, links)
    ]


def ids_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_whole_texts(spark):
    docs = docs_frame(spark, [(i, t, "en", "s") for i, t in enumerate(TEXTS)])
    out = A.align_documents(docs, *PATHS)
    assert ids_of(out) == sorted(((i, *row) for i, row in enumerate(brute(TEXTS))), key=str)
    assert brute(TEXTS)[4][0] == 0 and brute(TEXTS)[8:10] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_hot_and_rare_pairs_and_small_blocks(spark, monkeypatch):
    """With few hot pairs and pairs sent on early, the numbers stay."""
    texts = [t for t in TEXTS if t] * 3 + [f"rare{i} tokenization of word{i * 17}" for i in range(60)]
    docs = docs_frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    wanted = sorted(((i, *row) for i, row in enumerate(brute(texts))), key=str)
    for share in (1, 30, 10**6):
        monkeypatch.setattr(A, "HOT_SHARE", share)
        assert ids_of(A.align_documents(docs, *PATHS)) == wanted


def test_chunks_are_forgotten_without_harm():
    small, large = A.Aligner(*PATHS, known_chunks=3), A.Aligner(*PATHS)
    for text in TEXTS:
        assert small.of_texts([text]) == large.of_texts([text])
    assert len(small.known) < 40 and not any(len(c) > A.LONG_CHUNK for c in large.known)


def test_chunks_together_equal_the_whole():
    """Also where pieces go on over a carriage return."""
    aligner = A.Aligner(*PATHS)
    for text in [t for t in TEXTS if t and "▁" not in t] + ["if (x) {\r\n  y();\r\n}\r z,\r\n\r\r;"]:
        found = aligner.of_texts([text])[0]
        whole = aligner.align(*aligner.words.encode_whole(text), [len(text.encode()) + 1])[0]
        assert len(found) > 1 or len(aligner.words.chunks(" " + text)) == 1
        assert [sum(f[k] for f in found) for k in range(3)] == list(whole[:3])
        assert ";".join(f[4] for f in found) == whole[4]


def test_identity_map_joins_equal_bytes():
    words = A.Vocabularies(*PATHS)
    pairs = [(a, b) for a, b in enumerate(words.identity.tolist()) if b >= 0]
    assert len(pairs) > 5_000 and all(words.bytes_a[a] == words.bytes_b[b] for a, b in pairs)


def test_odd_documents(spark):
    out = A.align_documents(odd_docs(spark), *PATHS)
    rows = odd_docs(spark).select("doc_id", "text").collect()
    wanted = [(r["doc_id"], *row) for r, row in zip(rows, brute([r["text"] for r in rows]))]
    assert as_rows(out) == sorted(wanted, key=str)
    assert A.align_documents(docs_frame(spark, []), *PATHS).collect() == []


def test_query_equals_brute_force(spark):
    """Every row of the smallest tables."""
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op12_token_alignment"](spark, folder)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ids_of(out) == sorted(((r["doc_id"], *row) for r, row in zip(rows, brute([r["text"] for r in rows]))), key=str)
