"""Alignment of two tokenizers: which ids of A end where ids of B end, and how often over the corpus.

Texts are cut before white space that follows another kind of character. No
token of either tokenizer reaches over such a cut (characters that a piece of B
holds inside are no cut), so a chunk is encoded and aligned once by a worker and
then looked up. Byte offsets where
tokens of both end cut the tokens into groups; the last tokens of a group are
linked, so a group is one link.

A-id to B-id with the same bytes is an array made beforehand. Groups of one A
token and its B token of the same bytes are counted in one vector as long as
A's vocabulary per task; only the other links enter a shuffle by id pair,
counted per task first. Best counts per B id are a vector as well. Pairs that
hold more than 1 / ``HOT_SHARE`` of the shuffled links, so fewer than that many
pairs, join the vectors that tasks get; only the rest is joined.
"""

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from toolpulse.llm.common import slices, worker_table
from toolpulse.sources.durable import materialise

KNOWN_CHUNKS = 250_000  # chunks of a generation that a worker keeps; about 0.4 kB each
RUN_CHARS = 20_000  # new chunks that are encoded at once
LONG_CHUNK = 64  # longer ones are not kept
HOT_SHARE = 4096
PAIRS_AT_ONCE = 1_000_000
SHIFT = 1 << 20  # a pair is A id * SHIFT + B id
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Byte of every character that a byte-level vocabulary is written in.

    Printable Latin-1 characters stand for themselves, the other bytes in order for U+0100 and up.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers with the bytes of their ids, and the identity map between them."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        added = {int(i): t.content for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = added[i].encode() if i in added else bytes(map(alphabet.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.guard = self.b.encode("x")
        self.size_a = np.array([len(t) for t in self.bytes_a])
        self.size_b = np.array([len(t) for t in self.bytes_b])
        # A piece comes before the single byte that only stands in for missing pieces.
        order = sorted(range(len(pieces)), key=lambda i: (not self.b.is_byte(i), -i))
        same = {self.bytes_b[i]: i for i in order}
        self.identity = np.array([same.get(t, -1) if t else -1 for t in self.bytes_a])
        # A cut before white space is right only if no piece goes on over it: carriage returns follow other signs in some.
        inside = "".join(sorted({c for p in pieces for c in re.findall(r"(?<=\S)\s", p.replace(SPACE, " "))}))
        going_on = f"(?:[{re.escape(inside)}]\\s*)?" if inside else ""
        self.chunks = re.compile(rf"\s+(?:\S+{going_on})*").findall

    def encode(self, run: str) -> tuple[list[int], list[int]]:
        """Ids of a run that begins with white space and follows something else."""
        ids = self.b.encode("x" + run, num_threads=1)
        return self.a.encode(run, add_special_tokens=False).ids, ids[len(self.guard) :]

    def encode_whole(self, text: str) -> tuple[list[int], list[int]]:
        return self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text, num_threads=1)

    def spells(self, ids_a: list[int], ids_b: list[int], data: bytes) -> bool:
        join = b"".join
        return join(map(self.bytes_a.__getitem__, ids_a)) == data == join(map(self.bytes_b.__getitem__, ids_b))


class Aligner:
    """Alignments of chunks, kept in two generations: the older is forgotten when the younger is full.

    An alignment is (A ids, B ids, groups, links as int64 bytes, groups as text), or None if the ids
    do not spell the chunk.
    """

    def __init__(self, path_a: str, path_b: str, known_chunks: int = KNOWN_CHUNKS):
        self.words = Vocabularies(path_a, path_b)
        self.known_chunks = known_chunks
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        self.texts_a = [str(i) for i in range(len(self.words.bytes_a))]
        self.texts_b = [str(i) for i in range(len(self.words.bytes_b))]

    def align(self, ids_a: list[int], ids_b: list[int], sizes: list[int]) -> list[tuple]:
        """Alignments of neighbouring chunks of ``sizes`` bytes, all of whose ends are ends of tokens."""
        flat_a, flat_b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        end_a, end_b = np.cumsum(self.words.size_a[flat_a]), np.cumsum(self.words.size_b[flat_b])
        shared, last_a, last_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        links = flat_a[last_a] * SHIFT + flat_b[last_b]
        upto = np.searchsorted(shared, np.cumsum(sizes), side="right")
        count_a, count_b = (np.diff(last[upto - 1], prepend=-1).tolist() for last in (last_a, last_b))
        text_a = list(map(self.texts_a.__getitem__, ids_a))
        text_b = list(map(self.texts_b.__getitem__, ids_b))
        groups, i, j = [], 0, 0
        for p, q in zip((last_a + 1).tolist(), (last_b + 1).tolist()):
            left = text_a[i] if p - i == 1 else ",".join(text_a[i:p])
            groups.append(f"{left}|{text_b[j] if q - j == 1 else ','.join(text_b[j:q])}")
            i, j = p, q
        out, start = [], 0
        for a, b, end in zip(count_a, count_b, upto.tolist()):
            out.append((a, b, end - start, links[start:end].tobytes(), ";".join(groups[start:end])))
            start = end
        return out

    def aligned(self, chunks: list[str]) -> list[tuple | None]:
        """Alignments of chunks that are encoded as one run; one by one if the run is not spelled."""
        data = [c.encode("utf-8", "replace") for c in chunks]
        ids = self.words.encode("".join(chunks))
        if self.words.spells(*ids, b"".join(data)):
            return self.align(*ids, [len(d) for d in data])
        return [found for c in chunks for found in self.aligned([c])] if len(chunks) > 1 else [None]

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) > self.known_chunks:
            self.known, self.older = {}, self.known
        seen = chunks.difference(self.known)
        self.known.update((c, self.older[c]) for c in seen if c in self.older)
        run, size = [], 0
        for chunk in [c for c in seen if c not in self.older]:
            # A chunk that ends in white space, or holds B's sign for a space, is no part of a run.
            if chunk[-1].isspace() or SPACE in chunk:
                self.known[chunk] = self.aligned([chunk])[0]
                continue
            run.append(chunk)
            size += len(chunk)
            if size > RUN_CHARS:
                self.known.update(zip(run, self.aligned(run)))
                run, size = [], 0
        if run:
            self.known.update(zip(run, self.aligned(run)))

    def of_texts(self, texts: list[str | None]) -> list[list[tuple]]:
        """Per text the alignments of its chunks in order; none where its ids do not spell it."""
        cut = [self.words.chunks(" " + text) if text else [] for text in texts]
        seen = set().union(*cut)
        self.learn(seen)
        out = []
        for text, chunks in zip(texts, cut):
            found = list(map(self.known.__getitem__, chunks))
            if None in found:
                a, b = self.words.encode_whole(text)
                data = (" " + text).encode("utf-8", "replace")
                found = self.align(a, b, [len(data)]) if self.words.spells(a, b, data) else []
            out.append(found)
        for chunk in seen:
            if len(chunk) > LONG_CHUNK:
                del self.known[chunk]
        return out


def aligner_of(path_a: str, path_b: str) -> Aligner:
    return worker_table(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))


# --- rows of documents ----------------------------------------------------------------


def _encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Row number, doc_id, token and group counts, digest, and the distinct links with their times (int64)."""

    def encode(batches):
        aligner = aligner_of(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for found in aligner.of_texts(part.column("text").to_pylist()):
                    link, times = np.unique(np.frombuffer(b"".join([f[3] for f in found]), dtype=np.int64), return_counts=True)
                    groups = ";".join([f[4] for f in found])
                    digest = hashlib.sha256(groups.encode()).hexdigest() if found else ""
                    sums = [sum(f[k] for f in found) for k in range(3)]
                    rows.append((row, *sums, digest, link.tobytes(), times.astype(np.int64).tobytes()))
                    row += 1
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
    names = ["doc_id", "row_no", "n_a", "n_b", "n_groups", "groups_sha256", "links", "times"]
    schema = "doc_id long, row_no long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, times binary"
    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(encode, schema)


def _numbers(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.int64)


def _counted(encoded: DataFrame, identity) -> DataFrame:
    """(regular, pair, n): a task's vector of one-to-one groups, and its other links with their times."""

    def count(batches):
        same = identity.value
        vector = np.zeros(len(same), dtype=np.int64)
        held: list[np.ndarray] = []
        size = 0

        def flush():
            pairs, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return _pair_rows(False, pairs, np.bincount(place, np.concatenate([h[1] for h in held])).astype(np.int64))

        for batch in batches:
            pairs, times = (_numbers(batch.column(c).to_pylist()) for c in ("links", "times"))
            regular = same[pairs // SHIFT] == pairs % SHIFT
            vector += np.bincount(pairs[regular] // SHIFT, times[regular], minlength=len(same)).astype(np.int64)
            held.append((pairs[~regular], times[~regular]))
            size += len(held[-1][0])
            if size > PAIRS_AT_ONCE:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()
        used = np.flatnonzero(vector)
        yield _pair_rows(True, used * SHIFT + same[used], vector[used])

    return encoded.select("links", "times").mapInArrow(count, "regular boolean, pair long, n long")


def _pair_rows(regular: bool, pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(pairs), regular)), pa.array(pairs, pa.int64()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["regular", "pair", "n"])


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A pair's count is how many links of all documents hold it; ``n_best`` are
    a document's links whose pair has the highest count of its B id, ties
    included, and ``count_sum`` the sum of its links' counts. A null or empty
    text, or one that the ids of either tokenizer do not spell byte by byte,
    has no tokens: zeros and an empty digest. Equal rows and null ids count each
    for itself; other columns are ignored. The paths are files on every node.
    """
    encoded = materialise(_encoded(docs, path_a, path_b), "aligned")
    context = docs.sparkSession.sparkContext
    words = Vocabularies(path_a, path_b)
    identity = context.broadcast(words.identity)
    counted = materialise(_counted(encoded, identity), "links")
    single = counted.where("regular").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = materialise(counted.where("NOT regular").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")

    times = np.zeros(len(words.identity), dtype=np.int64)
    for r in single.collect():  # at most A's vocabulary
        times[r["pair"] // SHIFT] = r["n"]
    best = np.zeros(len(words.bytes_b), dtype=np.int64)
    top = single.union(pairs).groupBy((F.col("pair") % SHIFT).alias("b")).agg(F.max("n").alias("n"))
    for r in top.collect():  # at most B's vocabulary
        best[r["b"]] = r["n"]
    total = pairs.agg(F.sum("n")).first()[0] or 0
    hot = sorted(tuple(r) for r in pairs.where(F.col("n") * HOT_SHARE > total).collect())  # fewer than HOT_SHARE
    hot_pairs, hot_times = (np.array([h[k] for h in hot], dtype=np.int64) for k in (0, 1))
    known = context.broadcast((times, best, hot_pairs, hot_times))

    def split(batch):
        """Row of every link, pair, times, count where a vector has it, and whether one has."""
        regular_times, _, hot_pairs, hot_times = known.value
        lists = batch.column("links").to_pylist()
        pair, n = _numbers(lists), _numbers(batch.column("times").to_pylist())
        row = np.repeat(np.arange(len(lists)), [len(v) // 8 for v in lists])
        a = pair // SHIFT
        regular = identity.value[a] == pair % SHIFT
        count = np.where(regular, regular_times[a], 0)
        if len(hot_pairs):
            place = np.minimum(np.searchsorted(hot_pairs, pair), len(hot_pairs) - 1)
            is_hot = hot_pairs[place] == pair
            count, regular = np.where(is_hot, hot_times[place], count), regular | is_hot
        return row, pair, n, count, regular

    def add_known(batches):
        best = known.value[1]
        for batch in batches:
            row, pair, n, count, has = split(batch)
            is_best = has & (count == best[pair % SHIFT])
            size = batch.num_rows
            sums = [np.bincount(row, v, minlength=size) for v in (n, n * is_best)] if len(row) else [np.zeros(size)] * 2
            total = np.zeros(size, dtype=np.int64)
            np.add.at(total, row[has], (n * count)[has])  # whole numbers: beyond a double's at scale
            out = [batch.column(c) for c in plain] + [pa.array(v.astype(np.int64)) for v in (*sums, total)]
            yield pa.RecordBatch.from_arrays(out, names=plain + ["n_links", "n_best", "count_sum"])

    def others(batches):
        for batch in batches:
            row, pair, n, _, has = split(batch)
            rows = batch.column("row_no").to_numpy()[row[~has]]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(pair[~has]), pa.array(n[~has])], names=["row_no", "pair", "n"])

    plain = ["doc_id", "row_no", "n_a", "n_b", "n_groups", "groups_sha256"]
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in plain)
    sums = encoded.mapInArrow(add_known, f"{schema}, n_links long, n_best long, count_sum long")
    rest = encoded.select("row_no", "links", "times").mapInArrow(others, "row_no long, pair long, n long")
    tops = F.broadcast(top.withColumnRenamed("n", "top"))  # at most B's vocabulary
    ranked = pairs.withColumn("b", F.col("pair") % SHIFT).join(tops, "b")
    ranked = ranked.select("pair", F.col("n").alias("count"), (F.col("n") == F.col("top")).alias("is_best"))
    more = rest.join(ranked, "pair").groupBy("row_no").agg(
        F.sum(F.col("n") * F.col("is_best").cast("long")).alias("more_best"), F.sum(F.col("n") * F.col("count")).alias("more_sum")
    )
    zero = F.lit(0).cast("long")
    return sums.join(more, "row_no", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
