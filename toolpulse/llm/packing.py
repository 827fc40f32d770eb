"""Packing of tokenised documents into sequences of equal attention cost.

A document's cost in a sequence is estimated as linear plus quadratic in its
tokens. Documents go in descending order to the sequence of lowest cost that
has room for them; one that fits nowhere is cut. Each task packs the documents
it reads, in groups of bounded size, so nothing is shuffled and memory stays
flat; a group wastes less than one sequence.
"""

import heapq
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from toolpulse.llm.common import slices, worker_table
from toolpulse.llm.pretokens import splitter

SEQUENCE = 2048
END_ID = 1
GROUP_TOKENS = 2_000_000
KNOWN_WORDS = 200_000  # words of a generation; about 0.3 kB each
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE


class WordEncoder:
    """Ids of texts by a ``tokenizers`` file; words of ``pattern`` are encoded once and looked up then.

    Known words are in two generations: when the younger is full, the older is
    forgotten, so frequent words stay and memory is bounded. A text that holds
    the string of an added token is encoded whole. The pattern must be the one
    that the tokenizer splits by.
    """

    def __init__(self, path: str, pattern: str, known_words: int = KNOWN_WORDS):
        # Tasks are the parallelism; the library's own threads only compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.known_words = known_words
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = splitter(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [None if any(a in text for a in self.added) else self.split(text) for text in texts]
        if len(self.known) > self.known_words:
            self.known, self.older = {}, self.known
        seen = set().union(*(w for w in words if w)).difference(self.known)
        self.known.update((w, self.older[w]) for w in seen if w in self.older)
        new = [w for w in seen if w not in self.older]
        self.known.update(zip(new, self._whole(new)))
        return [
            self._whole([text])[0] if own is None else b"".join(map(self.known.__getitem__, own))
            for text, own in zip(texts, words)
        ]


def encoder_of(path: str, pattern: str, known_words: int = KNOWN_WORDS) -> WordEncoder:
    return worker_table(("words", path, pattern, known_words), lambda: WordEncoder(path, pattern, known_words))


def assign(lengths: list[int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) of every piece; items are shorter than ``size``.

    There are as many sequences as the tokens need at least.
    """
    count = -(-sum(lengths) // size)
    room, cost = np.full(count, size, dtype=np.int64), np.zeros(count)
    queue = [(-n, item, 0) for item, n in enumerate(lengths)]
    heapq.heapify(queue)
    pieces = []
    while queue:
        n, item, start = heapq.heappop(queue)
        n = -n
        fits = np.where(room >= n, cost, np.inf)
        to = int(fits.argmin())
        if fits[to] == np.inf:  # cut it where there is most room
            to = int(room.argmax())
            taken = int(room[to])
            heapq.heappush(queue, (taken - n, item, start + taken))
            n = taken
        pieces.append((item, start, n, to, int(size - room[to])))
        room[to] -= n
        cost[to] += LINEAR * n + QUADRATIC * n * n
    return pieces


def pack_documents(docs: DataFrame, tokenizer_path: str, pattern: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit integers in one binary value. A
    document's tokens end with ``END_ID``; a null or empty text has that one
    alone. Equal rows are packed each for itself and a null doc_id stays null.
    Other columns are ignored. Sequence ids are unique, not consecutive.
    ``known_words`` bounds a worker's memory; ids do not depend on it.
    """

    def pack(batches):
        encoder = encoder_of(tokenizer_path, pattern, known_words)
        next_id = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        held: list[tuple] = []  # doc_id, ids, tokens before them, tokens of the document
        held_tokens = 0

        def place() -> Iterator[tuple]:
            pieces = assign([len(ids) // 4 for _, ids, _, _ in held])
            for item, start, n, to, offset in pieces:
                doc_id, ids, before, all_tokens = held[item]
                yield doc_id, before + start, n, ids[4 * start : 4 * (start + n)], all_tokens, next_id + to, offset

        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts)):
                    ids += END_ID.to_bytes(4, "little")
                    n = len(ids) // 4
                    full = n - n % SEQUENCE
                    for start in range(0, full, SEQUENCE):  # a sequence of its own
                        cut = ids[4 * start : 4 * (start + SEQUENCE)]
                        rows.append((doc_id, start, SEQUENCE, cut, n, next_id, 0))
                        next_id += 1
                    if full < n:
                        held.append((doc_id, ids[4 * full :], full, n))
                        held_tokens += n - full
                if held_tokens >= GROUP_TOKENS:
                    rows += place()
                    next_id += -(-held_tokens // SEQUENCE)
                    held, held_tokens = [], 0
                if rows:
                    yield _batch(rows)
                    rows = []
        if held:
            yield _batch(list(place()))

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(pack, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
