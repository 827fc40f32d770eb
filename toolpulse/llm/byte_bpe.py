"""Byte-level BPE by replaying merges over many words at once.

A task takes the distinct pre-tokens of a slice of the corpus as one list of
byte tokens, with an inverted index from token pair to the positions that hold
it. Merges apply in rank order to all positions of a pair, and only the pairs
of touched neighbours enter the index. Encoded words stay in a bounded table of
the Python worker, so a word costs one replay and then one look-up.

No row is shuffled: any partitioning of the documents gives the same result.
"""

import base64
import heapq
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame

from toolpulse.llm.common import slices, worker_table
from toolpulse.llm.pretokens import splitter

KNOWN_WORDS = 800_000  # encoded words a Python worker keeps; beyond, it starts anew


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Encodes lists of byte strings; ids are the ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        self.known: dict[str, bytes] = {}

    def rank_of(self, left: int, right: int) -> int:
        """Rank of two neighbours' merge, -1 if there is none."""
        pair = (left, right)
        rank = self.merged.get(pair)
        if rank is None:
            rank = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], -1)
            if len(self.merged) > 500_000:
                self.merged.clear()
            self.merged[pair] = rank
        return rank

    def replay(self, words: list[bytes]) -> list[list[int]]:
        tokens: list[int] = []
        starts = [0]
        for word in words:
            tokens += map(self.byte_ids.__getitem__, word)
            starts.append(len(tokens))
        size = len(tokens)
        right, left = list(range(1, size + 1)), list(range(-1, size - 1))
        word_of = array("l", bytes(8 * size))
        for w, (a, b) in enumerate(zip(starts, starts[1:])):
            if b > a:
                right[b - 1] = left[a] = -1
                word_of[a:b] = array("l", [w]) * (b - a)
        index: dict[int, list[int]] = {}
        rank_of = self.rank_of
        for p, q in enumerate(right):
            if q >= 0 and (rank := rank_of(tokens[p], tokens[q])) >= 0:
                index.setdefault(rank, []).append(p)
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            positions = index.pop(rank)
            positions.sort()
            # A word where a merge made a pair of lower rank waits for that pair.
            waiting: set[int] = set()
            for p in positions:
                q = right[p] if tokens[p] >= 0 else -1
                if q < 0 or rank_of(tokens[p], tokens[q]) != rank:
                    continue
                if waiting and word_of[p] in waiting:
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(heap, rank)
                    index[rank].append(p)
                    continue
                tokens[p], tokens[q] = rank, -1
                after = right[p] = right[q]
                if after >= 0:
                    left[after] = p
                for a, b in ((left[p], p), (p, after)):
                    if a < 0 or b < 0:
                        continue
                    new = rank_of(tokens[a], tokens[b])
                    if new < 0:
                        continue
                    if new not in index:
                        index[new] = []
                        heapq.heappush(heap, new)
                    index[new].append(a)
                    if new < rank:
                        waiting.add(word_of[p])
        return [[t for t in tokens[a:b] if t >= 0] for a, b in zip(starts, starts[1:])]

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = list(words)
        rest = []
        for word in new:
            rank = self.ranks.get(word.encode("utf-8", "replace"))
            if rank is None:
                rest.append(word)
            else:
                self.known[word] = array("I", [rank]).tobytes()
        for word, ids in zip(rest, self.replay([w.encode("utf-8", "replace") for w in rest])):
            self.known[word] = array("I", ids).tobytes()

    def encode(self, texts: list[str], pattern: str) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        pieces = [splitter(pattern)(text) for text in texts]
        self.learn(set().union(*pieces))
        return [b"".join(map(self.known.__getitem__, words)) for words in pieces]

    def decode(self, ids: bytes) -> bytes:
        numbers = array("I")
        numbers.frombytes(ids)
        return b"".join(map(self.bytes_of.__getitem__, numbers))


def replay_of(path: str) -> MergeReplay:
    return worker_table(("ranks", path), lambda: MergeReplay(read_ranks(path)))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """doc_id and ``ids``, the text's ids as little-endian unsigned 32-bit integers in one binary value.

    With ``decoded`` also the bytes that these ids stand for. A null or empty
    text has no ids. Rows stay rows, repeated and null doc_ids included; other
    columns are ignored. ``ranks_path`` is a file at that path on every node.
    """

    def encode(batches):
        replay = replay_of(ranks_path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = replay.encode([t or "" for t in part.column("text").to_pylist()], pattern)
                out = {"doc_id": part.column("doc_id"), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    out["decoded"] = pa.array(map(replay.decode, ids), pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, ids binary" + ", decoded binary" * decoded
    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(encode, schema)
