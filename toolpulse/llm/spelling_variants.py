"""Grouping of spelling variants: words that one inserted, deleted or replaced character apart are near.

Words are compared by dense prefix-suffix tiling. A tile is a padded matrix of
code points, once from the left and once from the right; comparing two tiles
column by column gives the common prefix and suffix lengths of all their row
pairs, and a pair is near if both together reach the longer length minus one.

Which tiles meet follows from the same rule: of a near pair, prefix or suffix
covers half of what the longer word has besides the edit. So a word enters one
group by its left half and one by its right half, for its own length and for
the next, and only rows of a group are compared. A group of more than
``LIMIT`` words is split by the halves of what its words do not share, again
and again; at the end a group is the words that differ in one place only, no
more than the alphabet is long. No group is capped and none goes through one
task as a whole: tiles of at most ``TILE`` rows are compared two at a time.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolpulse.llm.common import UPPER, LOWER, slices
from toolpulse.sources.durable import materialise

MIN_LENGTH, MIN_COUNT = 5, 3
LIMIT = 4096
TILE = 192
TILE_CELLS = 1 << 22
WORDS_AT_ONCE = 300_000
# Letters of the Latin-1 range and the signs between them; one byte each in that encoding.
_runs = re.compile("[A-Za-zÀ-ÿ]+").findall
_lower = str.maketrans(UPPER, LOWER)


def word_counts(docs: DataFrame, delete_every: int | None = None) -> DataFrame:
    """(word, n) of all runs of letters, A-Z lower-cased; null texts have none.

    With ``delete_every`` a run loses the code point ``h % length`` where
    ``delete_every`` divides h, the crc32 of ``<doc_id>:<run>`` (no id: empty).
    """

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    own = Counter(_runs((text or "").translate(_lower)))
                    if delete_every:
                        own = _damaged(own, doc_id, delete_every)
                    held.update(own)
                if len(held) > WORDS_AT_ONCE:
                    yield _word_rows(held)
                    held = Counter()
        if held:
            yield _word_rows(held)

    rows = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _damaged(runs: Counter, doc_id: int | None, every: int) -> Counter:
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    hit = [(run, h) for run in runs if (h := zlib.crc32(run.encode(), start)) % every == 0]
    moved = [(run, h % len(run), runs.pop(run)) for run, h in hit]
    for run, at, n in moved:
        runs[run[:at] + run[at + 1 :]] += n
    return runs


def _word_rows(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})


# --- groups ---------------------------------------------------------------------------


def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice: once beside those with the same left half of what is open, once by the right half.

    Of a word, ``lo`` characters from the left and ``hi`` from the right are
    shared by its group; ``open`` is the longer length without them. A pair
    is looked for where its common prefix is at least ``lo`` and below ``below``.
    """
    half = F.floor(F.col("open") / 2).cast("int")
    left = F.struct(
        (F.col("lo") + half).alias("lo"), F.col("hi"), F.col("below"), (F.col("open") - half).alias("open"),
        F.expr("left(word, lo + open div 2)").alias("head"), F.col("tail"),
    )
    right = F.struct(
        F.col("lo"), (F.col("hi") + half).alias("hi"), F.least("below", F.col("lo") + half).alias("below"),
        (F.col("open") - half).alias("open"), F.col("head"), F.expr("right(word, hi + open div 2)").alias("tail"),
    )
    cut = rows.withColumn("part", F.explode(F.array(left, right)))
    return cut.select("word", "n", "longer", "part.*")


GROUP = ["longer", "lo", "hi", "below", "head", "tail"]


def grouped(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Rows of words in groups of at most ``limit``, or of words that differ in one place only."""
    length = F.length("word")
    rows = words.withColumn("longer", F.explode(F.array(length, length + 1)))
    start = rows.select(
        "word", "n", "longer", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.col("longer").alias("below"),
        F.col("longer").alias("open"), F.lit("").alias("head"), F.lit("").alias("tail"),
    )
    level = _halved(start)
    done = None
    while True:
        large = level.where("open > 1").groupBy(*GROUP).count().where(F.col("count") > limit).drop("count")
        large = materialise(large, "large-groups")
        if large.isEmpty():
            return level if done is None else done.unionByName(level)
        level = materialise(level, "spelling-groups")
        fit = level.join(large, GROUP, "left_anti")
        done = fit if done is None else done.unionByName(fit)
        level = _halved(level.join(large, GROUP, "left_semi"))


# --- tiles ----------------------------------------------------------------------------


def _matrix(words: list[bytes], width: int) -> np.ndarray:
    """One row per word, padded with zeros, stored by column."""
    return np.ascontiguousarray(np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width).T)


def _common(a: np.ndarray, b: np.ndarray, longest: int) -> np.ndarray:
    """Length of the common start of every row pair."""
    alive = np.ones((a.shape[1], b.shape[1]), dtype=bool)
    total = np.zeros(alive.shape, dtype=np.int32)
    for i in range(min(a.shape[0], b.shape[0], longest)):
        alive &= a[i][:, None] == b[i][None, :]
        total += alive
        if not i % 8 and not alive.any():
            break
    return total


class Tile:
    """Rows of one partition in group order: words, counts, and what their group asks of a pair."""

    def __init__(self, words: list[str], n: np.ndarray, kinds: np.ndarray):
        self.words, self.n, self.kinds = words, n, kinds
        encoded = [w.encode("latin-1") for w in words]
        width = max(map(len, encoded))
        self.size = np.array([len(w) for w in encoded])
        self.forward, self.backward = _matrix(encoded, width), _matrix([w[::-1] for w in encoded], width)

    def near(self, other: "Tile") -> np.ndarray:
        """Row pairs that are one edit apart and belong to one group, as an array of two columns."""
        shorter, longer = np.minimum.outer(self.size, other.size), np.maximum.outer(self.size, other.size)
        most = int(shorter.max())
        prefix = np.minimum(_common(self.forward, other.forward, most), shorter)
        suffix = np.minimum(_common(self.backward, other.backward, most), shorter)
        hit = (prefix + suffix >= longer - 1) & (longer == self.kinds[0][:, None])
        hit &= (prefix >= self.kinds[1][:, None]) & (prefix < self.kinds[3][:, None])
        for kind, others in zip(self.kinds, other.kinds):
            hit &= kind[:, None] == others[None, :]
        hit &= (prefix < shorter) | (self.size[:, None] != other.size[None, :])  # not the word itself
        return np.argwhere(hit)


def near_words(groups: DataFrame, limit: int = TILE) -> DataFrame:
    """(word, near, near_n): both directions of every near pair, each once."""

    def compare(batches):
        for rows in _whole_groups(batches, limit):
            ends = list(_tile_ends([len(w) for w in rows[0]], limit))
            tiles = [Tile(rows[0][a:b], rows[1][a:b], rows[2][:, a:b]) for a, b in zip([0, *ends], ends)]
            for i, left in enumerate(tiles):
                for right in tiles[i:]:
                    found = left.near(right)
                    if len(found):
                        yield _near_rows(left, right, found[:, 0], found[:, 1])
                        if right is not left:
                            yield _near_rows(right, left, found[:, 1], found[:, 0])

    kinds = ["longer", "lo", "hi", "below"]
    dealt = groups.repartition(*[F.col(c) for c in GROUP]).sortWithinPartitions(*GROUP)
    key = F.concat_ws("\u0001", *GROUP).alias("key")
    return dealt.select("word", "n", *[F.col(c).cast("long").alias(c) for c in kinds], key).mapInArrow(
        compare, "word string, near string, near_n long"
    )


def _near_rows(left: Tile, right: Tile, at: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
    words, near = [left.words[i] for i in at.tolist()], [right.words[j] for j in to.tolist()]
    columns = [pa.array(words, pa.string()), pa.array(near, pa.string()), pa.array(right.n[to], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "near", "near_n"])


def _tile_ends(lengths: list[int], limit: int):
    start = width = 0
    for i, size in enumerate(lengths):
        grown = max(width, size)
        if i > start and (i - start >= limit or (i - start + 1) * grown > TILE_CELLS):
            yield i
            start, grown = i, size
        width = grown
    if lengths:
        yield len(lengths)


def _whole_groups(batches, limit: int):
    """Runs of whole groups, about ``limit`` rows together, or one larger group."""
    words, n, kinds, keys = [], [], [], []

    def taken(upto):
        table = np.concatenate(kinds, axis=1) if len(kinds) > 1 else kinds[0]
        amounts = np.concatenate(n) if len(n) > 1 else n[0]
        out = words[:upto], amounts[:upto], table[:, :upto]
        words[:], keys[:] = words[upto:], keys[upto:]
        n[:], kinds[:] = [amounts[upto:]], [table[:, upto:]]
        return out

    for batch in batches:
        words += batch.column(0).to_pylist()
        n.append(batch.column(1).to_numpy())
        kinds.append(np.stack([batch.column(c).to_numpy() for c in range(2, 6)]))
        keys += batch.column(6).to_pylist()
        cuts, start, last = [], 0, len(keys) - 1
        changes = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]  # the last group may go on
        for i, change in enumerate(changes):
            after = changes[i + 1] if i + 1 < len(changes) else last + 1
            if after - start > limit:
                cuts.append(change - start)
                start = change
        for size in cuts:
            yield taken(size)
    if words:
        yield taken(len(words))


# --- forms ----------------------------------------------------------------------------


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, delete_every: int | None = None, limit: int = LIMIT
) -> DataFrame:
    """One row per frequent word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: smallest in code-point order)
    if it is at least twice as frequent, ``root`` the last of the chain of
    forms. Repeated rows count each; null ids and other columns do no harm. No
    text gives no rows.
    """
    counts = word_counts(docs, delete_every).where((F.col("n") >= min_count) & (F.length("word") >= min_length))
    words = materialise(counts, "words")
    near = near_words(grouped(words, limit))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    strong = -F.col("best.m") >= 2 * F.col("n")
    forms = materialise(
        found.select(
            "word", F.when(strong, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, -F.col("best.m")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    out = forms.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """The end of every chain. Frequencies double along a chain, so it is short; each round doubles the step."""
    links = materialise(links, "roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(ahead, "root", "left")
        moved = materialise(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


# --- SQL ------------------------------------------------------------------------------


def crc_table() -> list[int]:
    """The table of the usual reflected CRC-32."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def variants_sql(delete_every: int, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> str:
    """The same rows in DuckDB: near words share a word without one character."""
    return rf"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS times
        FROM (SELECT row_number() OVER () AS row_no, doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
        GROUP BY ALL),
    hashed AS (
        SELECT run, times, xor(list_reduce(
            list_transform(range(0, octet_length(encode(key)), 1), lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::BIGINT),
            lambda h, b: xor(h >> 8, {crc_table()}[1 + (xor(h, b) & 255)]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
        FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs)),
    damaged AS (
        SELECT CASE WHEN h % {delete_every} = 0
            THEN left(run, h % len(run)) || substr(run, (h % len(run) + 2)::BIGINT) ELSE run END AS word, times FROM hashed),
    words AS (
        SELECT word, sum(times)::BIGINT AS n FROM damaged GROUP BY word
        HAVING sum(times) >= {min_count} AND len(word) >= {min_length}),
    without AS (
        SELECT word, n, place, left(word, place) || substr(word, place + 2) AS rest
        FROM (SELECT word, n, unnest(range(0, len(word), 1)) AS place FROM words)),
    pairs AS (
        SELECT a.word, b.word AS near, b.n AS near_n FROM without a JOIN without b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word),
    best AS (
        SELECT word, count(*)::BIGINT AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
    forms AS (
        SELECT word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
            CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
        FROM words LEFT JOIN best USING (word)),
    chain AS (
        SELECT word, word AS root, 0 AS step FROM forms
        UNION ALL SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL)
    SELECT word, form, (SELECT arg_max(root, step) FROM chain c WHERE c.word = forms.word) AS root, n, n_near, form_n FROM forms"""
