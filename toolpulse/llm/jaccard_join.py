"""Exact join of similar documents on sets of word n-grams, by a token-group matrix.

1. Every document becomes a sorted set of hashed shingles. Documents of equal
   sets are one class from here on.
2. A set is cut into segments of the hash range, so many that linked sets agree
   in whole segments. Only classes that share a segment with another class go on
   (candidates). Small sets announce one segment more than a link can differ in;
   of large ones a fixed part of the range is enough: a link at the very
   threshold then has no common segment with probability ``MISS`` at most.
3. Shingles get a global order, rarest first. A class with so many shingles of
   its own that no link is possible leaves. Each remaining class is compared
   with the most central class that it shares most segments with; those that
   link form groups of similar documents.
4. The matrix: for each (group, set size), the union of its members' leading
   shingles with the greatest overlap that still lies behind each. Two groups
   qualify only if a shared leading shingle leaves room for the overlap a link needs.
5. Qualifying groups are opened in blocks: a member's overlap with the block's
   token union bounds its overlap with every member, and only beyond that bound
   are the members' own overlaps counted. One link found joins two groups.

Steps 3 to 5 are exact: no link between different groups is lost, and inside a
group all are connected already.
"""

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from toolpulse.llm.common import components, salted_join, slices
from toolpulse.llm.embedding_dups import _mix as mix
from toolpulse.llm.embedding_dups import _runs as runs
from toolpulse.sources.durable import materialise

BLOCK_TOKENS = 100_000
MISS = 1e-10
LEAST_PER_SEGMENT = 3  # shingles; fewer tell little
CLASS = ["fp1", "fp2"]


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; a link needs 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    def least_overlap(self, total):
        """Least intersection of two linked sets whose sizes sum to ``total``."""
        return -(-self.percent * total // (100 + self.percent))

    def least_overlap_sql(self, total: str) -> str:
        return f"CAST(ceil({self.percent} * ({total}) / {100 + self.percent}.0D) AS long)"

    @cached_property
    def size_classes(self) -> np.ndarray:
        """Upper ends of size ranges such that linked sets lie in one range or two neighbours."""
        ends, low = [], 1
        while low < 2**40:
            ends.append(100 * low // self.percent)
            low = ends[-1] + 1
        return np.array(ends)

    def segments(self, size_class: int) -> tuple[int, int, int]:
        """Segments of a size range, how many of them are used, and how many empty ones a set may leave out."""
        high = int(self.size_classes[size_class])
        low = int(self.size_classes[size_class - 1]) + 1 if size_class else 1
        most_different = 2 * high * (100 - self.percent) // (100 + self.percent)
        if most_different == 0:
            return 1, 1, 0
        expected = (most_different + 1) * math.exp(-low / (most_different + 1))
        spare = math.ceil(expected + 4 * math.sqrt(expected)) + 1
        all_of = most_different + 1 + spare
        count = min(2 * most_different, max(most_different, low // LEAST_PER_SEGMENT))
        alike = (1 - 1 / count) ** most_different - (1 - 1 / count) ** low if count > 1 else 0
        used = math.ceil(math.log(MISS) / math.log(1 - alike)) if 0 < alike < 1 else all_of
        return (count, used, used) if used < min(count, all_of) else (all_of, all_of, spare)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, one without words none."""
    parts = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    width = min(words, len(parts))
    total = np.full(len(parts) - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        total = mix(total ^ hashes[i : len(parts) - width + 1 + i]) + np.uint64(0x9E3779B97F4A7C15)
    return np.unique(total)


_bounds: dict[int, np.ndarray] = {}


def segment_keys(tokens: np.ndarray, similarity: Similarity) -> np.ndarray:
    """Keys of a set's segments; linked different sets share one."""
    out = []
    mixed = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(tokens + np.uint64(1)), dtype=np.uint64)])
    own = int(np.searchsorted(similarity.size_classes, len(tokens)))
    for size_class in (own, own + 1):
        count, used, spare = similarity.segments(size_class)
        if count == 1:
            continue  # only equal sets link
        if count not in _bounds:
            _bounds[count] = np.array([(i << 64) // count for i in range(1, count)], dtype=np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(tokens, _bounds[count][:used]), [len(tokens)]])[: used + 1].astype(np.int64)
        keys = mix((mixed[cuts[1:]] - mixed[cuts[:-1]]) ^ mix(np.arange(used, dtype=np.uint64) + np.uint64(size_class << 32)))
        empty = cuts[1:] == cuts[:-1]
        out.append(keys if empty.sum() > spare else keys[~empty])
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def _long_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _fingerprints(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """doc_id, n, fp1, fp2 and segment keys; the fingerprint is of the set."""

    def read(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingle_set(t, similarity.words) for t in part.column("text").to_pylist()]
                sums = np.array([[mix(s).sum(dtype=np.uint64), mix(~s).sum(dtype=np.uint64)] for s in sets], dtype=np.uint64)
                columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64())]
                columns += [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in sums.T]
                columns.append(_long_lists([segment_keys(s, similarity) if len(s) else s for s in sets]))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "fp1", "fp2", "keys"])

    return docs.mapInArrow(read, "doc_id long, n long, fp1 long, fp2 long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """rep, n and tokens of the documents (rep) in ``wanted``."""

    def read(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingle_set(t, words) for t in part.column("text").to_pylist()]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, _long_lists(sets)], names=["rep", "n", "tokens"])

    found = docs.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    read_sets = found.mapInArrow(read, "rep long, n long, tokens array<long>")
    return read_sets.join(wanted, ["rep", "n"]).dropDuplicates(["rep", "n"])


def _ordered(sets: DataFrame, similarity: Similarity) -> DataFrame:
    """rep, n, ``own``, the number of shingles no other candidate has, and ``shared``, the others, rarest first.

    Overlaps with other classes lie in ``shared`` alone.
    """
    rows = sets.select("rep", "n", F.explode("tokens").alias("token"))
    common = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = rows.join(common, "token").groupBy("rep", "n")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    alive = ranked.where(100 * F.size("shared") >= similarity.percent * F.col("n"))
    return alive.select("rep", "n", (F.col("n") - F.size("shared")).alias("own"), F.col("shared.token").alias("shared"))


def _overlaps(left: Column, right: Column, total: Column, similarity: Similarity) -> Column:
    overlap = F.size(F.array_intersect(left, right))
    return overlap * (100 + similarity.percent) >= similarity.percent * total


def _leader_links(alive: DataFrame, keyed: DataFrame, similarity: Similarity) -> DataFrame:
    """(a, b): links to the class that a class shares most segments with, among the most central ones of those."""
    rows = keyed.join(alive.select("rep", "own"), "rep")
    central = rows.groupBy("key").agg(F.min(F.struct("own", "rep")).alias("leader"))
    near = rows.join(central, "key").where(F.col("leader.rep") != F.col("rep"))
    counted = near.groupBy("rep", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("rep").agg(F.max(F.struct("n", -F.col("leader.own"), F.col("leader.rep").alias("leader"))).alias("best"))
    pairs = alive.select("rep", "n", "shared").join(best.select("rep", F.col("best.leader").alias("leader")), "rep")
    leaders = alive.select(F.col("rep").alias("leader"), F.col("n").alias("leader_n"), F.col("shared").alias("leader_shared"))
    leaders = leaders.join(best.select(F.col("best.leader").alias("leader")).distinct(), "leader", "left_semi")
    linked = _overlaps(F.col("shared"), F.col("leader_shared"), F.col("n") + F.col("leader_n"), similarity)
    return pairs.join(leaders, "leader").where(linked).select(F.col("rep").alias("a"), F.col("leader").alias("b"))


def _qualifying(grouped: DataFrame, similarity: Similarity) -> DataFrame:
    """(g1, n1, g2, n2): pairs of sub-groups whose leading shingles leave room for a link."""
    leading = F.col("n") - F.ceil(F.col("n") * similarity.percent / F.lit(100.0)) + 1 - F.col("own")
    rows = grouped.where(leading > 0).select(
        "group", "n", "own", F.posexplode(F.slice("shared", F.lit(1), leading.cast("int"))).alias("at", "token")
    )
    matrix = rows.groupBy("token", "group", "n").agg(F.max(F.col("n") - F.col("own") - F.col("at")).alias("room"))
    matrix = materialise(matrix, "token-group-matrix")
    left, right = (matrix.select("token", *[F.col(c).alias(f"{c}{i}") for c in ("group", "n", "room")]) for i in (1, 2))
    fits = F.expr(
        f"group1 < group2 AND least(room1, room2) >= {similarity.least_overlap_sql('n1 + n2')}"
        f" AND 100 * n1 >= {similarity.percent} * n2 AND 100 * n2 >= {similarity.percent} * n1"
    )
    return left.join(right, "token").where(fits).select("group1", "n1", "group2", "n2").distinct()


def _opened_links(grouped: DataFrame, pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """(a, b): one link, if there is any, for every pair of blocks of qualifying groups."""
    members = grouped.select("group", "n", "rep", F.col("shared").alias("tokens"))
    sizes = members.groupBy("group", "n").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks"))
    for i in (1, 2):
        named = sizes.select(F.col("group").alias(f"group{i}"), F.col("n").alias(f"n{i}"), F.col("blocks").alias(f"blocks{i}"))
        pairs = pairs.join(named, [f"group{i}", f"n{i}"])
    pairs = materialise(pairs, "qualifying-groups")
    key = ["group1", "n1", "group2", "n2", "block1", "block2"]
    sides = []
    for i, other in ((1, 2), (2, 1)):
        own = members.select(F.col("group").alias(f"group{i}"), F.col("n").alias(f"n{i}"), "rep", "tokens")
        side = pairs.join(own, [f"group{i}", f"n{i}"])
        side = side.withColumn(f"block{i}", F.pmod(F.xxhash64("rep"), F.col(f"blocks{i}")).cast("int"))
        side = side.withColumn(f"block{other}", F.explode(F.sequence(F.lit(0), F.col(f"blocks{other}") - 1)))
        sides.append(side.select(*key, F.lit(i).alias("side"), "rep", "tokens"))

    def open_blocks(batches):
        for run in runs(batches, len(key)):
            link = _first_link(run, similarity)
            if link:
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in link], names=["a", "b"])

    dealt = sides[0].union(sides[1]).repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(open_blocks, "a long, b long")


def _first_link(run: pa.Table, similarity: Similarity) -> tuple[int, int] | None:
    side, rep = run.column("side").to_numpy(), run.column("rep").to_numpy()
    lists = run.column("tokens").combine_chunks()
    values, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    sets = [values[a:b] for a, b in zip(offsets, offsets[1:])]
    members, queries = np.flatnonzero(side == 2), np.flatnonzero(side == 1)
    if not len(members) or not len(queries):
        return None
    # The union in order, with the members that hold each of its tokens.
    tokens = np.concatenate([sets[m] for m in members])
    holder = np.repeat(np.arange(len(members)), [len(sets[m]) for m in members])
    order = np.argsort(tokens, kind="stable")
    tokens, holder = tokens[order], holder[order]
    union = np.unique(tokens)
    needed = similarity.least_overlap(sum(run.column(c)[0].as_py() for c in ("n1", "n2")))
    for q in queries:
        at = np.searchsorted(union, sets[q])
        hit = sets[q][(at < len(union)) & (union[np.minimum(at, len(union) - 1)] == sets[q])]
        if len(hit) < needed:
            continue
        low, high = np.searchsorted(tokens, hit), np.searchsorted(tokens, hit, side="right")
        places = np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low) + np.arange((high - low).sum())
        overlap = np.bincount(holder[places], minlength=len(members))
        best = int(overlap.argmax())
        if overlap[best] >= needed:
            return int(rep[q]), int(rep[members[best]])
    return None


def similar_documents(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of (doc_id, text).

    A null, empty or blank text has no shingles and links with nothing, not even
    with its like. Ids are meant to be unique: rows that share one are one node
    of the components. A row with a null doc_id takes no part and has a null
    component. Texts of any length are used whole; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = materialise(_fingerprints(texts, similarity), "shingle-marks")
    filled = marks.where("n > 0 AND doc_id IS NOT NULL")
    classes = materialise(
        filled.groupBy(*CLASS).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("n").alias("n")), "classes"
    )
    rows = filled.select("fp1", F.explode("keys").alias("key"))
    # Copies share all keys; a key matters if different sets have it.
    shared = rows.groupBy("key").agg((F.min("fp1") < F.max("fp1")).alias("several")).where("several").select("key")
    keyed = rows.join(materialise(shared, "shared-segments"), "key", "left_semi").distinct()
    keyed = materialise(keyed.join(classes.select("fp1", "rep"), "fp1").select("key", "rep"), "segment-rows")
    wanted = materialise(keyed.select("rep").distinct().join(classes.select("rep", "n"), "rep"), "candidates")
    sets = materialise(_sets(texts, wanted, similarity.words), "shingle-sets")
    alive = materialise(_ordered(sets, similarity), "ordered-sets")
    links = materialise(_leader_links(alive, keyed, similarity), "leader-links")
    grouped = alive.join(components(links), F.col("rep") == F.col("node"), "left")
    grouped = grouped.withColumn("group", F.coalesce("component", "rep")).drop("node", "component")
    opened = materialise(_opened_links(grouped, _qualifying(grouped, similarity), similarity), "opened-links")
    found = components(links.union(opened))
    named = classes.join(found, F.col("rep") == F.col("node"), "left").withColumn("component_id", F.coalesce("component", "rep"))
    named = named.where("copies > 1 OR component_id <> rep").select(*CLASS, "component_id")
    named = named.withColumn("filled", F.lit(True))
    marks = marks.drop("keys").withColumn("filled", F.col("n") > 0)
    named = salted_join(marks, named, [*CLASS, "filled"], F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def similar_documents_sql(words: int, percent: int, docs: str = "documents") -> str:
    """The same by counting all shared shingles, in DuckDB SQL; ``docs`` has unique ids."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM {docs}),
      s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i : i + {words - 1}], ' ') FOR i IN range(1, len(w) - {words - 2})] END) AS s FROM w),
      n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
      p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
      l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
        WHERE 100 * common >= {percent} * (x.n + y.n - common)),
      reach AS (SELECT doc_id, doc_id AS other FROM {docs} UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON l.a = r.other),
      c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
      SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)"""
