"""Quality rules: is a text more like the trusted documents than like the raw corpus?

Every n-gram (tokens and pairs of neighbours) is hashed into one of ``BUCKETS``
buckets. Two multinomials over the buckets are counted: one of trusted
documents, one of all documents. A document's score is the mean over its
n-grams of log(trusted / raw). The threshold is where the scores of labelled
documents that the trusted multinomial has not seen part best into good and
bad; every document is compared with it. Weights are whole micro-nats, so sums
do not depend on the order of rows and equal documents get equal verdicts.

Tokens are runs of word characters (ASCII letters and digits, anything beyond
ASCII) or of ASCII punctuation, with A-Z lower-cased.

The fit uses every labelled document, and the raw multinomial and the verdicts
cover all documents. Only the ids of the trusted documents to fit are joined to
the texts, as a written table whose size lets Spark choose the join; the
threshold joins the labels to scores, not to texts.
"""

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolpulse.llm.common import slices
from toolpulse.sources.durable import materialise

BUCKETS = 10_000
PAIR = 1_000_003
MICRO = 1_000_000
BIN = 10_000  # micro-nats of a step of the threshold
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
_tokens = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[!-/:-@\[-`{-~]+").findall


@dataclass(frozen=True)
class BaseRules:
    """Limits that a document must keep whatever its score."""

    min_words: int = 50
    max_repeat_percent: int = 50


class TokenHashes(dict):
    """First 32 bits of the md5 of a token; forgets all when it holds ``limit``."""

    limit = 400_000

    def __missing__(self, token: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = int.from_bytes(hashlib.md5(token).digest()[:4], "big")
        return value


def gram_buckets(text: bytes, hashes: TokenHashes) -> np.ndarray:
    """Buckets of all tokens and of all pairs of neighbours."""
    found = _tokens(text.lower())
    one = np.fromiter(map(hashes.__getitem__, found), dtype=np.int64, count=len(found))
    return np.concatenate((one, one[:-1] * PAIR + one[1:])) % BUCKETS


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    if len(words) < 4:
        return 0
    places: dict[bytes, int] = {}
    codes = np.fromiter((places.setdefault(w, len(places)) for w in words), dtype=np.int64, count=len(words))
    pairs = np.unique(codes[:-1] * len(places) + codes[1:], return_inverse=True)[1]
    _, place, times = np.unique(pairs[:-1] * len(places) + codes[2:], return_inverse=True, return_counts=True)
    twice = times[place] > 1
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(twice)] |= twice
    return int(inside.sum())


def base_counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = data.split()
    blanks = len(data) - len(data.translate(None, BLANK))
    lines = [line for line in data.split(b"\n") if line.strip(BLANK)]
    return (
        len(words),
        len(text) - blanks,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


# --- the model ----------------------------------------------------------------------


@dataclass
class Model:
    """``weights`` in micro-nats per bucket, and the least mean that is kept; None keeps all."""

    weights: np.ndarray
    threshold: int | None = None


def labelled_sample(labels: DataFrame, limit: int | None = None) -> DataFrame:
    """(doc_id, trusted, bad, held_out) of all labelled documents, or of at most ``limit``, those of least hash.

    Trusted are documents of quality 1 that no label calls toxic, bad those with
    a quality of 0. Several labels of a document count together; null ids and
    documents without a quality are left out. Half of the documents, by hash,
    are held out from the multinomials and decide the threshold.
    """
    each = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("low"), F.max("toxic").alias("toxic")
    )
    each = each.where("low IS NOT NULL").select(
        "doc_id",
        F.substring(F.md5(F.col("doc_id").cast("string")), 1, 4).alias("h"),
        ((F.col("low") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("trusted"),
        (F.col("low") == 0).alias("bad"),
    )
    held = F.substring("h", 4, 1) < "8"
    flagged = ["doc_id", "trusted", "bad", held.alias("held_out")]
    if limit is None:
        return each.select(*flagged)
    sizes = sorted((r["h"], r["count"]) for r in each.groupBy("h").count().collect())  # at most 16^4 rows
    total, cut = 0, "g"
    for h, n in sizes:
        total += n
        if total > limit:
            cut = h
            break
    return each.where(F.col("h") < cut).select(*flagged)


def count_grams(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket of all documents and of those with ``fit``; a task sends one vector per kind."""

    def count(batches):
        hashes = TokenHashes()
        sums = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for text, fit in zip(part.column("text").to_pylist(), part.column("fit").to_pylist()):
                    if text:
                        own = np.bincount(gram_buckets(text.encode("utf-8", "replace"), hashes), minlength=BUCKETS)
                        sums[0] += own
                        if fit:
                            sums[1] += own
        for kind in (0, 1):
            used = np.flatnonzero(sums[kind])
            columns = [pa.array(np.full(len(used), kind), pa.int32()), pa.array(used, pa.int32()), pa.array(sums[kind][used])]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "bucket", "n"])

    rows = docs.select("text", "fit").mapInArrow(count, "kind int, bucket int, n long")
    out = np.zeros((2, BUCKETS), dtype=np.int64)
    for r in rows.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect():  # two vectors
        out[r["kind"], r["bucket"]] = r["n"]
    return out[0], out[1]


def gram_weights(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """log(trusted / raw) with one more n-gram in every bucket, in whole micro-nats; 0 without trusted n-grams."""
    if not trusted.sum():
        return np.zeros(BUCKETS, dtype=np.int64)
    ratio = np.log((trusted + 1.0) / (raw + 1.0)) - np.log((trusted.sum() + BUCKETS) / (raw.sum() + float(BUCKETS)))
    return np.rint(ratio * MICRO).astype(np.int64)


def best_threshold(bins: list[tuple[int, int, int]]) -> int | None:
    """Where good and bad documents part best.

    ``bins`` holds (bin of the score, good, bad). A threshold is the lower end
    of a bin, or just beyond the last; it is worth the share of good documents at or above it plus
    the share of bad ones below it, and the lowest of the best is taken.
    Without good or without bad documents there is none.
    """
    good, bad = sum(g for _, g, _ in bins), sum(b for _, _, b in bins)
    if not good or not bad:
        return None
    best, at = -1, None
    above, below = good, 0
    ordered = sorted(bins)
    for step, g, b in [*ordered, (ordered[-1][0] + 1, 0, 0)]:
        worth = above * bad + below * good
        if worth > best:
            best, at = worth, step
        above, below = above - g, below + b
    return at * BIN


def scored(docs: DataFrame, model_weights: np.ndarray) -> DataFrame:
    """Adds the base counts, ``score_sum`` (micro-nats) and ``n_grams`` to the rows' other columns than ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model_weights)
    kept = [c for c in docs.columns if c != "text"]
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score_sum", "n_grams"]

    def measure(batches):
        weights, hashes = shared.value, TokenHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    data = (text or "").encode("utf-8", "replace")
                    grams = gram_buckets(data, hashes)
                    rows.append((*base_counts(text or "", data), int(weights[grams].sum()), len(grams)))
                columns = [part.column(c) for c in kept] + [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names=kept + added)

    source = docs.select(*kept, "text")
    schema = T.StructType(list(source.schema.fields[:-1]) + [T.StructField(n, T.LongType()) for n in added])
    return source.mapInArrow(measure, schema)


def judge_documents(docs: DataFrame, labels: DataFrame, rules: BaseRules = BaseRules(), limit: int | None = None) -> DataFrame:
    """One row per document: its base counts, ``base_failed``, ``score`` and whether it is ``kept``.

    ``labels`` is doc_id, quality, toxic. A null or empty text has no words and
    no score and fails the base rules. Equal rows and null ids are judged each
    for itself; a null id has no label. Labels of ids that ``docs`` lacks are
    ignored, other columns of both tables too. Without labelled good or bad
    documents only the base rules decide.
    """
    known = materialise(labelled_sample(labels, limit), "labels")
    fit = materialise(known.where("trusted AND NOT held_out").select("doc_id"), "fit-ids").withColumn("fit", F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    raw, trusted = count_grams(rows.join(fit, "doc_id", "left"))
    measured = materialise(scored(rows, gram_weights(raw, trusted)), "scores")
    threshold = threshold_of(measured.join(known, "doc_id"), rules) if trusted.sum() else None
    return verdicts(measured, threshold, rules)


def threshold_of(measured: DataFrame, rules: BaseRules) -> int | None:
    """From the held-out documents that the base rules leave to the score."""
    held = measured.where("held_out AND (trusted OR bad) AND n_grams > 0").where(~base_failed(rules))
    step = F.floor(F.floor(F.col("score_sum") / F.col("n_grams")) / BIN)
    bins = held.groupBy(step.alias("step")).agg(F.count_if("trusted").alias("good"), F.count_if("bad").alias("bad"))
    return best_threshold([tuple(r) for r in bins.collect()])  # a score is a few nats: some thousand bins at most


def base_failed(rules: BaseRules) -> Column:
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    return (F.col("n_words") < rules.min_words) | repeats


def verdicts(measured: DataFrame, threshold: int | None, rules: BaseRules) -> DataFrame:
    like = F.lit(True) if threshold is None else F.col("score_sum") >= F.col("n_grams") * F.lit(threshold)
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed(rules).alias("base_failed"),
        (~base_failed(rules) & like).alias("kept"),
        F.try_divide("score_sum", F.col("n_grams") * F.lit(float(MICRO))).alias("score"),
    )


def judge_sql(rules: BaseRules = BaseRules()) -> str:
    """The same rows in DuckDB."""
    failed = f"(n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
    words AS (SELECT row_no, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
    word_at AS (SELECT row_no, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
    windows AS (
        SELECT row_no, pos, word, lead(word, 1) OVER o AS second, lead(word, 2) OVER o AS third
        FROM word_at WINDOW o AS (PARTITION BY row_no ORDER BY pos)),
    twice AS (
        SELECT row_no, pos FROM windows WHERE third IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY row_no, word, second, third) > 1),
    repeats AS (
        SELECT row_no, count(DISTINCT pos + shift) AS n_repeat_words
        FROM twice, (VALUES (0), (1), (2)) AS s(shift) GROUP BY row_no),
    lines AS (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM docs),
    dup AS (
        SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_no),
    base AS (
        SELECT row_no, doc_id, len(w)::BIGINT AS n_words, coalesce(len(array_to_string(w, '')), 0)::BIGINT AS word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
            coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM docs JOIN words USING (row_no) LEFT JOIN dup USING (row_no) LEFT JOIN repeats USING (row_no)),
    tokens AS (
        SELECT row_no, regexp_extract_all({lower}, '[A-Za-z0-9\x{{80}}-\x{{10FFFF}}]+|[!-/:-@\[-`{{-~]+') AS t FROM docs),
    token_at AS (
        SELECT row_no, generate_subscripts(t, 1) AS pos, ('0x' || substr(md5(unnest(t)), 1, 8))::BIGINT AS h FROM tokens),
    grams AS (
        SELECT row_no, h % {BUCKETS} AS bucket FROM token_at
        UNION ALL
        SELECT row_no, (h * {PAIR} + after) % {BUCKETS} FROM (
            SELECT row_no, h, lead(h) OVER (PARTITION BY row_no ORDER BY pos) AS after FROM token_at) WHERE after IS NOT NULL),
    label AS (
        SELECT doc_id, min(quality) = 1 AND coalesce(max(toxic), 0) = 0 AS trusted, min(quality) = 0 AS bad,
            substr(md5(doc_id::VARCHAR), 4, 1) < '8' AS held_out
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) IS NOT NULL),
    counts AS (
        SELECT bucket, count(*) AS raw, count(*) FILTER (WHERE trusted AND NOT held_out) AS trusted
        FROM grams JOIN docs USING (row_no) LEFT JOIN label USING (doc_id) GROUP BY bucket),
    weights AS (
        SELECT bucket, CASE WHEN sum(trusted) OVER () = 0 THEN 0 ELSE round({MICRO} * (ln((trusted + 1.0::DOUBLE) / (raw + 1.0::DOUBLE))
            - ln((sum(trusted) OVER () + {BUCKETS})::DOUBLE / (sum(raw) OVER () + {BUCKETS})::DOUBLE))) END::BIGINT AS weight
        FROM counts),
    sums AS (
        SELECT row_no, sum(weight)::BIGINT AS score_sum, count(*) AS n_grams FROM grams JOIN weights USING (bucket) GROUP BY row_no),
    bins AS (
        SELECT floor(floor(score_sum::DOUBLE / n_grams) / {BIN})::BIGINT AS step,
            count(*) FILTER (WHERE trusted) AS good, count(*) FILTER (WHERE bad) AS bad
        FROM sums JOIN base USING (row_no) JOIN label USING (doc_id)
        WHERE held_out AND (trusted OR bad) AND NOT {failed} GROUP BY step),
    ends AS (SELECT step, good, bad FROM bins UNION ALL SELECT max(step) + 1, 0, 0 FROM bins),
    worth AS (
        SELECT step, sum(good) OVER (ORDER BY step DESC) * sum(bad) OVER ()
            + (sum(bad) OVER (ORDER BY step) - bad) * sum(good) OVER () AS worth,
            sum(good) OVER () AS good, sum(bad) OVER () AS bad
        FROM ends),
    chosen AS (SELECT arg_max(step * {BIN}, (worth, -step)) AS threshold FROM worth WHERE good > 0 AND bad > 0)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        {failed} AS base_failed,
        NOT {failed}
            AND coalesce(score_sum >= n_grams * threshold, true) AS kept,
        score_sum / (n_grams * {float(MICRO)}::DOUBLE) AS score
    FROM base LEFT JOIN sums USING (row_no), chosen"""
