"""Secret scan: candidate strings, judged by a random forest.

Candidates are long runs of key-like characters and the values of assignments,
quoted or not. The forest sees a candidate's length, its character transitions,
how much of it a dictionary covers, what is path-like about it, and the words
next to it. It is trained on labelled findings, a bounded sample; the dictionary
is counted over all texts.
"""

import math
import re
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolpulse.llm.common import slices
from toolpulse.sources.durable import materialise

MAX_LABELLED = 20_000  # labelled findings of each label that the forest learns from
WORD_SHARE = 5e-6  # a dictionary word's least share of all words: 200,000 words at most
PAIR_SHARE = 1e-4  # a known letter pair's least share of all pairs
AROUND = 48  # characters before and after that give the neighbouring words
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5

_RUN = re.compile(r"(?<![A-Za-z0-9+/_.\-])[A-Za-z0-9+/_.\-]{16,}={0,2}")
_GIVEN = r""">?\s{0,3}(?:["']?(?:bearer|basic|token)\s{1,3})?"""  # between a name and its value
_QUOTED = re.compile(rf"""[:=]{_GIVEN}(?:"([^"\s]{{8,}})"|'([^'\s]{{8,}})')""", re.I)
# Behind a name, its closing quote and blanks. A separator ends the value only where the next name or a blank follows.
_NAMED = r"""[:=](?:(?<=\w.)|(?<=\w["'\]\s].)|(?<=\w["'\]\s]\s.)|(?<=\w["'\]\s]\s\s.))"""
_BARE = re.compile(rf"""{_NAMED}{_GIVEN}(?!//)((?:[^\s"'`<>,;&?]|[,;&?](?!\s|$|[\w.%\-]+=)){{8,}})""", re.I)
_QUERY = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*://[^?]*\?[\w.%\-]+=")
_WORD = re.compile(r"[^\W\d_]+")
_HUMP = re.compile(r"([a-z0-9])([A-Z])")
KEY_WORDS = frozenset("token secret password passwd pwd key apikey auth authorization bearer credential credentials private".split())
HASH_WORDS = frozenset("sha sha1 sha256 md5 hash commit checksum digest uuid guid revision version id integrity".split())
FEATURES = [
    "length", "log_length", "transitions", "vowel_turns", "entropy", "letter_flow", "digits", "capitals", "hex_only",
    "dictionary", "slashes", "dots", "extension", "key_before", "hash_before", "assigned", "quoted", "words_around",
    "known_format",
]
# Keys that their issuers give a shape of their own; for Python and Java.
KNOWN = "|".join([
    r"(?:AKIA|ASIA)[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36,}", r"github_pat_\w{22,}", r"glpat-[\w-]{20,}", r"xox[abprs]-[\w-]{10,}",
    r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", r"AIza[\w-]{35}", r"eyJ[\w-]+\.eyJ[\w-]+\.[\w-]*", r"SG\.[\w-]{16,}\.[\w-]{16,}",
])
_KNOWN = re.compile(KNOWN, re.A)
_ASSIGNS = re.compile(r"""[:=]>?[\s"']*(?:(?:bearer|basic|token)\s+)?["']?$""", re.I)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidates of a text in order, none inside another."""
    spans = {m.span() for m in _RUN.finditer(text) if _mixed(m.group())}
    # A quoted url with a query is judged by its parts, so that it does not hide the values in it.
    spans |= {m.span(m.lastindex) for m in _QUOTED.finditer(text) if not _QUERY.match(m.group(m.lastindex))}
    spans |= {s for m in _BARE.finditer(text) if (s := _unclosed(text, *m.span(1)))[1] - s[0] >= 8}
    kept: list[tuple[int, int]] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not kept or span[0] >= kept[-1][1]:
            kept.append(span)
    return kept


def _unclosed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without a full stop or brackets at its end that it does not open."""
    loose = ".:!" if any(c in text[start:end] for c in "([{") else ".:!)]}"
    while end > start and text[end - 1] in loose:
        end -= 1
    return start, end


def _mixed(run: str) -> bool:
    return any(c.isdigit() for c in run) or bool(re.search("[a-z][A-Z]", run))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


class Dictionary:
    """Frequent words and letter pairs."""

    def __init__(self, words: Iterable[str], pairs: Iterable[str]):
        self.words, self.pairs = set(words), {tuple(p) for p in pairs}
        sizes: dict[str, set[int]] = {}
        for w in self.words:
            sizes.setdefault(w[:3], set()).add(len(w))
        self.sizes = {start: sorted(n, reverse=True) for start, n in sizes.items()}  # by the first three letters

    def coverage(self, value: str) -> float:
        """Share of the characters inside dictionary words, taken longest first from the left."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            size = next((n for n in self.sizes.get(low[at : at + 3], ()) if at + n <= len(low) and low[at : at + n] in self.words), 0)
            covered += size
            at += size or 1
        return covered / max(len(low), 1)

    def letter_flow(self, value: str) -> float:
        """Share of neighbouring characters that are a known letter pair."""
        low = value.lower()
        return sum(p in self.pairs for p in zip(low, low[1:])) / max(len(low) - 1, 1)


def features(value: str, before: str, after: str, words: Dictionary) -> list[float]:
    size = max(len(value), 1)
    shares = [n / size for n in Counter(value).values()]
    kinds = [_kind(c) for c in value]
    vowels = [c in "aeiou" for c in value.lower()]
    neighbours = re.findall(r"[A-Za-z0-9]+", _HUMP.sub(r"\1 \2", before).lower().replace("_", " "))[-3:]
    near = set(neighbours) | set(re.findall(r"[A-Za-z0-9]+", after.lower())[:1])
    return [
        float(min(len(value), 10_000)),
        math.log1p(len(value)),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / size,
        sum(a != b for a, b in zip(vowels, vowels[1:])) / size,
        -sum(p * math.log2(p) for p in shares),
        words.letter_flow(value),
        kinds.count(2) / size,
        kinds.count(1) / size,
        float(re.fullmatch(r"[0-9a-fA-F-]+", value) is not None),
        words.coverage(value),
        float(value.count("/")),
        float(value.count(".")),
        float(re.search(r"\.[A-Za-z]{2,5}$", value) is not None),
        float(bool(near & KEY_WORDS)),
        float(bool(near & HASH_WORDS)),
        float(_ASSIGNS.search(before) is not None),
        float(before.endswith(('"', "'")) and after.startswith(('"', "'"))),
        float(len(neighbours)),
        float(_KNOWN.fullmatch(value) is not None),
    ]


def count_words(docs: DataFrame) -> Dictionary:
    """The dictionary of all texts: words and letter pairs that are there twice and have their least share."""

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words: Counter[str] = Counter()
                for text in part.column(0).to_pylist():
                    words.update(w for w in _WORD.findall((text or "").lower()) if len(w) > 2)
                yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    counted = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "word-counts")
    places = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = counted.select(F.explode(F.transform(places, lambda i: F.substring("word", i, 2))).alias("pair"), "n")
    pairs = materialise(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")

    def frequent(rows: DataFrame, share: float) -> list[str]:
        least = max(2.0, share * (rows.agg(F.sum("n")).first()[0] or 0))
        return [r[0] for r in rows.where(F.col("n") >= least).collect()]  # at most 1 / share

    return Dictionary(frequent(counted, WORD_SHARE), frequent(pairs, PAIR_SHARE))


_FINDING = "start int, end int, value string, before string, after string"


def find(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Candidates of every text: the columns ``keep``, then start, end, value, before and after."""
    source = docs.select(*[f"`{c}`" for c in keep], F.col("text").alias("__whole_text"))

    def scan(batches):
        for batch in batches:
            for part in slices(batch, "__whole_text"):
                at, rows = [], []
                for i, text in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    for a, b in candidates(text) if text else ():
                        at.append(i)
                        rows.append((a, b, text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND]))
                columns = [c.take(pa.array(at, pa.int64())) for c in part.columns[:-1]]
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
                columns += [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "start", "end", "value", "before", "after"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(scan, f"{own}, {_FINDING}" if own else _FINDING)


def label_by_rule(found: DataFrame) -> DataFrame:
    """Labelled findings from a stated rule, and each assigned secret once more as a mere hash.

    1: a value of a known key format, and one with a digit or a sign that is
    given to a name with a key word, by ':', '=', '=>' or 'Bearer', whether or
    not name and value are quoted. 0: a value behind a hash word; a number,
    plain words or a file or host name with no key word before; and the
    assigned secrets where a hash word stands in place of the key word. The
    rule cannot judge other candidates, and they are left out.
    """
    names = "|".join("auth(?!or(?!i))" if w == "auth" else w for w in sorted(KEY_WORDS))
    quote = r"[\"'\]]?"
    given = rf"(?i)\w*({names})\w*{quote}\s*([:=]+>?\s*[\"']?((bearer|basic|token)\s+)?|(?<=bearer)\s+)[\"']?$"
    hashed = rf"(^|[^a-z])({'|'.join(sorted(HASH_WORDS))})([-_]?[0-9]+)?{quote}\s*([:=]+>?)?\s*[\"']?$"
    value, before = F.col("value"), F.lower("before")
    known = value.rlike(f"^({KNOWN})$")
    # Words alone may be a reference or prose, and a variable or a blank to fill in is no value.
    telling = value.rlike(r"[0-9!@#^*+~]") & ~value.rlike(r"^[$%{<]")
    named = F.col("before").rlike(given)
    harmless = value.rlike(r"^[0-9][0-9.,:/_+-]*$|^\p{L}+([._/-]+\p{L}+)*[._/-]*$|^[\w./~+-]*\.[A-Za-z]{2,5}$")
    label = (
        F.when(known | (named & telling), 1.0)
        .when(~named & (before.rlike(hashed) | (harmless & ~before.rlike(names))), 0.0)
    )
    judged = found.select("value", "before", "after", label.alias("label"), known.alias("known")).where("label IS NOT NULL")
    word = F.element_at(F.array(*map(F.lit, sorted(HASH_WORDS))), F.pmod(F.xxhash64("value"), F.lit(len(HASH_WORDS))).cast("int") + 1)
    renamed = F.concat(F.regexp_replace("before", given, ""), word, F.lit(" "))
    hashes = judged.where("label = 1 AND NOT known").select("value", renamed.alias("before"), F.lit(" ").alias("after"), F.lit(0.0).alias("label"))
    return judged.drop("known").union(hashes)


class Scanner:
    """A trained forest with its dictionary."""

    def __init__(self, words: Dictionary, forest: RandomForestClassificationModel | None, share: float):
        self.words, self.forest, self.share = words, forest, share

    def _with_features(self, found: DataFrame) -> DataFrame:
        shared = found.sparkSession.sparkContext.broadcast(self.words)
        schema = T.StructType([*found.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])

        def describe(batches):
            for batch in batches:
                rows = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("value", "before", "after")))
                described = pa.array([features(*r, shared.value) for r in rows], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, described], names=schema.names)

        return found.mapInArrow(describe, schema).withColumn("features", array_to_vector("features"))

    def score(self, found: DataFrame) -> DataFrame:
        """Adds ``score`` and ``is_secret``."""
        if self.forest is None:
            scored = found.withColumn("score", F.lit(self.share))
        else:
            scored = self.forest.transform(self._with_features(found))
            scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
            scored = scored.drop("features", "rawPrediction", "probability", "prediction")
        return scored.withColumn("is_secret", F.col("score") >= THRESHOLD)


def train(labelled: DataFrame, words: Dictionary) -> Scanner:
    """A scanner from (value, before, after, label); ``MAX_LABELLED`` distinct rows of each label at most, by hash.

    With one label alone there is no forest: every score is that label.
    """
    mixed = labelled.select("value", "before", "after", "label").distinct().withColumn("h", F.xxhash64("value", "before", "after"))
    parts = [mixed.where(F.col("label") == v).orderBy("h", "value", "before", "after").limit(MAX_LABELLED) for v in (0.0, 1.0)]
    sample = materialise(parts[0].union(parts[1]).drop("h"), "labelled-findings")
    rows = sample.select("label").toPandas()  # bounded by the sample
    share = float(rows["label"].mean()) if len(rows) else 0.0
    if share in (0.0, 1.0):
        return Scanner(words, None, share)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64)
    described = materialise(Scanner(words, None, share)._with_features(sample).select("features", "label"), "finding-features")
    return Scanner(words, forest.fit(described), share)


def labelled_part(found: DataFrame) -> DataFrame:
    """The findings of documents to learn from; those of a quarter of the ids, and of null ids, are held out."""
    return found.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per candidate: doc_id (and ``keep``), start, end, value, score, is_secret.

    Offsets count characters of the text. The scanner is trained on the
    documents themselves by ``label_by_rule``, with their dictionary. A null or empty text has no
    candidates; a null doc_id stays null; repeated rows are scanned each.
    """
    keep = ["doc_id", *(keep or [])]
    found = materialise(find(docs, keep), "secret-candidates")
    scanner = train(label_by_rule(labelled_part(found)), count_words(docs))
    return scanner.score(found).select(*keep, "start", "end", "value", "score", "is_secret")


def redact(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """All rows and columns, every secret in ``text`` replaced by ``mark``.

    Equal rows get equal texts; rows without a secret come back as they are.
    """
    columns = docs.columns
    keys = {"__id": F.coalesce("doc_id", F.lit(0)).cast("long"), "__hash": F.xxhash64(F.col("doc_id").isNull(), "text")}
    keyed = docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in columns if c != "text"]).alias("own")).withColumns(keys)
    found = scan(keyed.select("doc_id", "text", *keys), keep=list(keys)).where("is_secret")
    span = F.struct("start", "end").alias("span")
    spans = found.groupBy(*keys).agg(F.sort_array(F.collect_set(span)).alias("spans"))
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def replaced(done, s):
        before = F.substring(F.col("text"), done["at"] + 1, s["start"] - done["at"])
        return F.struct(F.concat(done["out"], before, F.lit(mark)).alias("out"), s["end"].alias("at"))

    clean = F.aggregate("spans", state, replaced, lambda done: F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text"))))
    joined = keyed.join(spans, list(keys), "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(clean)
    return joined.select(*[text.alias("text") if c == "text" else F.col("own")[c].alias(c) for c in columns])
