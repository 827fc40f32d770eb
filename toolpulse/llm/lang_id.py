"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword. A linear classifier per bit tells the languages
with a 1 from those with a 0 by log-odds of hashed byte n-grams (one to four
bytes), averaged over the text. Decoding sums, over the bits, a logistic loss of
the bit's margin against the codeword, weighted by the bit's accuracy on the
labelled rows; the codeword of least loss wins, and a small lead over the
second is flagged as ambiguous.

Counts come from all labelled rows; the model has ``BUCKETS`` numbers per
language and per bit, whatever the size of the corpus.
"""

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolpulse.llm.common import slices, worker_table

BUCKETS = 1 << 15
SIZES = (1, 2, 3, 4)
CHUNK = 1 << 20
SMOOTHING = 0.5
MIN_LEAD = 0.05  # share of the total bit weight
UNKNOWN = "und"
# ASCII other than letters is noise for languages and becomes a space.
_LETTERS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))
_ascii_letter = re.compile("[A-Za-z]").search


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ascii_letter(text) is not None or any(map(str.isalpha, text)))


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the whole text."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS) + b" ", dtype=np.uint8)
    total = np.zeros(BUCKETS)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for start in range(0, len(data), CHUNK):
        part = data[start : start + CHUNK + max(SIZES) - 1].astype(np.uint32)
        gram = np.zeros(len(part), dtype=np.uint32)
        for n in SIZES:
            gram = gram[: len(part) - n + 1] | (part[n - 1 :] << np.uint32(8 * (n - 1)))
            own = gram[:CHUNK]
            hashed = (own + np.uint32(n)) * np.uint32(2654435761)
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(2246822519)
            total += np.bincount(hashed >> shift, minlength=BUCKETS)
            if len(part) <= n:
                break
    return total


def codewords(count: int, seed: int = 0) -> np.ndarray:
    """(languages, bits) of +1 and -1, any two rows well apart.

    Up to five languages get the exhaustive code, more the best of some random dense ones.
    """
    if count < 2:
        return np.ones((count, 1))
    if count <= 5:
        columns = [c for c in itertools.product((1, -1), repeat=count) if c[0] == 1 and -1 in c]
        return np.array(columns, dtype=float).T
    random = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(200):
        code = random.choice((-1.0, 1.0), size=(count, math.ceil(10 * math.log2(count))))
        agree = code @ code.T
        np.fill_diagonal(agree, -np.inf)
        distance = (code.shape[1] - agree.max()) / 2
        if distance > apart and (abs(code.sum(0)) < count).all():
            best, apart = code, distance
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # (buckets, bits)
    scale: np.ndarray  # mean size of the margin per bit
    trust: np.ndarray  # weight of a bit's loss

    def margins(self, counts: np.ndarray) -> np.ndarray:
        sums = counts.sum(axis=1, keepdims=True)
        return counts @ self.weights / np.maximum(sums, 1) / self.scale

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score in 0 to 1, and whether the lead is small."""
        losses = np.logaddexp(0, -4 * margins[:, None, :] * self.code[None]) @ self.trust
        best = losses.argmin(axis=1)
        share = np.exp(losses.min(axis=1, keepdims=True) - losses)
        ordered = np.sort(losses, axis=1)
        lead = ordered[:, 1] - ordered[:, 0] if len(self.languages) > 1 else np.full(len(losses), np.inf)
        return best, 1 / share.sum(axis=1), lead < MIN_LEAD * self.trust.sum()


def _counted(texts: list[str], at_once: int = 32) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(texts), at_once):
        yield start, np.stack([gram_counts(t) for t in texts[start : start + at_once]])


def train(labelled: DataFrame) -> Model:
    """A model of all rows (text, lang); rows with null lang or without a letter are left out."""
    rows = labelled.select("lang", "text").where("lang IS NOT NULL")

    def count(batches):
        sums = worker_table("grams", dict)
        sums.clear()
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, text in zip(*(part.column(c).to_pylist() for c in ("lang", "text"))):
                    if has_letter(text):
                        sums[lang] = sums.get(lang, 0) + gram_counts(text)
        for lang, total in sums.items():
            used = np.flatnonzero(total)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    counts = rows.mapInArrow(count, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toPandas()  # at most BUCKETS rows a language
    languages = sorted(table["lang"].unique())
    totals = np.full((len(languages), BUCKETS), SMOOTHING)
    totals[table["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy(int), table["bucket"].to_numpy(int)] += table["n"]
    shares = totals / totals.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = np.zeros((BUCKETS, bits))
    for j in range(bits) if len(languages) > 1 else ():
        ones, zeros = shares[code[:, j] > 0].mean(axis=0), shares[code[:, j] < 0].mean(axis=0)
        weights[:, j] = np.log(ones) - np.log(zeros)
    model = Model(languages, code, weights, np.ones(bits), np.ones(bits))
    if len(languages) > 1:
        _weigh_bits(model, rows)
    return model


def _weigh_bits(model: Model, rows: DataFrame) -> None:
    """Sets scale and trust of the bits from their margins on the labelled rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    place = {v: i for i, v in enumerate(model.languages)}

    def measure(batches):
        own = shared.value
        seen, right, size = 0, np.zeros(own.code.shape[1]), np.zeros(own.code.shape[1])
        for batch in (part for batch in batches for part in slices(batch, "text")):
            pairs = zip(*(batch.column(c).to_pylist() for c in ("lang", "text")))
            pairs = [(lang, text) for lang, text in pairs if has_letter(text)]
            for start, counts in _counted([text for _, text in pairs]):
                margins = own.margins(counts)
                wanted = own.code[[place[lang] for lang, _ in pairs[start : start + len(counts)]]]
                seen += len(counts)
                right += (margins * wanted > 0).sum(axis=0)
                size += abs(margins).sum(axis=0)
        bits = range(len(right))
        yield pa.RecordBatch.from_pydict({"bit": list(bits), "n": [seen] * len(bits), "hits": right, "size": size})

    sums = rows.mapInArrow(measure, "bit long, n long, hits double, size double").groupBy("bit")
    for row in sums.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.sum("size").alias("size")).collect():
        if row["n"]:
            error = min(max(1 - row["hits"] / row["n"], 1e-3), 0.499)
            model.trust[row["bit"]] = math.log((1 - error) / error)
            model.scale[row["bit"]] = max(row["size"] / row["n"], 1e-9)
    model.trust /= model.trust.mean()


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of the input (all by default) with ``lang_pred``, ``score`` and ``ambiguous``.

    A null text or one without a letter, and any text if the model knows no
    language, is ``und`` with score 0 and not ambiguous. Only the text is looked
    at. Rows stay rows; input columns named like an added one are replaced.
    """
    added = ["lang_pred", "score", "ambiguous"]
    kept = [c for c in keep or docs.columns if c not in added]
    source = docs.select(*[f"`{c}`" for c in kept], F.col("text").alias("__whole_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        own = shared.value
        for batch in batches:
            for part in slices(batch, "__whole_text"):
                texts = part.column(part.num_columns - 1).to_pylist()
                known = [i for i, t in enumerate(texts) if own.languages and has_letter(t)]
                lang, score, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
                for start, counts in _counted([texts[i] for i in known]):
                    for i, best, value, close in zip(known[start:], *own.decode(own.margins(counts))):
                        lang[i], score[i], unsure[i] = own.languages[best], float(value), bool(close)
                columns = part.columns[:-1] + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=kept + added)

    kinds = [T.StringType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType(list(source.schema.fields[:-1]) + [T.StructField(n, k) for n, k in zip(added, kinds)])
    return source.mapInArrow(predict, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_part(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
