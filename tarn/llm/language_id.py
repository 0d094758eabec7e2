"""Language identification: averaged hashed subword embeddings and a linear softmax.

Byte n-grams (two to four) of the lower-cased text are hashed to buckets; the
text's vector is the mean of its n-grams' embeddings, and a linear layer with
softmax gives the languages' probabilities. Both layers are trained by
stochastic gradient descent in numpy on a bounded sample: of each language
about ``PER_LANGUAGE`` labelled documents, picked by a hash of their ids and
texts; rows that are alike count as one, so that neither a hot id nor a row
repeated fills the sample. A fifth of the sample is held back to calibrate: a
temperature scales the scores, and the rejection threshold is the smallest
score at which accepted predictions reach the wanted precision. Features of the sample are made on
the executors from whole texts; a document gives a list of at most
``BUCKETS`` counts. For prediction the layers are multiplied out to one
number a bucket and language, which is broadcast (its size is fixed by the
buckets and the languages); nothing is shuffled.

Defined cases: a null text, or one without a letter (Unicode category L; number
signs such as Roman numerals and fractions are none), is ``und`` with score 0
and not accepted. Languages may be many: the sample and the model grow with
their number, not with the rows. Documents without an id are predicted, never learned from,
and not held out. Without labelled documents everything is ``und``. Repeated
rows are predicted alike; of equal probabilities the first language wins;
empty tables give empty results. Language, source and id are never inputs of a prediction; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 13
DIMENSIONS = 16
PER_LANGUAGE = 500
EPOCHS = 30
RATE = 40.0
PRECISION = 0.99
FOLDS = 5
SLICE = 1 << 20


def has_letter(text: str) -> bool:
    """Whether a text has a character of the Unicode category L; numbers and marks aren't letters."""
    return any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """How often the n-grams of a text fall into each bucket."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    total = np.zeros(BUCKETS, np.int64)
    for k in range(0, len(data), SLICE):
        b = data[k : k + SLICE + 3].astype(np.uint32)
        most = min(SLICE, len(data) - k)
        h = b * np.uint32(0x9E3779B1)
        for n in (2, 3, 4):
            if len(b) < n:
                break
            h = (h[: len(b) - n + 1] ^ (h[: len(b) - n + 1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + b[n - 1 :]
            total += np.bincount((h[:most] * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return total


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages: embeddings times output layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, shares: np.ndarray) -> np.ndarray:
        return shares @ self.weights + self.bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.logits(x / np.maximum(x.sum(1, keepdims=True), 1)) / self.temperature)


Sparse = list[tuple[np.ndarray, np.ndarray]]


def dense(x: Sparse, rows: np.ndarray) -> np.ndarray:
    """Some rows of bucket numbers and counts as a matrix of shares."""
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for k, i in enumerate(rows):
        at, n = x[i]
        out[k, at] = n / max(1, n.sum())
    return out


def train(x: Sparse, y: np.ndarray, languages: list[str], seed: int = 7) -> Model:
    """Stochastic gradient descent on bucket counts ``x`` with language numbers ``y``.

    The counts stay sparse; only the rows of a step are made a matrix.
    """
    rng = np.random.default_rng(seed)
    held = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.zeros(len(x), bool)
    embed = rng.normal(0, 0.5, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    fit = np.flatnonzero(~held)
    share = np.bincount(y[fit], minlength=len(languages))
    weight = (len(fit) / np.maximum(share, 1) / len(languages)).astype(np.float32)[y]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 16)):
            means = dense(x, part)
            hidden = means @ embed
            z = hidden @ out + bias
            e = np.exp(z - z.max(1, keepdims=True))
            delta = e / e.sum(1, keepdims=True)
            delta[np.arange(len(part)), y[part]] -= 1
            delta *= weight[part, None] / len(part)
            back = delta @ out.T
            out -= rate / 8 * hidden.T @ delta
            bias -= 0.1 * delta.sum(0)
            used = np.flatnonzero(means.any(0))
            embed[used] -= rate * means[:, used].T @ back
    model = Model(languages, (embed @ out).astype(np.float64), bias.astype(np.float64))
    check = np.flatnonzero(held) if held.any() else fit
    if len(check):
        z = np.concatenate([model.logits(dense(x, part)) for part in np.array_split(check, -(-len(check) // 64))])
        loss = [(-np.log(np.maximum(softmax(z / t)[np.arange(len(check)), y[check]], 1e-12)).mean(), t) for t in np.geomspace(0.05, 20, 60)]
        model.temperature = float(min(loss)[1])
        p = softmax(z / model.temperature)
        order = np.argsort(-p.max(1))
        right = np.cumsum((p.argmax(1) == y[check])[order]) / np.arange(1, len(check) + 1)
        good = np.flatnonzero(right >= PRECISION)
        model.threshold = float(p.max(1)[order][good[-1]]) if len(good) else 1.0
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, lang, text in zip(*(batch.column(k).to_pylist() for k in range(3))):  # noqa: B905
            x = counts(text)
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_pydict({"key": [key], "lang": [lang], "at": pa.array([at.astype(np.int32)], pa.list_(pa.int32())), "n": pa.array([x[at]], pa.list_(pa.int64()))})


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def sampled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """(key, lang, text): about ``per_language`` different documents of each language, whose remainder isn't 0."""
    rows = df.where((remainder(id_col) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(F.xxhash64(F.lit(11), id_col, text_col).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    many = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not many:
        return rows.limit(0)
    limits = F.create_map(*[F.lit(v) for lang, n in many.items() for v in (lang, int((1 << 30) * min(1.0, per_language / n)))])
    return rows.where(F.pmod("key", F.lit(1 << 30)) < F.try_element_at(limits, F.col("lang"))).dropDuplicates(["key", "lang"])


def fitted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model learned from documents with a language whose remainder isn't 0."""
    rows = sampled(df, id_col, text_col, lang_col, per_language)
    found = sorted(rows.mapInArrow(_features, "key long, lang string, at array<int>, n array<long>").collect(), key=lambda r: (r.key, r.lang))
    languages = sorted({r.lang for r in found})
    if not found:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    x = [(np.array(r["at"], np.int32), np.array(r.n, np.float32)) for r in found]
    return train(x, np.array([languages.index(r.lang) for r in found], np.int64), languages)


def _predictor(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = ["und"] * len(batch), np.zeros(len(batch))
            for k, text in enumerate(batch.column(2).to_pylist()):
                if model.languages and text and has_letter(text):
                    p = model.scores(counts(text)[None, :])[0]
                    langs[k], scores[k] = model.languages[int(p.argmax())], min(1.0, float(p.max()))
            accepted = pa.array([x != "und" and s >= model.threshold for x, s in zip(langs, scores)])  # noqa: B905
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs), pa.array(scores), accepted], names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return predict


def predicted(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, held_out, lang_pred, score and accepted."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(remainder(id_col) == 0, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predictor(model), rows.select("doc_id", "held_out").schema.simpleString()[7:-1].replace(":", " ") + ", lang_pred string, score double, accepted boolean")


def languages(df: DataFrame) -> DataFrame:
    return predicted(df, fitted(df))
