"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text's subwords are the runs of 2, 3 and 4 bytes inside its words, word borders included, letters A-Z lower-cased.
Each is hashed to one of ``BUCKETS`` embeddings; the text is their mean, over the whole text. Training takes a bounded,
labelled sample; its features are counted on the executors, so what reaches the driver is at most ``BUCKETS`` counts
for each of about ``SAMPLE`` documents, spread evenly over the languages. Since the classifier is linear, a trained
model is one score per bucket and language, and prediction is a sum of scores.

Scores are calibrated: a part of the sample that isn't trained on sets the softmax temperature, and the score from
which predictions are right often enough (``PRECISION``); those below are marked as not accepted.

Defined cases: null text or a text without a letter is ``und`` with score 0 and not accepted, and so is every text if
there is no labelled row to learn from. Rows without key or label are never learned from. Repeated rows give repeated
results; ties between languages go to the first by code point.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrid.llm.batches import Field, map_batches, map_text

BUCKETS = 1 << 16
DIMENSIONS = 16
SAMPLE = 3000
EPOCHS = 5
RATE = 0.5
HASH_BITS = 62
SEED = 7
FOLDS = 5
PRECISION = 0.995
UNKNOWN = "und"
SEGMENT = 1 << 20

_FOLD = np.array([c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in range(256)], np.uint8)
_LETTER = re.compile(r"[^\W\d_]")


def held_out(key: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of all subwords, segment by segment."""
    data = _FOLD[np.frombuffer(b" " + text.encode() + b" ", np.uint8)]
    for start in range(0, len(data), SEGMENT):
        part = data[start : start + SEGMENT + 3].astype(np.uint32)
        n = min(SEGMENT, len(part))
        code, space = part.copy(), part == 32
        inner = np.zeros(len(part), bool)  # a border inside the run
        for size in (2, 3, 4):
            m = len(part) - size + 1
            if m <= 0:
                return
            code = code[:m] | part[size - 1 :] << np.uint32(8 * (size - 1))
            if size > 2:
                inner = inner[:m] | space[size - 2 : size - 2 + m]
            blank = space[:m] & space[size - 1 :] if size == 2 else inner[:m]
            yield ((code * np.uint32(2654435761) + np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) >> np.uint32(16))[:n][~blank[:n]]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    scores: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for buckets in subwords(text):
            # Many places are counted first, so that no more than the table itself is gathered, however many languages there are.
            total += self.scores[buckets].sum(0, dtype=np.float64) if len(buckets) < BUCKETS else np.bincount(buckets, minlength=BUCKETS) @ self.scores.astype(np.float64)
            n += len(buckets)
        return total / max(n, 1) + self.bias

    def predict(self, text: str) -> tuple[str, float, bool]:
        if not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def sampling_bound(quota: float, rows: int) -> int:
    """Hashes of ``HASH_BITS`` bits below this are about ``quota`` of ``rows`` rows; exact for any number of rows."""
    return min(1 << HASH_BITS, max(1, round(quota * (1 << HASH_BITS)) // max(rows, 1)))


def sample(labelled: DataFrame, key: str, text: str, lang: str, size: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, weights) of about ``size`` documents, chosen by a hash of the key, evenly over the languages."""
    known = labelled.where(F.col(lang).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    if not counts:
        return []
    quota = size / len(counts)
    bound = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, sampling_bound(quota, n))]), F.col(lang))
    chosen = known.where(F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(1 << HASH_BITS)) < bound).select(F.col(key), F.col(lang), F.col(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(2):
                parts = list(subwords(t.as_py() or ""))
                found.append(np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint32), np.zeros(0, np.int64)))
            columns = [pa.array([a.astype(kind).tobytes() for a in column], pa.binary()) for column, kind in zip(
                zip(*found, strict=True), ("<u4", "<u4"), strict=True)] if found else [pa.array([], pa.binary())] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), *columns], names=["key", "lang", "buckets", "counts"])

    rows = map_batches(chosen, count, "key string, lang string, buckets binary, counts binary").collect()
    out = []
    for r in sorted(rows, key=lambda r: (r.key, r.lang, bytes(r.buckets), bytes(r.counts))):
        counted = np.frombuffer(r.counts, "<u4").astype(np.float32)
        if len(counted):
            out.append((r.lang, np.frombuffer(r.buckets, "<u4").astype(np.int64), counted / counted.sum()))
    return out


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> LanguageModel:
    """Train on four of five sampled documents, calibrate on the fifth."""
    languages = tuple(sorted({r[0] for r in rows}))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    at, rng = {x: i for i, x in enumerate(languages)}, np.random.default_rng(SEED)
    embed = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    order = rng.permutation(len(rows))
    check, learn = order[::5], np.setdiff1d(order, order[::5]) if len(rows) >= 50 else order
    steps, done = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            language, buckets, weights = rows[i]
            rate = RATE * (1 - done / steps)
            hidden = weights @ embed[buckets]
            gap = softmax(hidden @ out + bias)
            gap[at[language]] -= 1
            back = out @ gap
            out -= rate * np.outer(hidden, gap)
            bias -= rate * gap
            embed[buckets] -= rate * len(buckets) ** 0.5 * np.outer(weights, back)
            done += 1
    scores = embed @ out
    logits = np.array([rows[i][2] @ scores[rows[i][1]] + bias for i in check])
    truth = np.array([at[rows[i][0]] for i in check])
    temperature, threshold = calibrate(logits, truth)
    return LanguageModel(languages, scores, bias, temperature, threshold)


def calibrate(logits: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the lowest score from which ``PRECISION`` of predictions are right."""
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    p = softmax(logits / temperature)
    score, right = p.max(1), p.argmax(1) == truth
    order = np.argsort(-score, kind="stable")
    fine = np.flatnonzero(np.cumsum(right[order]) >= PRECISION * np.arange(1, len(order) + 1))
    return temperature, float(score[order[fine[-1]]]) if len(fine) else 1.0


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SAMPLE) -> LanguageModel:
    """A model of the documents outside the held-out fold that have a language."""
    return fit(sample(docs.select(key, text, lang).where(~held_out(F.col(key))), key, text, lang, size))


FIELDS: list[Field] = [("lang_pred", "string", pa.string()), ("score", "double", pa.float64()), ("accepted", "boolean", pa.bool_())]


def identify(spark: SparkSession, docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, lang_pred, its calibrated score, and whether the score is high enough to rely on."""
    sent = spark.sparkContext.broadcast(model)
    return map_text(docs, key, text, FIELDS, lambda: sent.value.predict)
