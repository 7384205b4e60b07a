"""Severity of toxic language by a cumulative-link ordinal regression over the words of a text.

P(grade > k) = sigmoid(w . x - theta_k) for ordered thresholds theta_0 < theta_1 < ...; all thresholds share the weights w.
x marks which words and word stems a text has. The expected severity is the sum of these probabilities over k.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import worker
from tallyline.llm.text import NOT_LETTERS, WordHasher, byte_slices, list_array, utf8
from tallyline.session import materialize

SLICE_BYTES = 1 << 20
#: Labelled rows the model is fitted on at most: those with the smallest hashes of their key.
FIT_ROWS = 10_000
#: Lengths in bytes of the beginnings of words that count as stems.
STEMS = (4, 5, 6, 7)
#: Features kept for the fit: those whose presence differs most between grade 0 and the rest.
FIT_FEATURES = 3_000


@dataclass(frozen=True)
class OrdinalModel:
    """Hashes of words in ascending order with their weights, and the ordered thresholds."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, score: np.ndarray) -> np.ndarray:
        return sigmoid(score[:, None] - self.thresholds).sum(axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(hasher: WordHasher, part: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of many texts and the row of each: every word, and its beginnings of STEMS bytes as stems."""
    offsets, data = utf8(pc.utf8_lower(part.column(column)))
    first, last = hasher.bounds(offsets, data)
    rows = np.searchsorted(offsets, first, side="right") - 1
    found, owners = [hasher.hashes(data, first, last)], [rows]
    for n in STEMS:
        longer = last - first > n
        found.append(~hasher.hashes(data, first[longer], first[longer] + n))
        owners.append(rows[longer])
    return np.concatenate(found), np.concatenate(owners)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker.release()
    hasher = WordHasher(NOT_LETTERS)
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            values, owners = features(hasher, part, "text")
            order = np.argsort(owners, kind="stable")
            values, bounds = values[order], np.searchsorted(owners[order], np.arange(part.num_rows + 1))
            own = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("grade"), list_array(np.concatenate([values[:0], *own]).view(np.int64),
                                                  np.cumsum([0, *map(len, own)]), pa.int64())], names=["grade", "found"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many severe and other texts of a partition each feature occurs."""
    for batch in batches:
        found, bounds = batch.column("found").flatten().to_numpy(), batch.column("found").value_lengths().to_numpy()
        severe = np.repeat(batch.column("grade").to_numpy() > 0, bounds)
        values, place = np.unique(found, return_inverse=True)
        of_severe = np.bincount(place, weights=severe, minlength=len(values)).astype(np.int64)
        total = np.bincount(place, minlength=len(values))
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(of_severe), pa.array(total - of_severe)],
                                         names=["feature", "severe", "other"])


def _narrowed(words: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [r.values.to_numpy() for r in batch.column("found")]
            own = [r[np.isin(r, words)] for r in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), list_array(np.concatenate([words[:0], *own]), np.cumsum([0, *map(len, own)]),
                                                   pa.int64())], names=["grade", "found"])

    return run


def fit_rows(rows: list[np.ndarray], grades: np.ndarray, grades_count: int, steps: int = 300, rate: float = 0.5,
             shrink: float = 5e-4) -> OrdinalModel:
    """Proximal gradient steps on the mean negative log likelihood with an L1 penalty, from presence of features."""
    flat = np.concatenate([np.empty(0, np.uint64), *rows])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    vocabulary, column = np.unique(flat, return_inverse=True)
    w, cuts = np.zeros(len(vocabulary)), np.zeros(grades_count - 1)
    for k in range(grades_count - 1):
        above = np.clip((grades > k).mean() if len(grades) else 0.0, 1e-3, 1 - 1e-3)
        cuts[k] = -np.log(above / (1 - above))
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(len(cuts)))
    if not len(rows):
        return OrdinalModel(vocabulary, w, cuts)
    n, target = len(rows), grades[:, None] > np.arange(grades_count - 1)
    velocity, speed = np.zeros_like(w), np.zeros_like(w)
    for step in range(steps):
        score = np.bincount(owner, weights=w[column], minlength=len(rows))[:len(rows)]
        # The thresholds' binary likelihoods share w: their gradients add up over the ordered thresholds.
        error = sigmoid(score[:, None] - cuts) - target
        gradient = np.bincount(column, weights=error.sum(axis=1)[owner], minlength=len(w)) / n
        velocity = 0.9 * velocity + 0.1 * gradient
        speed = 0.99 * speed + 0.01 * gradient ** 2
        scale = rate / (np.sqrt(speed / (1 - 0.99 ** (step + 1))) + 1e-4)
        w = w - 0.1 * scale * velocity / (1 - 0.9 ** (step + 1))
        w = np.sign(w) * np.maximum(np.abs(w) - 0.1 * scale * shrink, 0)
        cuts = np.maximum.accumulate(cuts + 0.5 * error.mean(axis=0))
    kept = w != 0
    return OrdinalModel(vocabulary[kept], w[kept], cuts)


def fit(texts: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade",
        grades_count: int = 3, fit_rows_at_most: int = FIT_ROWS, fit_features: int = FIT_FEATURES) -> OrdinalModel:
    """Fit on the labelled rows, at most `fit_rows_at_most` of them.

    labels: `key` and an integer `grade` from 0. Rows with a null key or grade, or without a text row, are not used; of
    several labels for one key the largest counts; a key with several text rows takes part with each. A null text has no words. Without usable rows the model has no words
    and finds nothing severe.
    """
    graded = (labels.where(F.col(key).isNotNull() & F.col(grade).isNotNull())
              .groupBy(F.col(key).alias("key")).agg(F.max(grade).cast("int").alias("grade")))
    chosen = graded.orderBy(F.xxhash64("key"), "key").limit(fit_rows_at_most)
    rows = materialize(
        texts.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
        .select("grade", "text").mapInArrow(_feature_rows, "grade int, found array<long>"), "toxicity-rows")
    sizes = rows.agg(F.sum((F.col("grade") > 0).cast("long")), F.sum((F.col("grade") <= 0).cast("long"))).first()
    severe, other = (max(n or 0, 1) for n in sizes)
    counts = rows.mapInArrow(_counted, "feature long, severe long, other long").groupBy("feature").agg(
        F.sum("severe").alias("severe"), F.sum("other").alias("other")).where("severe + other > 1")
    gap = F.abs(F.col("severe") / severe - F.col("other") / other)
    top = counts.orderBy(gap.desc(), "feature").limit(fit_features).select("feature").toArrow()
    words = top.column("feature").to_numpy().astype(np.int64)
    narrow = rows.mapInArrow(_narrowed(words), "grade int, found array<long>").toArrow()
    grades = np.clip(narrow.column("grade").to_numpy().astype(np.int64), 0, grades_count - 1)
    return fit_rows([r.values.to_numpy().view(np.uint64) for r in narrow.column("found")], grades, grades_count)


def score(texts: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text",
          reject_from: float = 0.5) -> DataFrame:
    """All columns of `texts`, with `severity` (expected grade) and `rejected` (severity >= reject_from) added.

    Whole texts, one pass, no shuffle. A null or empty text scores as a text without words. Repeated rows and null keys
    are scored row by row. Input columns named severity or rejected are replaced.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)
    names = [c for c in texts.columns if c not in ("severity", "rejected")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        hasher, known = WordHasher(NOT_LETTERS), shared.value
        for batch in batches:
            for part in byte_slices(batch, text, SLICE_BYTES):
                values, owners = features(hasher, part, text)
                at = np.minimum(np.searchsorted(known.words, values), max(len(known.words) - 1, 0))
                hit = np.flatnonzero(known.words[at] == values) if len(known.words) else np.empty(0, np.int64)
                # A feature counts once in a text.
                pairs = np.unique(np.stack([owners[hit], at[hit]]), axis=1)
                total = np.bincount(pairs[0], weights=known.weights[pairs[1]] if len(hit) else None,
                                    minlength=part.num_rows).astype(float)
                severity = known.severity(total)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(severity), pa.array(severity >= reject_from)],
                    names=[*names, "severity", "rejected"])

    source = texts.select(*names)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    return source.mapInArrow(run, f"{kinds}, severity double, rejected boolean")


def severity_grades(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Grades of the labels table: 0 not toxic, 1 toxic in a text of good quality, 2 toxic in a poor one."""
    poor = 1 - F.coalesce(F.col("quality"), F.lit(1))
    return labels.select(F.col(key), F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, 1 + poor).alias("grade"))
