"""Severity of toxic text: cumulative-link ordinal regression on sparse features.

Grades 0..K-1 are ordered.  One weight vector serves all thresholds:
``P(grade > k) = sigmoid(w.x - threshold_k)``, and the expected severity is the sum of these.
Features are the distinct words of the whole text, in lower case (ASCII), and the first few
bytes of longer words, so that inflected and compound forms share weights.  A penalty on
absolute weights leaves few of them.

The model is fitted on the driver from a bounded sample of graded documents (``SAMPLE``, those
with the smallest hash of their id; one row of each).  Their features are counted by Spark, and only numbers of
those in enough documents reach the driver.  All documents are scored where they lie, without an exchange.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import arrays, common
from gazette_lake.session import stage

SAMPLE = 8000  # graded documents that the model is fitted on, at most
PREFIXES = (4, 5, 6, 7)
LEAST_DOCUMENTS = 5  # documents of the sample that a feature must be in
PENALTY = 1e-4
ROUNDS, TAKEN, STEPS = 12, 60, 150
REJECT_AT = 0.3
_BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word and prefix, with repetitions."""
    starts, ends = arrays.runs(_WORD[data], offsets)
    row = arrays.row_of(np.searchsorted(starts, offsets))
    value = arrays.RangeHash(_LOWER[data])
    rows, hashes = [row], [value(starts, ends)]
    for length in PREFIXES:
        longer = ends - starts > length
        rows.append(row[longer])
        hashes.append(value(starts[longer], starts[longer] + length))
    return np.concatenate(rows), np.concatenate(hashes)


@dataclass
class Model:
    """Weights by feature hash, and thresholds between grades; no grade above the last one seen."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    BITS = 16

    def __post_init__(self):
        order = np.argsort(self.keys)
        self.keys, self.weights = self.keys[order], self.weights[order]
        self.may = np.zeros(1 << self.BITS, bool)
        self.may[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """w.x of every row; each feature counts once."""
        rows, hashes = features(data, offsets)
        found = np.flatnonzero(self.may[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        rows, hashes = rows[found], hashes[found]
        at = np.searchsorted(self.keys, hashes)
        hit = (at < len(self.keys))
        hit[hit] = self.keys[at[hit]] == hashes[hit]
        once = np.unique(rows[hit] * max(1, len(self.keys)) + at[hit])
        row, column = np.divmod(once, max(1, len(self.keys)))
        return np.bincount(row, self.weights[column], len(offsets) - 1)

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and threshold k."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _slopes(score: np.ndarray, grades: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the mean negative log-likelihood by each score and each threshold."""
    n, top = len(grades), len(thresholds)
    limits = np.concatenate([[-np.inf], thresholds, [np.inf]])
    below, upto = _sigmoid(limits[grades] - score), _sigmoid(limits[grades + 1] - score)
    probability = np.maximum(upto - below, 1e-12)
    slope_up, slope_down = upto * (1 - upto) / probability, below * (1 - below) / probability
    by_threshold = np.bincount(grades[grades > 0] - 1, slope_down[grades > 0], top)
    by_threshold -= np.bincount(grades[grades < top], slope_up[grades < top], top)
    return (slope_up - slope_down) / n, by_threshold / n


def _descend(rows, column, w, thresholds, grades, penalty, steps) -> tuple[np.ndarray, np.ndarray]:
    """Accelerated proximal steps over a few features."""
    n, power = len(grades), np.ones(len(w))
    for _ in range(8):  # largest eigenvalue of X'X/n, for the step
        power = np.bincount(column, np.bincount(rows, power[column], n)[rows], len(w)) / n
        size = np.linalg.norm(power) or 1.0
        power /= size
    step = 1 / (0.3 * (size + 1))
    last_w, last_t, look_w, look_t, pace = w, thresholds, w, thresholds, 1.0
    for _ in range(steps):
        by_score, by_threshold = _slopes(np.bincount(rows, look_w[column], n), grades, look_t)
        w = look_w - step * np.bincount(column, by_score[rows], len(w))
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        thresholds = np.maximum.accumulate(look_t - step * by_threshold)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        look_w = w + (pace - 1) / faster * (w - last_w)
        look_t = np.maximum.accumulate(thresholds + (pace - 1) / faster * (thresholds - last_t))
        last_w, last_t, pace = w, thresholds, faster
    return w, thresholds


def fit(rows: np.ndarray, keys: np.ndarray, grades: np.ndarray, penalty: float = PENALTY) -> Model:
    """Penalised maximum likelihood.  ``rows`` and ``keys`` list each document's distinct features.

    Each round takes up the features whose slopes exceed the penalty most and fits all taken so
    far, until no slope exceeds it or ``ROUNDS`` are over.  Where all grades are equal, or there are
    none, the model has no weights and every document the lowest grade.
    """
    n, top = len(grades), int(grades.max(initial=0))
    if not n or grades.min() == top:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(1, np.inf))
    vocabulary, column, documents = np.unique(keys, return_inverse=True, return_counts=True)
    frequent = documents >= LEAST_DOCUMENTS
    kept = frequent[column]
    return fit_numbered(rows[kept], (np.cumsum(frequent) - 1)[column[kept]], vocabulary[frequent], grades, penalty)


def _row_sums(rows: np.ndarray, column: np.ndarray, by_row: np.ndarray, size: int) -> np.ndarray:
    """Sums of each row's value by column, in blocks."""
    sums = np.zeros(size)
    for low in range(0, len(rows), _BLOCK):
        sums += np.bincount(column[low:low + _BLOCK], by_row[rows[low:low + _BLOCK]], size)
    return sums


def fit_numbered(rows: np.ndarray, column: np.ndarray, vocabulary: np.ndarray, grades: np.ndarray, penalty: float = PENALTY) -> Model:
    """``fit`` on numbers of features that are in enough documents; ``vocabulary`` has their hashes."""
    n, top = len(grades), int(grades.max(initial=0))
    if not n or grades.min() == top:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(1, np.inf))
    share = np.clip([(grades > k).mean() for k in range(top)], 1e-9, 1 - 1e-9)
    w, thresholds = np.zeros(len(vocabulary)), np.log((1 - share) / share)
    taken = np.zeros(len(w), bool)
    for _ in range(ROUNDS):
        inside = taken[column]
        by_score, _ = _slopes(np.bincount(rows[inside], w[column[inside]], n), grades, thresholds)
        slope = np.abs(_row_sums(rows, column, by_score, len(w)))
        slope[taken] = 0
        best = np.argsort(-slope, kind="stable")[:TAKEN]
        best = best[slope[best] > penalty]
        if not len(best):
            break
        taken[best] = True
        inside, number = taken[column], np.cumsum(taken) - 1
        w[taken], thresholds = _descend(rows[inside], number[column[inside]], w[taken], thresholds, grades, penalty, STEPS)
    used = w != 0
    return Model(vocabulary[used], w[used], thresholds)


def sample_features(docs: DataFrame, graded: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and feature numbers, the features' hashes, and the grades of the sampled documents.

    Of the rows that share a sampled id, the one whose text has the smallest hash is used.
    """
    chosen = graded.groupBy("doc_id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches):
            rows, hashes = features(*arrays.text_bytes(part.column(2)))
            limits = np.searchsorted(rows[order := np.lexsort((hashes, rows))], np.arange(part.num_rows + 1))
            hashes = hashes[order]
            sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(limits[:-1], limits[1:])]
            yield pa.record_batch({"doc_id": part.column(0), "grade": part.column(1), "features": pa.array(sets, pa.binary())})

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.record_batch({"feature": pa.array(np.frombuffer(x.as_buffer(), np.int64))})

    found = docs.join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", F.col("grade").cast("int").alias("grade")).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sets = stage(one.mapInArrow(extract, "doc_id long, grade int, features binary"), "features")
    counted = sets.select("features").mapInArrow(single, "feature long").groupBy("feature").count()
    frequent = counted.filter(F.col("count") >= LEAST_DOCUMENTS).select("feature").toArrow().column("feature").to_numpy()
    vocabulary = np.sort(frequent.view(np.uint64))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def numbers_of(hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(sent.value, hashes)
        known = at < len(sent.value)
        known[known] = sent.value[at[known]] == hashes[known]
        return at[known]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [numbers_of(np.frombuffer(x.as_buffer(), np.uint64)).astype(np.int32).tobytes() for x in batch.column(2)]
            yield pa.record_batch({"doc_id": batch.column(0), "grade": batch.column(1), "numbers": pa.array(numbers, pa.binary())})

    table = sets.mapInArrow(number, "doc_id long, grade int, numbers binary").toArrow()
    order = np.argsort(table.column("doc_id").to_numpy())
    numbers = table.column("numbers").to_pylist()
    sizes = [len(numbers[i]) // 4 for i in order]
    column = np.frombuffer(b"".join([numbers[i] for i in order]), np.int32)
    rows = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    return rows, column, vocabulary, table.column("grade").to_numpy().astype(np.int64)[order]


def model_for(docs: DataFrame, graded: DataFrame, sample: int = SAMPLE) -> Broadcast:
    """The fitted model, sent to all workers.  ``docs`` has doc_id and text."""
    usable = graded.select(F.col("doc_id").cast("long"), F.col("grade").cast("int")).filter("doc_id is not null and grade >= 0")
    return docs.sparkSession.sparkContext.broadcast(fit_numbered(*sample_features(docs, usable, sample)))


def score(docs: DataFrame, graded: DataFrame, sample: int = SAMPLE, reject_at: float = REJECT_AT,
          id: str = "doc_id", text: str = "text") -> DataFrame:
    """Expected severity of every document: doc_id, severity, p_toxic (grade above 0), grade (likeliest), rejected.

    ``graded`` (doc_id, grade from 0): of several grades of one id the highest counts; rows
    without either are left out.  A null or empty text has no features and so the base rate's
    severity.  A null id stays null, repeated rows stay, an empty table gives no rows.  Columns
    besides those named are ignored.
    """
    source = common.id_and_text(docs, id, text)
    model = model_for(source, graded, sample)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches):
            above = model.value.above(model.value.scores(*arrays.text_bytes(part.column(1))))
            grades = -np.diff(np.pad(above, ((0, 0), (1, 1)), constant_values=((0, 0), (1, 0))), axis=1)
            yield pa.record_batch({
                "doc_id": part.column(0), "severity": pa.array(above.sum(1)), "p_toxic": pa.array(above[:, 0]),
                "grade": pa.array(grades.argmax(1).astype(np.int32)), "rejected": pa.array(above[:, 0] >= reject_at)})

    return source.mapInArrow(rate, "doc_id long, severity double, p_toxic double, grade int, rejected boolean")


def without_rejected(docs: DataFrame, graded: DataFrame, sample: int = SAMPLE, reject_at: float = REJECT_AT,
                     id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, that ``score`` does not reject."""
    model, at = model_for(common.id_and_text(docs, id, text), graded, sample), docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, text):
            above = model.value.above(model.value.scores(*arrays.text_bytes(part.column(at))))
            yield part.filter(pa.array(above[:, 0] < reject_at))

    return docs.mapInArrow(keep, docs.schema)


def grades(labels: DataFrame) -> DataFrame:
    """Grade 0: not toxic; 1: toxic; 2: toxic and of low quality."""
    return labels.select("doc_id", (F.col("toxic") + F.when((F.col("toxic") == 1) & (F.col("quality") == 0), 1).otherwise(0)).alias("grade"))
