"""Quality rules, and a log-likelihood ratio of hashed n-grams: trusted texts against the raw corpus.

Word unigrams and bigrams are hashed into ``BUCKETS`` buckets, so many that an n-gram rarely shares
one with others.  Two multinomials over the buckets are counted, one over the documents
labelled good and one over all documents.  A document's score is the mean of
``log(p_trusted / p_raw)`` over its n-grams, so it does not grow with length.  A document is kept
if it passes the fixed rules and its score reaches a threshold; nothing is drawn at random.  The
threshold is placed between labelled good documents that were not counted (a quarter of them) and
those labelled bad, none of which is counted as trusted, where the two shares of errors add up to least.

All texts are read three times, however many labels there are: to pick the labelled ones, which a bitmap of
the ids does before they are joined and written, to count, and to judge.  Counting needs one exchange of at
most ``BUCKETS`` rows per task, and a task counts ``PARTS`` input partitions before it hands them on.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import arrays, common
from gazette_lake.operators.bitfilter import with_maybe
from gazette_lake.session import stage

BUCKET_BITS = 22
BUCKETS = 1 << BUCKET_BITS
PARTS = 32  # input partitions that a counting task takes, unless there are fewer than cores: some 4 GB
SMOOTHING = 1.0  # trusted n-grams added to what a bucket has and to what it would have if trusted texts were like all
CALIBRATION_FOLDS = 4  # one of them is not counted but sets the threshold
LOST = 0.005  # share of trusted documents below the threshold where none is labelled bad
STEP = 1e-3  # scores are told apart as finely as this for the threshold
ROWS = 1 << 16  # of a batch of counts
WINDOW = 3
LEAST_WORDS, MOST_REPEATED = 50, 0.5

# The symbols that a rule counts.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _distinct(rows: np.ndarray, hashes: np.ndarray):
    """Numbers of distinct hashes within rows: first place, inverse, counts."""
    own = arrays.mix(hashes ^ arrays.mix(rows.astype(np.uint64)))
    _, first, back, counts = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    return first, back, counts


class Text:
    """Words of a slice and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.starts, self.ends, self.first = arrays.words(data, offsets)
        self.hash = arrays.RangeHash(data)
        self.words = self.hash(self.starts, self.ends)
        self.order = arrays.RangeHash(self.words)

    def _runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and start of every run of n words."""
        counts = np.maximum(np.diff(self.first) - n + 1, 0)
        row = np.repeat(np.arange(len(counts)), counts)
        return row, np.arange(len(row)) + np.repeat(self.first[:-1] - np.cumsum(counts) + counts, counts)

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and bucket of every unigram and bigram."""
        row, at = self._runs(2)
        rows = np.concatenate([arrays.row_of(self.first), row])
        hashes = np.concatenate([self.words, self.order(at, at + 2)])
        return rows, (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)

    def word_chars(self) -> np.ndarray:
        before = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=before[1:])
        return arrays.sum_rows(before[self.ends] - before[self.starts], self.first)

    def symbols(self) -> np.ndarray:
        return arrays.sum_rows(_SYMBOL[self.data], self.offsets)

    def duplicate_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        limit = np.zeros(len(self.data) + 1, bool)
        breaks = np.flatnonzero(self.data == 0x0A)
        limit[breaks + 1] = True
        limit[self.offsets] = True
        starts = np.flatnonzero(limit[:-1])
        ends = np.append(starts[1:], len(self.data))
        rows = np.searchsorted(self.offsets, starts, "right") - 1
        if len(starts):
            ends = ends - (self.data[ends - 1] == 0x0A)
        worded = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        rows, starts, ends = rows[worded], starts[worded], ends[worded]
        first, _, _ = _distinct(rows, self.hash(starts, ends))
        n = len(self.offsets) - 1
        return np.bincount(rows, minlength=n) - np.bincount(rows[first], minlength=n)

    def repeated_words(self) -> np.ndarray:
        """Words inside word windows that their text has twice or more."""
        rows, at = self._runs(WINDOW)
        _, back, counts = _distinct(rows, self.order(at, at + WINDOW))
        again = at[counts[back] > 1]
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + WINDOW, -1)
        return arrays.sum_rows((np.cumsum(edge[:-1]) > 0).astype(np.int64), self.first)


BAD, HELD, COUNTED = 0, 1, 2  # labelled bad; good, and sets the threshold; good, and is counted


def kinds_of(labels: DataFrame) -> DataFrame:
    """(doc_id, kind), one row per labelled id.  An id with a label 0 is bad, whatever else it has."""
    judged = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"))
    held = F.pmod(F.xxhash64(F.lit("threshold"), "doc_id"), F.lit(CALIBRATION_FOLDS)) == 0
    return judged.filter("quality in (0, 1)").select(
        "doc_id", F.when(F.col("quality") == 0, BAD).when(held, HELD).otherwise(COUNTED).alias("kind"))


def labelled_texts(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """(doc_id, text, kind) of labelled documents, written; texts without a label are not shuffled."""
    known = stage(kinds, "kinds")
    maybe = with_maybe(docs.select("doc_id", "text"), known, ["doc_id"], "_maybe").filter("_maybe").drop("_maybe")
    return stage(maybe.join(known, "doc_id"), "labelled")


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """n-grams of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for part in arrays.slices(batches):
            np.add.at(total, Text(*arrays.text_bytes(part.column(0))).buckets()[1], 1)
        used = np.flatnonzero(total)
        for low in range(0, len(used), ROWS):
            at = used[low:low + ROWS]
            yield pa.record_batch({"bucket": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    narrow, cores = texts.select("text"), texts.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-narrow.rdd.getNumPartitions() // PARTS))
    counted = narrow.coalesce(tasks).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table, counts = counted.toArrow(), np.zeros(BUCKETS, np.int64)  # BUCKETS rows at most
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return counts


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(p_trusted / p_raw) by bucket; 0 where nothing is trusted, or nothing was seen.

    Buckets seen in few trusted texts, or expected in few, are drawn to 0.
    """
    if not target.sum():
        return np.zeros(len(raw), np.float32)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + SMOOTHING) / (expected + SMOOTHING)).astype(np.float32)


def threshold_for(labelled: DataFrame, ratios: Broadcast) -> float:
    """The middle of where fewest labelled documents are misjudged; without any good ones, no bound.

    Shares of good documents lost and of bad ones kept count alike.  Without bad ones, ``LOST`` of the
    good ones are below it.  Documents that fail the rules do not matter.
    """
    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches):
            for scored in _judge(ratios, 0.0)(iter([part])):
                passes = ~scored.column("base_failed").to_numpy(zero_copy_only=False)
                step = np.floor(scored.column("score").to_numpy() / STEP).astype(np.int64)
                good = part.column(2).to_numpy() == HELD
                yield pa.record_batch({"step": pa.array(step[passes]), "good": pa.array(good[passes])})

    used = labelled.filter(F.col("kind").isin(BAD, HELD)).select("doc_id", "text", "kind")
    found = used.mapInArrow(steps, "step long, good boolean").groupBy("step", "good").count()
    return _threshold({(step, good): n for step, good, n in found.collect()})  # some 10,000 steps at most: scores are logarithms


def _threshold(counts: dict[tuple[int, bool], int]) -> float:
    """The threshold from numbers of documents by step and whether they are good."""
    steps = sorted({step for step, _ in counts})
    good, bad = (np.array([counts.get((step, kind), 0) for step in steps], np.int64) for kind in (True, False))
    if not good.sum():
        return -np.inf
    lost = np.append(0, np.cumsum(good)) / good.sum()  # by number of steps below the threshold
    if not bad.sum():
        return steps[int(np.searchsorted(lost, LOST, "right")) - 1] * STEP
    wrong = lost + 1 - np.append(0, np.cumsum(bad)) / bad.sum()
    first = int(wrong.argmin())
    if first == 0:
        return -np.inf
    if first == len(steps):
        return (steps[-1] + 1) * STEP
    return (steps[first - 1] + 1 + steps[first]) / 2 * STEP


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, score double")


def _judge(ratios: Broadcast, threshold: float):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches):
            words = Text(*arrays.text_bytes(part.column(1)))
            rows, buckets = words.buckets()
            n, n_words = part.num_rows, np.diff(words.first)
            score = np.bincount(rows, ratios.value[buckets], n) / np.maximum(np.bincount(rows, minlength=n), 1)
            repeated = words.repeated_words()
            failed = (n_words < LEAST_WORDS) | (repeated > MOST_REPEATED * n_words)
            columns = {"n_words": n_words, "word_chars": words.word_chars(), "n_symbols": words.symbols(),
                       "n_dup_lines": words.duplicate_lines(), "n_repeat_words": repeated, "base_failed": failed,
                       "kept": ~failed & (score >= threshold), "score": score}
            yield pa.record_batch({"doc_id": part.column(0)} | {k: pa.array(v) for k, v in columns.items()})

    return judge


def assess(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rule counts, score and verdict of every whole text.

    ``labels`` (doc_id, quality): documents whose quality is 1 are trusted, unless a row of the same id says 0.
    Without trusted documents all scores are 0 and the rules decide.  A null or empty text has no
    words and fails the rules.  A null id stays null, repeated rows stay, an empty table gives no
    rows.  Columns besides those named are ignored.
    """
    source = common.id_and_text(docs, id, text)
    labelled = labelled_texts(source, kinds_of(labels))
    target = bucket_counts(labelled.filter(F.col("kind") == COUNTED))
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(bucket_counts(source), target))
    threshold = threshold_for(labelled, ratios) if target.any() else -np.inf
    return source.mapInArrow(_judge(ratios, threshold), SCHEMA)


def evaluate(docs: DataFrame, labels: DataFrame, folds: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(quality, n, n_passing, n_kept) of labelled documents of one fold, whose labels nothing was learned from.

    ``n_passing`` passed the rules; of those, ``n_kept`` were kept.
    """
    fold = F.pmod(F.xxhash64(F.lit("tried"), F.col("doc_id").cast("long")), F.lit(folds)) == 0
    tried = kinds_of(labels.filter(fold)).select("doc_id", (F.col("kind") != BAD).cast("int").alias("quality"))
    judged = assess(docs, labels.filter(~fold), id, text).select("doc_id", "base_failed", "kept")
    some = with_maybe(judged, tried, ["doc_id"], "_maybe").filter("_maybe").drop("_maybe")
    return some.join(tried, "doc_id").groupBy("quality").agg(
        F.count("*").alias("n"), F.count(F.when(~F.col("base_failed"), 1)).alias("n_passing"), F.count(F.when(F.col("kept"), 1)).alias("n_kept"))
