"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are sequences of words: letters and digits, in lower case (ASCII).  Items of similar length
form a class; its window is as long as its shortest item, and every word of a document starts a
window of each class.

1. Counts rule out windows that cannot match: an edit touches q runs of q words at most, so a
   window within k edits of an item has all but q*k of its runs among the items' runs (q = 1 to 3).
2. The others are embedded by random walks (CGK: in step j emit the current word, and move on if a
   random function of j and the word says so), which turn few edits into few differing steps.
   A table samples some steps; equal samples of window and item make a candidate.  Each
   class has as many tables as a simulation with the most edits allowed needs for the recall wanted.
3. Candidates are compared with the whole item, ends free: the edit distance decides.

Items are the query set: they go to all workers in blocks of bounded size.  Documents are read
where they lie, whole, without an exchange, one pass per block of items.
"""

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import arrays, common

EDIT_RATE = 0.15  # edits allowed, as a share of an item's words
RECALL = 0.99
SAMPLED = 3  # steps that a table samples
CLASS_RATIO = 1.2  # longest to shortest item of a class
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 2_000_000
TRIALS = 400
RUNS = (1, 2, 3)
RUN_BITS = 22
SLICE_BYTES = 1 << 22  # larger than elsewhere: few windows of a slice are left to embed
WINDOW_WORDS = 1 << 20  # words of the windows that are embedded at a time

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Hash, start and end of every word, and each row's first word."""
    starts, ends = arrays.runs(_WORD[data], offsets)
    return arrays.hash_ranges(_LOWER[data], starts, ends), starts, ends, np.searchsorted(starts, offsets)


def embed(windows: np.ndarray, steps: np.ndarray, key: np.uint64) -> np.ndarray:
    """Words that the walk emits at the sampled steps, for each window (a row of word hashes, 0 behind its end)."""
    words = np.pad(windows, ((0, 0), (0, 1))).ravel()
    last = np.arange(1, len(windows) + 1) * (windows.shape[1] + 1) - 1
    at = last - windows.shape[1]
    out = np.zeros((len(windows), len(steps)), np.uint64)
    keys = arrays.mix(key + np.arange(int(steps.max()) + 1, dtype=np.uint64))
    for j in range(int(steps.max()) + 1):
        word = words[at]
        out[:, steps == j] = word[:, None]
        word ^= keys[j]
        word *= np.uint64(0xD6E8FEB86659FD93)
        at += (word >> np.uint64(63)).astype(np.int64)
        np.minimum(at, last, out=at)
    return out


def _table(seed: int, number: int, width: int) -> tuple[np.ndarray, np.uint64]:
    random = np.random.default_rng([seed, number, width])
    return np.sort(random.integers(0, 2 * width, SAMPLED)), np.uint64(random.integers(1 << 62))


def _samples(windows: np.ndarray, seed: int, number: int) -> np.ndarray:
    steps, key = _table(seed, number, windows.shape[1])
    found = embed(windows, steps, key)
    value = np.zeros(len(windows), np.uint64)
    for i in range(SAMPLED):
        value = value * np.uint64(0x9E3779B97F4A7C15) + found[:, i]
    return arrays.mix(value)


def tables_for(width: int, edits: int, recall: float, seed: int) -> int:
    """Tables needed: 1 where no edit is allowed, else by simulating the most edits on random words."""
    if not edits:
        return 1
    random = np.random.default_rng([seed, width, edits])
    agree = 0
    for trial in range(TRIALS):
        plain = random.integers(1, 1 << 62, width + edits).astype(np.uint64).tolist()
        other = list(plain)
        for _ in range(edits):
            kind, at = int(random.integers(3)), int(random.integers(width))
            new = [int(random.integers(1, 1 << 62))]
            other[at:at + (kind != 1)] = new if kind else []
        pair = np.array([plain[:width], (other + [0] * width)[:width]], np.uint64)
        found = _samples(pair, seed, trial)
        agree += int(found[0] == found[1])
    return ceil(log(1 - recall) / log(1 - max(1, agree) / (TRIALS + 1)))


def distances(items: np.ndarray, lengths: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn each item into some part of its window, and where that part ends."""
    width = windows.shape[1]
    column = np.arange(width + 1)
    row = np.zeros((len(items), width + 1), np.int64)
    last = row.copy()
    for i in range(items.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + ((windows != items[:, i:i + 1]) | (windows == 0)))
        row = np.minimum.accumulate(new - column, axis=1) + column
        done = lengths == i + 1
        last[done] = row[done]
    end = last.argmin(1)
    return last[np.arange(len(items)), end], end


class Items:
    """Items by class, with their samples in every table."""

    def __init__(self, ids: list, texts: list[str | None], edit_rate: float, recall: float, seed: int):
        data, offsets = arrays.text_bytes(pa.array(texts, pa.string()))
        self.ids = np.array(ids, np.int64)
        self.words, _, _, self.first = word_hashes(data, offsets)
        self.lengths, self.rate, self.seed = np.diff(self.first), edit_rate, seed
        self.known = {}
        for q in RUNS:
            self.known[q] = np.zeros(1 << RUN_BITS, bool)
            self.known[q][self._slot(self._runs(self.words, self.first, q))] = True
        order = np.flatnonzero(self.lengths)[np.argsort(self.lengths[self.lengths > 0], kind="stable")]
        self.classes = []
        while len(order):
            width = int(self.lengths[order[0]])
            n = int((self.lengths[order] <= width * CLASS_RATIO).sum())
            own, order = order[:n], order[n:]
            edits = self.edits(int(self.lengths[own].max()))
            prefixes = self._gather(self.words, self.first[own], self.first[own] + width, width)
            tables = []
            for number in range(tables_for(width, edits, recall, seed)):
                value = _samples(prefixes, seed, number)
                by = np.argsort(value, kind="stable")
                tables.append((value[by], own[by]))
            self.classes.append((width, edits, tables))

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - RUN_BITS)).astype(np.int64)

    @staticmethod
    def _runs(words: np.ndarray, first: np.ndarray, q: int) -> np.ndarray:
        """Hashes of the runs of q words inside rows."""
        counts = np.maximum(np.diff(first) - q + 1, 0)
        at = np.arange(counts.sum()) + np.repeat(first[:-1] - np.cumsum(counts) + counts, counts)
        return arrays.RangeHash(words)(at, at + q)

    @staticmethod
    def _gather(words: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
        """Windows of ``width`` words from ``begin``, 0 from ``end`` on and before place 0."""
        at = begin[:, None] + np.arange(width)
        inside = (at < end[:, None]) & (at >= 0)
        return np.where(inside, words[np.where(inside, at, 0)] if len(words) else 0, np.uint64(0))

    def edits(self, length: int) -> int:
        return int(self.rate * length)

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Row, item, edits, and the passage's bytes in the row: the best place of each item in each row."""
        words, starts, ends, first = word_hashes(data, offsets)
        if not len(words) or not self.classes:
            return []
        row = arrays.row_of(first)
        row_end = first[1:][row]
        at = np.arange(len(words))
        known = {}  # for each q, how many known runs start before each word
        for q in RUNS:
            inside = at + q <= row_end
            hits = np.zeros(len(words), bool)
            hits[inside] = self.known[q][self._slot(self._runs(words, first, q))]
            known[q] = np.concatenate([[0], np.cumsum(hits)])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for width, edits, tables in self.classes:
            end = np.minimum(at + width, row_end)
            may = np.ones(len(words), bool)
            for q in RUNS:
                may &= known[q][np.maximum(end - q + 1, at)] - known[q][at] >= width - q + 1 - q * edits
            left, step = at[may], max(1, WINDOW_WORDS // width)
            for low in range(0, len(left), step):
                begin = left[low:low + step]
                windows = self._gather(words, begin, row_end[begin], width)
                self._verify(self._candidates(windows, tables), begin, words, first, row, best)
        return [(r, i, e, int(starts[a] - offsets[r]), int(ends[b - 1] - offsets[r])) for (r, i), (e, a, b) in sorted(best.items())]

    def _candidates(self, windows: np.ndarray, tables: list) -> np.ndarray:
        """Distinct pairs of a window and an item that agree in a table."""
        found = []
        for number, (values, own) in enumerate(tables):
            samples = _samples(windows, self.seed, number)
            left, right = np.searchsorted(values, samples), np.searchsorted(values, samples, "right")
            hit = np.flatnonzero(right > left)
            counts = (right - left)[hit]
            which = np.repeat(left[hit] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            found.append(np.stack([np.repeat(hit, counts), own[which]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def _verify(self, pairs, begin, words, first, row, best) -> None:
        """Compare candidates with whole items and keep the best place by row and item."""
        for low in range(0, len(pairs), 256):
            window, item = pairs[low:low + 256].T
            lengths = self.lengths[item]
            slack = np.array([self.edits(int(n)) for n in lengths], np.int64)
            place = begin[window]
            start = np.maximum(place - slack, first[row[place]])
            stop = np.minimum(place + lengths + slack, first[row[place] + 1])
            items = self._gather(self.words, self.first[item], self.first[item + 1], int(lengths.max()))
            text = self._gather(words, start, stop, int((stop - start).max()))
            edits, end = distances(items, lengths, text)
            for k in np.flatnonzero((edits <= slack) & (end > 0)).tolist():
                n, got, want = int(end[k]), text[k:k + 1, :end[k]][:, ::-1], items[k:k + 1, :lengths[k]][:, ::-1]
                _, back = distances(want, lengths[k:k + 1], got)  # from the end, for where it starts
                span = (int(edits[k]), int(start[k]) + n - int(back[0]), int(start[k]) + n)
                key = (int(row[place[k]]), int(item[k]))
                best[key] = min(best.get(key, span), span)


def item_blocks(benchmark: DataFrame, edit_rate: float, recall: float, seed: int) -> Iterator[Items]:
    """Items in blocks that fit a broadcast; null or wordless items match nothing."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, ceil(n / BLOCK_ITEMS), ceil(size / (5 * BLOCK_WORDS)))
    for block in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        usable = [(r.item_id, r.text) for r in own if r.item_id is not None]
        yield Items([i for i, _ in usable], [t for _, t in usable], edit_rate, recall, seed)


def find(docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE, recall: float = RECALL, seed: int = 11,
         id: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages of ``benchmark`` (item_id, text) in documents: doc_id, item_id, edits, start, end.

    A passage is reported if at most ``edit_rate`` of its words are changed, left out or added.
    ``edits`` are those of its best place, ``start`` and ``end`` (exclusive) this place in code points.
    Null and empty texts and items match nothing, nor do items with a null id.  Repeated
    documents or items are reported as often as they come, a null document id as null.
    Columns besides those named are ignored.
    """
    source, found = common.id_and_text(docs, id, text), None
    for items in item_blocks(benchmark, edit_rate, recall, seed):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part in arrays.slices(batches, size=SLICE_BYTES):
                data, offsets = arrays.text_bytes(part.column(1))
                hits = sent.value.hits(data, offsets)
                raw = data.tobytes()
                place = lambda r, b: len(raw[offsets[r]:offsets[r] + b].decode("utf-8"))
                yield pa.record_batch({
                    "doc_id": part.column(0).take(pa.array([h[0] for h in hits], pa.int64())),
                    "item_id": pa.array([int(sent.value.ids[h[1]]) for h in hits], pa.int64()),
                    "edits": pa.array([h[2] for h in hits], pa.int64()),
                    "start": pa.array([place(h[0], h[3]) for h in hits], pa.int64()),
                    "end": pa.array([place(h[0], h[4]) for h in hits], pa.int64())})

        part = source.mapInArrow(search, "doc_id long, item_id long, edits long, start long, end long")
        found = part if found is None else found.unionByName(part)
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE, recall: float = RECALL,
                         seed: int = 11, text: str = "text") -> DataFrame:
    """The documents, with all their columns, in which ``find`` reports no passage."""
    at = docs.columns.index(text)
    for items in item_blocks(benchmark, edit_rate, recall, seed):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for part in arrays.slices(batches, text, SLICE_BYTES):
                clean = np.ones(part.num_rows, bool)
                clean[[h[0] for h in sent.value.hits(*arrays.text_bytes(part.column(at)))]] = False
                yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
