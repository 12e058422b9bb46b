"""Best-fit packing of token sequences, with a bounded number of open bins.

1. Every text is encoded where it lies.  A document longer than a bin is cut into full bins
   and a rest.  The pieces, narrow rows without ids, are written to the shared folder.
2. The pieces are dealt by a hash, also of their places in that table, into tasks of some hundred thousand each and packed online:
   a piece goes to the open bin that it fills best; where none has room, a new bin is opened;
   if too many are open, the fullest is closed first.

A task leaves at most a fixed number of partly filled bins, so waste falls with the number of
pieces per task.  Nothing is gathered by key, so no source or group of copies makes a task
large.  Both steps give the same rows when a task is repeated.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import arrays, common
from gazette_lake.session import stage

OPEN_BINS = 1024
PIECES_PER_TASK = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of each document's ids: full ones, and a rest.  Columns of ``PIECES``."""
    tables = common.send_tables(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = common.encoder(tokenizer, tables, word_level=True)
        for rows in arrays.slices(batches):
            ids, limits = encoder.encode(*arrays.text_bytes(rows.column(1)), end_id)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            lengths = np.diff(limits)
            counts = -(-lengths // capacity)
            row = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * capacity
            length = np.minimum(lengths[row] - start, capacity)
            at = limits[row] + start
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            yield pa.record_batch({
                "doc_id": rows.column(0).take(pa.array(row)), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64())})

    return common.id_and_text(docs, id, text).mapInArrow(pieces, PIECES)


class OpenBins:
    """Open bins by free space; a bitset tells which free spaces occur."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.occurs = self.open = self.opened = 0

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.occurs &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece of 1 to ``capacity`` tokens."""
        fitting = self.occurs >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            into = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.occurs & -self.occurs).bit_length() - 1)
            free, into = self.capacity, self.opened
            self.opened += 1
        left = free - length
        if left:
            self.bins[left].append(into)
            self.occurs |= 1 << left
            self.open += 1
        return into, self.capacity - free


def pack(pieces: DataFrame, capacity: int, open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    ``pieces`` should be a written table: its rows are counted first, and equal rows are told apart by their places in it.
    """
    tasks = max(1, -(-pieces.count() // pieces_per_task))
    placed = pieces.withColumn("_at", F.monotonically_increasing_id())
    own = F.xxhash64("_at", *pieces.columns)
    dealt = placed.repartition(tasks, own).sortWithinPartitions(own, *pieces.columns, "_at").drop("_at")
    numbered = dealt.withColumn("_task", F.spark_partition_id().cast("long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        for rows in batches:
            lengths = rows.column(rows.schema.get_field_index("length")).to_pylist()
            task = rows.column(rows.num_columns - 1).to_numpy()
            placed = np.array([bins.place(n) for n in lengths], np.int64).reshape(-1, 2)
            columns = {name: rows.column(i) for i, name in enumerate(rows.schema.names[:-1])}
            yield pa.record_batch(columns | {
                "sequence_id": pa.array((task << 40) + placed[:, 0]), "offset": pa.array(placed[:, 1])})

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(place, schema)


def best_fit(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, open_bins: int = OPEN_BINS,
             id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens; one row per piece.

    A null text is an empty one: its only token is ``end_id``.  Repeated rows are packed as
    often as they come; a null id stays null.  An empty table gives no rows.  Columns besides
    id and text are ignored.
    """
    return pack(stage(cut(docs, tokenizer, end_id, capacity, id, text), "pieces"), capacity, open_bins)
