"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered in the order of their ids.  A keyed permutation of 0..n-1 moves row number
``r`` to place ``p``; its shard is ``p mod shards`` and its slot ``p div shards``.  So shard
counts differ by one at most, slots have no gaps, and anyone who knows n and the seed can
compute where a row is, or, with the inverse, which row is at a place.

Numbering takes two passes over narrow rows (no text): sort by ranges of ids, then add the
number of rows in the ranges before.  Only one count per range reaches the driver.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import common
from gazette_lake.llm.arrays import mix
from gazette_lake.session import stage

ROUNDS = 6


class Feistel:
    """A permutation of 0..n-1.  Numbers that leave the range walk on until they are back in it."""

    def __init__(self, n: int, seed: int, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mix(np.uint64(seed % (1 << 64)) + np.arange(1, rounds + 1, dtype=np.uint64))

    def _once(self, value: np.ndarray, keys: np.ndarray) -> np.ndarray:
        left, right = value >> self.half, value & self.mask
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & self.mask)
        return (right << self.half) | left  # halves swapped, so that the same walk with keys reversed undoes it

    def _walk(self, numbers: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = self._once(numbers.astype(np.uint64), keys)
        outside = np.flatnonzero(out >= np.uint64(self.n))
        while len(outside):
            out[outside] = self._once(out[outside], keys)
            outside = outside[out[outside] >= np.uint64(self.n)]
        return out.astype(np.int64)

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self.keys)

    def inverse(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, self.keys[::-1])


def row_numbers(rows: DataFrame, *order: str) -> tuple[DataFrame, np.ndarray]:
    """The written rows with ``_part`` and ``_pos``, and each part's first row number.

    ``rows`` should be a written table: ranges are sampled first.  The row's place in its file
    is the last sort key, so that any number of equal rows is spread too.
    """
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(*order, "_at").sortWithinPartitions(*order, "_at").drop("_at")
    index = F.monotonically_increasing_id()
    written = stage(dealt.withColumns({
        "_part": F.shiftright(index, 33).cast("int"), "_pos": index.bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    counts = dict(written.groupBy("_part").count().collect())
    sizes = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
    return written, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def shard(docs: DataFrame, shards: int = 40, seed: int = 20240521, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard and slot of every document; law ``rows``: shard counts are at most one apart.

    Size is the text's UTF-8 bytes plus 16.  A null text has no bytes and the checksum 0; a null
    id comes first.  Repeated rows have places of their own.  An empty table gives no rows.
    Columns besides id and text are ignored.
    """
    source = common.id_and_text(docs, id, text)
    narrow = stage(source.select(
        "doc_id", (common.utf8_bytes(F.col("text")) + 16).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("_text")), "sizes")
    written, before = row_numbers(narrow, "doc_id", "size", "text_crc32", "_text")
    total = int(before[-1])
    sent = docs.sparkSession.sparkContext.broadcast(before)  # 8 bytes per range of rows

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutation = Feistel(total, seed)
        for rows in batches:
            part, pos = rows.column(3).to_numpy(), rows.column(4).to_numpy()
            to = permutation(sent.value[part] + pos)
            yield pa.record_batch({
                "doc_id": rows.column(0), "size": rows.column(1), "text_crc32": rows.column(2),
                "law": pa.repeat("rows", rows.num_rows), "shard": pa.array((to % shards).astype(np.int32)),
                "slot": pa.array(to // shards), "grown_shard": pa.nulls(rows.num_rows, pa.int32())})

    return written.select("doc_id", "size", "text_crc32", "_part", "_pos").mapInArrow(
        place, "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
