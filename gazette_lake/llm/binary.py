"""Token ids in Arrow files: batches of equal-length sequences with masks.

A file is an Arrow IPC file whose columns are fixed-size lists: ``ids`` (16 bits where the
vocabulary allows, else 32), ``mask`` (true: a token, false: padding) and ``ends`` (true: the last token
of a document).  Any batch can be mapped and read without copying or reading what stands
before it.  Beside it lies an index file with the ids of its documents in order.

Documents are sorted by id over all files.  Each task writes files under names of its own and
reports them in its rows; a lost or repeated task leaves files that no report names.  The
folder must be on a file system that Arrow opens (local or mounted, hdfs, s3, gs).
"""

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import arrays, common
from gazette_lake.llm.encoders import load
from gazette_lake.session import new_folder, stage

LENGTH = 2048
BATCH = 128  # sequences per batch
INDEX = pa.schema([("doc_id", pa.int64())])


def schema(length: int, small_ids: bool) -> pa.Schema:
    flag = pa.list_(pa.bool_(), length)
    return pa.schema([
        ("ids", pa.list_(pa.uint16() if small_ids else pa.uint32(), length)), ("mask", flag), ("ends", flag)])


class SequenceWriter:
    """Cuts a stream of documents' ids into sequences and writes them batch by batch."""

    def __init__(self, path: str, length: int, small_ids: bool):
        self.store, self.path = fs.FileSystem.from_uri(path)
        self.length, self.dtype = length, np.dtype("<u2" if small_ids else "<u4")
        self.schema = schema(length, small_ids)
        self.held = [(np.zeros(0, self.dtype), np.zeros(0, bool))]
        self.n_held = self.tokens = self.documents = 0
        self.out = self.store.open_output_stream(self.path)
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.index_out = self.store.open_output_stream(f"{self.path}.index")
        self.index = pa.ipc.new_file(self.index_out, INDEX)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, limits: np.ndarray) -> None:
        """Rows of documents; each has one id at least."""
        ends = np.zeros(len(ids), bool)
        ends[limits[1:] - 1] = True
        self.index.write(pa.record_batch([doc_ids.cast(pa.int64())], schema=INDEX))
        self.documents += len(doc_ids)
        self.held.append((ids.astype(self.dtype), ends))
        self.n_held += len(ids)
        size = self.length * BATCH
        if self.n_held >= size:
            ids, ends = self._joined()
            whole = self.n_held // size * size
            for at in range(0, whole, size):
                self._write(ids[at:at + size], ends[at:at + size], size)
            self.held, self.n_held = [(ids[whole:], ends[whole:])], self.n_held - whole

    def _joined(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([a for a, _ in self.held]), np.concatenate([b for _, b in self.held])

    def _write(self, ids: np.ndarray, ends: np.ndarray, n: int) -> None:
        pad = -n % self.length
        ids, ends = np.pad(ids, (0, pad)), np.pad(ends, (0, pad))
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, np.arange(n + pad) < n, ends)]
        self.file.write_batch(pa.record_batch(lists, schema=self.schema))
        self.tokens += n

    def close(self) -> None:
        if self.n_held:
            self._write(*self._joined(), self.n_held)
        for x in (self.file, self.out, self.index, self.index_out):
            x.close()


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = LENGTH,
          id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents in ascending id order; one row per file: part, path, documents, tokens.

    A null text is an empty one: its only id is ``end_id``.  A null id comes first and stays
    null.  Equal ids stand in the order of the input.  An empty table gives no files.
    Columns besides id and text are ignored.
    """
    tables = common.send_tables(docs.sparkSession)
    small = load(tokenizer).get_vocab_size() <= 1 << 16
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1])
    order = ["doc_id", "_at"]  # the place in the input spreads any number of rows with one id
    rows = common.id_and_text(docs, id, text).withColumn("_at", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, part = common.encoder(tokenizer, tables, word_level=True), None, None
        for rows in arrays.slices(batches):
            part = rows.column(2)[0].as_py()
            writer = writer or SequenceWriter(f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow", length, small)
            writer.add(rows.column(0), *encoder.encode(*arrays.text_bytes(rows.column(1)), end_id))
        if writer:
            writer.close()
            name = writer.path.rsplit("/", 1)[1]
            yield pa.record_batch({"part": [part], "path": [f"{folder}/{name}"], "documents": [writer.documents],
                                   "tokens": [writer.tokens]})

    numbered = dealt.select("doc_id", "text", F.spark_partition_id().alias("part"))
    return stage(numbered.mapInArrow(encode, "part long, path string, documents long, tokens long"), "files")


def _documents(path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each batch of a file: ids without padding, and where documents end in them."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as source:
        file = pa.ipc.open_file(source)
        for i in range(file.num_record_batches):
            batch = file.get_batch(i)
            ids, mask, ends = (batch.column(k).flatten() for k in range(3))
            n = mask.true_count
            yield ids.to_numpy()[:n], np.flatnonzero(ends.to_numpy(zero_copy_only=False)[:n]) + 1


def read_documents(files: DataFrame) -> DataFrame:
    """Documents of written files: doc_id, start among all ids, n_tokens, ids_crc32 (as 32-bit ids).

    One task reads one file.  The list of files, a row for each writing task, is the only thing
    the driver holds.
    """
    found = files.orderBy("part").collect()
    before = np.concatenate([[0], np.cumsum([row.tokens for row in found])]).astype(np.int64)
    spark = files.sparkSession
    sent = spark.sparkContext.broadcast([(row.path, int(n)) for row, n in zip(found, before)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for which in batches:
            for i in which.column(0).to_pylist():
                path, start = sent.value[i]
                store, name = fs.FileSystem.from_uri(f"{path}.index")
                with store.open_input_file(name) as source:
                    doc_ids = pa.ipc.open_file(source).read_all().column(0).combine_chunks()
                done, crc, size = 0, 0, 0
                for ids, ends in _documents(path):
                    raw = memoryview(ids.astype("<u4")).cast("B")
                    sizes, crcs, at = [], [], 0
                    for end in ends.tolist():
                        sizes.append(size + end - at)
                        crcs.append(zlib.crc32(raw[4 * at:4 * end], crc))
                        at, size, crc = end, 0, 0
                    size, crc = size + len(ids) - at, zlib.crc32(raw[4 * at:], crc)
                    lengths = np.array(sizes, np.int64)
                    yield pa.record_batch({
                        "doc_id": doc_ids.slice(done, len(sizes)), "start": pa.array(start + np.cumsum(lengths) - lengths),
                        "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crcs, pa.int64())})
                    done, start = done + len(sizes), start + int(lengths.sum())

    numbers = spark.range(0, len(found), 1, max(1, len(found)))
    return numbers.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_to_files(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH, **names: str) -> DataFrame:
    """Write all documents to a new folder and read them back; see ``write`` and ``read_documents``."""
    return read_documents(write(docs, new_folder(docs.sparkSession, "ids"), tokenizer, end_id, length, **names))
