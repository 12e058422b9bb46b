"""Very many small files, listed where they are read.

Spark's file sources gather the names of all files on the driver before anything is read.  Here a
partition is a prefix (a folder below the root: a day, a company, a hash), and its files are listed and read by the
task that has it; the driver knows prefixes only.  Files come in batches of bounded size, in the order of their names.

Works for stores that Arrow reads: local and mounted folders, HDFS, S3, GCS.  For others use the readers of ``landed``.
"""

from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH_FILES, BATCH_BYTES = 1024, 1 << 25
_SCHEMA = "prefix string, path string, modified timestamp, n_bytes bigint, content binary"


class Prefix(InputPartition):
    def __init__(self, name: str):
        self.name = name


class PrefixReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.pattern = options["path"].rstrip("/"), options.get("pattern", "*")
        self.named, self.content = options.get("prefixes"), options.get("content", "true") == "true"

    def partitions(self) -> list[Prefix]:
        """One per prefix: those named, or the folders right below the root."""
        if self.named is not None:
            return [Prefix(name) for name in self.named.split("\n") if name]
        store, root = fs.FileSystem.from_uri(self.root)
        found = store.get_file_info(fs.FileSelector(root))
        return [Prefix(info.base_name) for info in sorted(found, key=lambda info: info.path) if info.type == fs.FileType.Directory]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(self.root)
        listed = store.get_file_info(fs.FileSelector(f"{root}/{partition.name}", recursive=True, allow_not_found=True))
        held, size = [], 0
        for info in sorted(listed, key=lambda info: info.path):
            hidden = info.path[len(root):].split("/")[2:]
            if info.type != fs.FileType.File or not fnmatch(info.base_name, self.pattern) or any(part[:1] in "._" for part in hidden):
                continue
            if held and (len(held) == BATCH_FILES or size + info.size > BATCH_BYTES):
                yield self._batch(held)
                held, size = [], 0
            content = None
            if self.content:
                with store.open_input_stream(info.path) as stream:
                    content = stream.read()
                size += info.size
            held.append((partition.name, info.path, info.mtime, info.size, content))
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        types = [pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.binary()]
        names = ["prefix", "path", "modified", "n_bytes", "content"]
        return pa.record_batch([pa.array(column, type) for column, type in zip(columns, types)], names=names)


class PrefixedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "prefixed_files"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> PrefixReader:
        return PrefixReader(dict(self.options))


def read_files(spark: SparkSession, root: str, pattern: str = "*", prefixes: list[str] | None = None, content: bool = True) -> DataFrame:
    """(prefix, path, modified, n_bytes, content) of files below ``root``, one partition per prefix.

    ``prefixes`` are folders below the root, by default all of them; one that does not exist is empty.  Names that begin with
    a dot or an underscore are passed by.  Without ``content`` no file is opened.
    """
    spark.dataSource.register(PrefixedFiles)
    reader = spark.read.format("prefixed_files").option("pattern", pattern).option("content", str(content).lower())
    if prefixes is not None:
        reader = reader.option("prefixes", "\n".join(prefixes))
    return reader.load(root)
