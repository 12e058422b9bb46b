"""Nearest vectors by inner product: randomly rotated one-bit codes, error bounds, exact reranking.

A vector less the mean of all, rotated at random, keeps the signs of its components: ``dim`` bits, and
with them two numbers, its length and how well its signs stand for its direction.  From bits and
numbers follow an estimate of its inner product with a query and a bound of the error (that of the
RaBitQ paper): the part of the direction that the signs miss lies in a random direction to the query, so
its share is about 1 / sqrt(dim - 1) of its length, ``SIGMAS`` times which is allowed for.

1. Every vector is encoded and written beside its code; the index holds all rows.
2. Queries are sent to all tasks in waves of bounded bytes.  A task reads its part of the index in blocks.
   The best exact products seen so far set a query's limit; only vectors whose estimate plus
   bound reaches the limit are reranked, that is, multiplied exactly.  What reaches the limit by
   estimate is never capped.
3. A task returns its best ``k`` per query; the best of all tasks are the answer.

Work is that of a stated query set against all rows, in blocks; memory depends on block and wave only.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette_lake.session import stage

SIGMAS = 2.0  # a vector's error is beyond the bound in one of 40 cases; it is lost only if it is that close to the limit, too
SEED = 20240603
WAVE_BYTES = 1 << 24  # of query vectors sent at a time
BLOCK, TILE = 4096, 512  # vectors and queries compared at a time
FIRST = 4  # times k vectors are multiplied first, for a query's first limit
EXACT_VALUES = 1 << 21  # components multiplied exactly at a time

_INDEX = "row long, vec_id long, vector array<double>, bits binary, norm double, align double"
_FOUND = "query_row long, query_id long, vec_id long, vec_row long, score double"


def usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of vectors that are not null, not zero, and have finite components only."""
    values = F.col("vector")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return kept.filter(F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False)))


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same for a seed on every machine."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bits, length, and alignment of the signs with the direction, of vectors less the mean."""
    rest = vectors - mean
    with np.errstate(over="ignore", invalid="ignore"):
        norm = np.sqrt((rest * rest).sum(1))
        turned = rest @ turn
        align = np.abs(turned).sum(1) / np.sqrt(turned.shape[1]) / np.where(norm > 0, norm, 1)
    return np.packbits(turned > 0, axis=1), norm, np.where(norm > 0, align, 1.0)


def build_index(vectors: DataFrame, dim: int, mean: np.ndarray, seed: int = SEED) -> DataFrame:
    """Every vector of ``vectors`` (row, vec_id, vector) with its code."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim, seed)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                bits, norm, align = encode(matrix(part.column(2), dim), mean, turn)
                yield pa.record_batch([
                    *part.columns, pa.array([row.tobytes() for row in bits], pa.binary()),
                    pa.array(norm), pa.array(align)], names=["row", "vec_id", "vector", "bits", "norm", "align"])

    return vectors.mapInArrow(code, _INDEX)


class Best:
    """The best ``k`` exact products of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.limit = k, np.full(queries, -np.inf)
        self.query, self.id, self.row, self.score = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, float))

    def add(self, query: np.ndarray, id: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        if not len(query):
            return
        self.query, self.id = np.concatenate([self.query, query]), np.concatenate([self.id, id])
        self.row, self.score = np.concatenate([self.row, row]), np.concatenate([self.score, score])
        order = np.lexsort([self.row, self.id, -self.score, self.query])
        place = np.arange(len(order))
        first = np.ones(len(order), bool)
        first[1:] = np.diff(self.query[order]) != 0
        rank = place - np.maximum.accumulate(np.where(first, place, 0))
        last = order[rank == self.k - 1]
        self.limit[self.query[last]] = self.score[last]
        kept = order[rank < self.k]
        self.query, self.id, self.row, self.score = self.query[kept], self.id[kept], self.row[kept], self.score[kept]


def products(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows ``left`` of ``a`` with rows ``right`` of ``b``, each summed in the same order."""
    out = np.empty(len(left))
    step = max(1, EXACT_VALUES // max(1, a.shape[1]))
    for i in range(0, len(left), step):
        out[i:i + step] = (a[left[i:i + step]] * b[right[i:i + step]]).sum(1)
    return out


class Searcher:
    """One wave of queries, met by block after block of the index."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray, k: int, sigmas: float):
        self.rows, self.vectors, self.k, self.reranked = rows, vectors, k, 0
        largest = np.abs(vectors).max(1)
        unit = vectors / largest[:, None]
        self.size = largest * np.sqrt((unit * unit).sum(1))
        unit = vectors / self.size[:, None]  # estimates are for queries of length 1
        self.turned, self.base = (unit @ turn).astype(np.float32), unit @ mean
        self.slack = sigmas / np.sqrt(max(1, vectors.shape[1] - 1))
        self.tiles = [slice(at, min(at + TILE, len(rows))) for at in range(0, len(rows), TILE)]
        self.best = [Best(tile.stop - tile.start, k) for tile in self.tiles]

    def block(self, rows, ids, vectors, bits, norm, align) -> None:
        dim = vectors.shape[1]
        signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
        with np.errstate(all="ignore"):  # a vector too long to be estimated is reranked
            known = np.isfinite(norm)
            scale = np.where(known, norm / (align * np.sqrt(dim)), 0)
            reach = self.slack * np.sqrt(np.maximum(0, 1 - align * align)) / align + 1e-6
            reach = np.where(known, norm * reach, np.inf)
            for tile, best in zip(self.tiles, self.best):
                estimate = (self.turned[tile] @ signs.T) * scale + self.base[tile, None]
                own = self.rows[tile, None] == rows[None, :]  # a query is no candidate of its own
                estimate[own] = -np.inf
                self._first_limits(tile, best, estimate, rows, vectors)
                wanted = ~(estimate + reach < (best.limit / self.size[tile])[:, None]) & ~own
                self._rerank(tile, best, wanted, rows, ids, vectors)

    def _first_limits(self, tile, best, estimate, rows, vectors) -> None:
        """Queries without a limit get one from the best by estimate; those come again when reranked."""
        new, some = np.flatnonzero(best.limit == -np.inf), FIRST * self.k
        if estimate.shape[1] > some + 1 and len(new):
            chosen = np.argpartition(-estimate[new], some, axis=1)[:, :some]
            query, vector = np.repeat(new, some), chosen.ravel()
            score = products(self.vectors[tile], vectors, query, vector)
            score[self.rows[tile][query] == rows[vector]] = -np.inf
            best.limit[new] = np.partition(score.reshape(-1, some), some - self.k, axis=1)[:, some - self.k]

    def _rerank(self, tile, best, wanted, rows, ids, vectors) -> None:
        query, vector = np.nonzero(wanted)
        self.reranked += len(query)
        score = products(self.vectors[tile], vectors, query, vector)
        reach = score >= best.limit[query]
        best.add(query[reach], ids[vector[reach]], rows[vector[reach]], score[reach])

    def found(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Number of the query, id and row of the vector, score."""
        for tile, best in zip(self.tiles, self.best):
            yield best.query + tile.start, best.id, best.row, best.score


def _search_wave(index: DataFrame, wave, dim: int, mean: np.ndarray, k: int, sigmas: float, seed: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, vectors = wave.value
        searcher = Searcher(rows, vectors, mean, rotation(dim, seed), k, sigmas)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                bits = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                number = lambda i: part.column(i).to_numpy(zero_copy_only=False)
                searcher.block(number(0), number(1), matrix(part.column(2), dim), bits, number(4), number(5))
        for query, vec_id, vec_row, score in searcher.found():
            yield pa.record_batch({
                "query_row": pa.array(rows[query]), "query_id": pa.array(ids[query]), "vec_id": pa.array(vec_id),
                "vec_row": pa.array(vec_row), "score": pa.array(score)})

    return index.mapInArrow(search, _FOUND)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, sigmas: float = SIGMAS, seed: int = SEED,
            id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` largest inner products of each query with all other rows, best first, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``.  Scores are inner products of the vectors as
    given, in double precision.  A repeated row is a candidate of its copies; a query id that comes twice
    is answered twice.  Vectors that are null, zero or hold a null, NaN or infinite component take no
    part, and neither do rows without an id.  Vectors of several lengths are searched among their own
    length.  An empty table, or one without queries, gives no rows.  Columns not named are ignored.
    """
    spark = vectors.sparkSession
    kept = usable(vectors, id, vector).filter("vec_id is not null")
    kept = stage(kept.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "vector"), "vectors")
    query = F.col("vec_id") % every == 0
    lengths = kept.groupBy(F.size("vector").alias("dim")).agg(F.count(F.when(query, 1)).alias("queries")).filter("queries > 0")
    found = []
    for dim, queries in sorted(tuple(row) for row in lengths.collect()):  # one row per length of vectors
        same = kept.filter(F.size("vector") == dim)
        mean = _mean(same, dim)
        index = stage(build_index(same, dim, mean, seed), "index")
        waves = -(-queries * 8 * dim // WAVE_BYTES)
        number = F.pmod(F.xxhash64("row"), F.lit(waves))
        for wave in range(waves):
            sent = index.filter(query & (number == wave)).select("row", "vec_id", "vector").toArrow()  # WAVE_BYTES or so
            if sent.num_rows:
                whole = sent.combine_chunks()
                columns = [whole.column(i).to_numpy() for i in (0, 1)]
                values = whole.column(2).combine_chunks()
                sent = spark.sparkContext.broadcast((*columns, matrix(values, dim)))
                found.append(stage(_search_wave(index, sent, dim, mean, k, sigmas, seed), "found"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    union = found[0]
    for more in found[1:]:
        union = union.unionAll(more)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = union.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _mean(vectors: DataFrame, dim: int) -> np.ndarray:
    """Mean of all vectors; ``dim`` numbers reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for batch in batches:
            total += matrix(batch.column(0), dim).sum(0)
            n += batch.num_rows
        if n:
            yield pa.record_batch({"at": pa.array(np.arange(dim)), "total": pa.array(total), "n": pa.repeat(n, dim).cast(pa.int64())})

    sums = vectors.select("vector").mapInArrow(add, "at long, total double, n long")
    rows = sums.groupBy("at").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    mean = np.zeros(dim)
    for row in rows:
        mean[row["at"]] = row["mean"]
    return mean if np.isfinite(mean).all() else np.zeros(dim)
