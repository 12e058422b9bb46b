"""Token counts by a two-tier lookup on the map side.

1. Every task counts its own pre-tokens and hands on the most frequent ones, a bounded number
   of rows.  Their sum over all tasks gives the frequent pre-tokens of the whole table.
2. Their lengths in tokens go to all workers as a hash table of fixed size.  A pre-token that
   is not in it is looked up in the worker's own cache, and encoded there once if it is new.

Which pre-tokens are in the table decides the time only, never a count.  No pre-token is
shuffled: the exchange of step 1 has ``PER_TASK`` rows per task at most.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import arrays, common
from gazette_lake.llm.encoders import PieceTexts, load

FREQUENT = 1 << 15  # entries of the table at most
TABLE_BITS = 18  # its slots: 2**18 of 12 bytes, 3 MB, and the pre-tokens' characters, 8 MB at most
PER_TASK = 1 << 11  # pre-tokens that a task hands on
HELD = 1 << 18  # distinct pre-tokens that a task counts at a time
LONGEST = 64  # characters of a pre-token in the table; longer ones are left to the workers' caches


def frequent_pieces(docs: DataFrame, tokenizer: str, tables: Broadcast) -> DataFrame:
    """Frequent pre-tokens of all texts, with their counts, the most frequent first.

    A task that meets more than ``HELD`` distinct ones goes on with the more frequent half.  Two that
    share a hash count as one here, which decides no count of tokens.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = common.encoder(tokenizer, tables, word_level=False)
        held: dict[int, list] = {}
        most = lambda n: sorted(held.items(), key=lambda x: -x[1][0])[:n]
        for rows in arrays.slices(batches):
            cp, starts, ends, _ = encoder.pieces(*arrays.text_bytes(rows.column(0)))
            short = ends - starts <= LONGEST
            starts, ends = starts[short], ends[short]
            keys, first, counts = np.unique(
                arrays.RangeHash(cp)(starts, ends), return_index=True, return_counts=True)
            for key, at, n in zip(keys.tolist(), first.tolist(), counts.tolist()):
                if key in held:
                    held[key][0] += n
                else:
                    held[key] = [n, cp[starts[at]:ends[at]].copy()]  # no view, which would keep the whole slice
            if len(held) > HELD:
                held = dict(most(HELD // 2))
        top = [(piece.tobytes().decode("utf-32-le"), n) for _, (n, piece) in most(PER_TASK)]
        yield pa.record_batch({
            "piece": pa.array([piece for piece, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})

    found = docs.select("text").mapInArrow(count, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(FREQUENT)


class LengthTable:
    """Token counts of frequent pre-tokens by hash.  Of those that share a slot, the most frequent is kept."""

    def __init__(self, pieces: list[str], tokenizer: str):
        self.key = np.zeros(1 << TABLE_BITS, np.uint64)
        self.number = np.zeros(1 << TABLE_BITS, np.int32)
        self.texts = PieceTexts(pieces)
        encoded = load(tokenizer).encode_batch_fast(pieces, add_special_tokens=False)
        self.length = np.array([len(tokens.ids) for tokens in encoded] or [0], np.int64)
        for number in range(len(pieces) - 1, -1, -1):
            cp = np.frombuffer(pieces[number].encode("utf-32-le"), np.uint32)
            key = arrays.RangeHash(cp)(np.array([0]), np.array([len(cp)]))[0]
            slot = int(key >> np.uint64(64 - TABLE_BITS))
            self.key[slot], self.number[slot] = key, number

    def look_up(self, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths, and which pre-tokens have none here.  Those with an entry's hash are compared with it."""
        hashes = arrays.RangeHash(cp)(starts, ends)
        slot = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        number = self.number[slot]
        missed = self.key[slot] != hashes
        hit = np.flatnonzero(~missed)
        missed[hit] = ~self.texts.same(cp, starts[hit], ends[hit], number[hit])
        return self.length[number], missed


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than ``limit`` tokens.

    Counts equal those of the tokenizers library without added tokens, for a file with the
    byte-level pattern.  A null text is an empty one.  A null id stays null, repeated rows stay,
    an empty table gives no rows.  Columns besides id and text are ignored.
    """
    source = common.id_and_text(docs, id, text)
    session = docs.sparkSession.sparkContext
    tables = common.send_tables(docs.sparkSession)
    frequent = [row.piece for row in frequent_pieces(source, tokenizer, tables).collect()]  # FREQUENT rows at most
    table = session.broadcast(LengthTable(frequent, tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = common.encoder(tokenizer, tables, word_level=False)
        for rows in arrays.slices(batches):
            data, offsets = arrays.text_bytes(rows.column(1))
            cp, starts, ends, first = encoder.pieces(data, offsets)
            lengths, missed = table.value.look_up(cp, starts, ends)
            missed = np.flatnonzero(missed)
            lengths[missed] = encoder.counts(cp, starts[missed], ends[missed])
            tokens = arrays.sum_rows(lengths, first)
            for row, whole in encoder.special_rows(data, offsets).items():
                tokens[row] = len(encoder.whole.encode(whole, add_special_tokens=False).ids)
            yield pa.record_batch({
                "doc_id": rows.column(0), "n_bytes": pa.array(np.diff(offsets)), "n_tokens": pa.array(tokens),
                "over_limit": pa.array(tokens > limit)})

    return source.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
