"""Spelling variants: words one code point apart, and the far more frequent one as the form of the rarer.

Neighbours are found by a bit-sliced position index.  For every position and letter a bitset says
which words of a block have that letter there.  A word's letters are read one after the other, and three
sets advance with each, 64 words an operation: words equal so far, words with one replaced letter so far,
and, with positions shifted by one, words that lack one letter so far.  At the end the sets hold all
words at distance one that are as long, or one shorter; those one longer find this word themselves.

A vocabulary is dealt into blocks before that, losing no pair.  Two words that differ by one code point, the
longer of length L, agree in their first (L - 1) div 2 code points or, behind the difference, in the rest
that the shorter can have.  So a word takes part under four keys: its beginning and its end, each for L
being its own length and one more.  Keys are hashed to buckets; a bucket that is too large for a
block is cut, and every two of its blocks meet.  What comes back is one row per word and block, a count
and the best neighbour, never a row per pair.
"""

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm.manifest import ascii_lower
from gazette_lake.session import stage

LETTERS = "[A-Za-zÀ-ÿ]+"
BUCKET_ROWS = 2048  # rows of a bucket, on average
BLOCK_ROWS, BLOCK_CHARACTERS = 4096, 1 << 20  # of one block, on average, where a bucket is larger
_FOUND = "word string, near long, best_n long, best string"


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text", pattern: str = LETTERS) -> DataFrame:
    """(doc_id, run) of every run of letters, A-Z in lower case."""
    found = F.regexp_extract_all(docs[text].cast("string"), F.lit(pattern), F.lit(0))
    opened = docs.select(docs[id].cast("long").alias("doc_id"), F.explode(found).alias("run"))
    return opened.select("doc_id", ascii_lower(F.col("run")).alias("run"))


def misspelt(number: Column, run: Column, every: int = 31) -> Column:
    """The run, one code point left out where ``every`` divides the crc32 of ``<number>:<run>``."""
    hashed = F.crc32(F.concat(F.coalesce(number.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (hashed % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(hashed % every == 0, cut).otherwise(run)


def vocabulary(words: DataFrame, least_length: int = 7, least_n: int = 2) -> DataFrame:
    """(word, n) of the words long and frequent enough.  Counted before the shuffle, so a frequent word is no load."""
    long_enough = words.filter(F.char_length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_n)


def keyed(words: DataFrame) -> DataFrame:
    """Every word under its four keys: (word, n, length, longer, ahead, key)."""
    length = F.col("length")

    def under(longer: Column) -> list[Column]:
        head = F.floor((longer - 1) / 2).cast("int")
        tail = longer - 1 - head
        parts = ((True, F.substring("word", F.lit(1), head)), (False, F.substring("word", length - tail + 1, tail)))
        return [F.struct(
            longer.alias("longer"), F.lit(ahead).alias("ahead"), F.xxhash64(longer, F.lit(ahead), part).alias("key"))
            for ahead, part in parts]

    sized = words.select("word", "n", F.char_length("word").alias("length"))
    return sized.withColumn("_keys", F.array(*under(length), *under(length + 1))).select(
        "word", "n", "length", F.explode("_keys").alias("_key")).select("word", "n", "length", "_key.*")


def dealt(words: DataFrame) -> DataFrame:
    """Rows of ``keyed`` in blocks (bucket, i, j); ``own`` is the row's own block."""
    total = words.count()
    buckets = max(1, ceil(4 * total / BUCKET_ROWS))
    rows = keyed(words).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    sizes = rows.groupBy("bucket").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("length") / BLOCK_CHARACTERS)).cast("int").alias("blocks"))
    cut = rows.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    opened = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return opened.select(
        "word", "n", "length", "longer", "ahead", "key", "own", "bucket",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def bitset(members: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words; the width is a multiple of 64."""
    return np.packbits(members, axis=1, bitorder="little").view(np.uint64)


def one_apart(codes: np.ndarray, lengths: np.ndarray, longer: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b): row ``a`` has the length ``longer``, row ``b`` follows from it by one replacement or deletion.

    ``codes`` has one word a row, zeros behind its end; lengths are ``longer`` and ``longer - 1``.
    """
    queries = np.flatnonzero(lengths == longer)
    width = -(-len(codes) // 64) * 64
    letters, numbers = np.unique(codes[:, :longer], return_inverse=True)
    numbers = numbers.reshape(len(codes), longer)

    def index(position: int) -> np.ndarray:
        """For each letter, which words have it at the position."""
        has = np.zeros((len(letters), width), bool)
        has[numbers[:, position], np.arange(len(codes))] = True
        if letters[0] == 0:
            has[0] = False
        return bitset(has)

    everyone = np.zeros((1, width), bool)
    everyone[0, :len(codes)] = True
    equal = np.repeat(bitset(everyone), len(queries), 0)
    replaced, shorter = np.zeros_like(equal), np.zeros_like(equal)
    before = None
    for position in range(longer):
        here, letter = index(position), numbers[queries, position]
        if before is not None:
            shorter &= before[letter]  # one letter left out: this one stands one place earlier
        shorter |= equal
        here_has = here[letter]
        replaced &= here_has
        replaced |= equal
        equal &= here_has
        before = here
    same = np.zeros((1, width), bool)
    same[0, queries] = True
    same = bitset(same)
    replaced &= same & ~equal
    shorter &= ~same
    replaced |= shorter
    at, word = np.nonzero(replaced)
    bits = np.unpackbits(replaced[at, word][:, None].view(np.uint8), axis=1, bitorder="little")
    which, bit = np.nonzero(bits)
    return queries[at[which]], word[which] * 64 + bit


def code_points(words: pa.Array, lengths: np.ndarray) -> np.ndarray:
    """One word a row, zeros behind its end."""
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _neighbours(group: pa.Table) -> pa.Table:
    """Count and best neighbour of the words of one block, or of two blocks across."""
    rows = group.sort_by("longer").combine_chunks()
    column = lambda name: rows.column(name).to_numpy()
    words, n, longer, length = rows.column("word").combine_chunks(), column("n"), column("longer"), column("length")
    ahead, key, own = column("ahead"), column("key"), column("own")
    across = column("i")[0] != column("j")[0]
    limits = np.append(np.flatnonzero(np.diff(longer, prepend=-1)), len(longer))
    lefts, rights = [], []
    for begin, end in zip(limits[:-1].tolist(), limits[1:].tolist()):
        size, part = int(longer[begin]), slice(begin, end)
        codes = code_points(words[part], length[part])
        if not (length[part] == size).any():
            continue
        a, b = one_apart(codes, length[part], size)
        # A pair counts under one key: that of the beginning if it is shared, else that of the end.
        head = (size - 1) // 2
        tail = size - 1 - head
        kept = (key[part][a] == key[part][b]) & (ahead[part][a] == ahead[part][b])
        if across:
            kept &= own[part][a] != own[part][b]
        a, b = a[kept], b[kept]
        share = (codes[a, :head] == codes[b, :head]).all(1)
        behind = np.arange(tail)
        ends = (codes[a[:, None], size - tail + behind] == codes[b[:, None], length[part][b][:, None] - tail + behind]).all(1)
        kept = np.where(ahead[part][a], share, ends & ~share)
        a, b = a[kept] + begin, b[kept] + begin
        lefts += [a, b[length[b] < size]]  # replacements are found from both sides, the rest from the longer word
        rights += [b, a[length[b] < size]]
    left, right = (np.concatenate([*side, np.zeros(0, np.int64)]).astype(np.int64) for side in (lefts, rights))
    # Of several neighbours the most frequent, then the smallest: rows ranked once, then a minimum per word.
    text = words.to_pylist()
    order = sorted(range(len(text)), key=lambda i: (-n[i], text[i]))
    rank = np.empty(len(text), np.int64)
    rank[order] = np.arange(len(text))
    best, count = np.full(len(text), len(text)), np.bincount(left, minlength=len(text))
    np.minimum.at(best, left, rank[right])
    some = np.flatnonzero(count)
    chosen = np.array(order, np.int64)[best[some]] if len(some) else some
    return pa.table({
        "word": words.take(pa.array(some)), "near": count[some].astype(np.int64), "best_n": n[chosen], "best": words.take(pa.array(chosen))})


def nearest(words: DataFrame) -> DataFrame:
    """(word, near, best_n, best) of the words of a vocabulary (word, n) that have a neighbour."""
    found = dealt(words).groupBy("bucket", "i", "j").applyInArrow(_neighbours, _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("_n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("_best")).select(
        "word", "near", (-F.col("_best._n")).alias("best_n"), F.col("_best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form), following forms to the last.

    Each round joins ends to their own ends, so paths double; a form is ten times as frequent as its
    word, hence paths are short and have no circles.
    """
    ends = stage(forms.select("word", F.col("form").alias("root")), "ends")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("_root"))
        moved = stage(ends.join(further, "root", "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved")), "ends")
        ends = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return ends


def group(words: DataFrame, times: int = 10) -> DataFrame:
    """Spelling variants of a vocabulary (word, n): form, root, n_near, form_n per word.

    Two words are near if one inserted, deleted or replaced code point makes one the other.  A word's form is
    its most frequent near word (ties: the smallest in code-point order) if that is ``times`` as frequent, else
    null; its root is the last form of that chain, or the word itself.  Words should be distinct and
    not null, of two code points at least.  No words give no rows.
    """
    words = stage(words, "words")
    near = stage(nearest(words), "near")
    named = words.join(near, "word", "left").withColumn(
        "_fits", F.coalesce(F.col("best_n") >= times * F.col("n"), F.lit(False)))
    known = stage(named.select(
        "word", "n", F.coalesce("near", F.lit(0)).alias("n_near"), F.when(F.col("_fits"), F.col("best")).alias("form"),
        F.when(F.col("_fits"), F.col("best_n")).alias("form_n")), "forms")
    ends = roots(known.filter("form is not null"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = 7, least_n: int = 2, times: int = 10,
             spoilt: bool = False) -> DataFrame:
    """``group`` over the words of whole texts: runs of letters, A-Z in lower case.

    ``spoilt`` leaves one letter out of every 31st or so (see ``misspelt``), to try the method.  A null text has no
    words; a null id counts as an empty one.  Repeated rows count as often as they come.  Words of
    any length take part.  An empty table gives no rows.  Columns besides id and text are ignored.
    """
    found = runs(docs, id, text)
    word = misspelt(F.col("doc_id"), F.col("run")) if spoilt else F.col("run")
    return group(vocabulary(found.select(word.alias("word")), least_length, least_n), times)
