"""N-gram Jaccard self-join: MinHash bands find candidates, full n-gram sets decide.

1. One pass over all texts gives each its minima, folded into bands.  Band and row counts follow
   from the recall wanted at the threshold.  Equal texts are counted and then stand as one.
2. Texts are shuffled by band hash.  Those with one hash are a bucket, and only texts of one bucket are
   ever compared.  Buckets with the very same members, as copies share many bands, are one.
3. A bucket's n-gram sets are compared exactly, in blocks of bounded size.  A pair that shares several
   buckets counts in the smallest one.  A bucket that exceeds a block is cut by set size, in steps of the
   threshold: sets of steps further apart than one cannot be linked, and their blocks never meet.  All other
   blocks do, so no pair is left out; what comes back is a count and a label per text and block pair,
   never a row per pair.
4. Verified links are joined to classes.

Texts that share boilerplate chain up buckets; as candidates alone connect nothing, such chains cost
no more than the buckets themselves.  The number of links in a bucket of m texts can itself be near m*m/2;
counting them takes that many comparisons in blocks, but output, memory and rows per task stay bounded.
"""

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette_lake.llm import arrays
from gazette_lake.llm.components import connect
from gazette_lake.operators.bitfilter import with_maybe
from gazette_lake.session import stage

WORDS, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.9999, 5
BLOCK_TEXTS = 1024
BLOCK_NGRAMS = 1 << 20
COLUMNS = 2048  # n-grams compared at a time


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` minima needed to find a pair at the threshold with this probability."""
    return ceil(log(1 - recall) / log(1 - threshold ** rows))


def ngrams(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows' word n-grams, and each row's first.  A text of fewer words is one n-gram."""
    starts, ends, first = arrays.words(data, offsets)
    hashes = arrays.RangeHash(data)(starts, ends)
    words = np.diff(first)
    counts = np.maximum(words - n + 1, words > 0)
    limits = np.concatenate([[0], np.cumsum(counts)])
    begin = np.arange(limits[-1]) - np.repeat(limits[:-1] - first[:-1], counts)
    end = np.minimum(begin + n, np.repeat(first[1:], counts))
    return arrays.RangeHash(hashes)(begin, end), limits


def band_hashes(grams: np.ndarray, limits: np.ndarray, bands: int, rows: int, seed: int = 1) -> np.ndarray:
    """One row of ``bands`` numbers for each text with n-grams."""
    key = arrays.mix(np.arange(seed, seed + 2 * bands * rows, dtype=np.uint64))
    begin = limits[:-1][np.diff(limits) > 0]
    out = np.zeros((len(begin), bands), np.uint64)
    value = np.empty_like(grams)
    for i in range(bands * rows):
        np.multiply(grams, key[2 * i] | np.uint64(1), out=value)
        value += key[2 * i + 1]
        out[:, i // rows] = out[:, i // rows] * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(value, begin)
    return arrays.mix(out + np.arange(bands, dtype=np.uint64))


def text_keys(text: Column) -> dict[str, Column]:
    """128 bits that stand for a text; null differs from every text."""
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(7), text)}


def _signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Per document: id, text key, number of n-grams with repetitions, bands (none without a word)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches):
            grams, limits = ngrams(*arrays.text_bytes(part.column(1)), n)
            counts = np.diff(limits)
            values = band_hashes(grams, limits, bands, rows).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
            yield pa.record_batch({
                "doc_id": part.column(0), "k1": part.column(2), "k2": part.column(3), "n_grams": pa.array(counts),
                "bands": pa.ListArray.from_arrays(pa.array(at), pa.array(values.ravel()))})

    signed = docs.mapInArrow(sign, "doc_id long, k1 long, k2 long, n_grams long, bands array<long>")
    return stage(signed.withColumn("row", F.monotonically_increasing_id()), "signed")


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """(node, size, grams) for (node, text): n-gram sets as sorted distinct hashes.  A node that comes again is left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in arrays.slices(batches):
            nodes = part.column(0).to_pylist()
            fresh = [i for i, node in enumerate(nodes) if not (node in seen or seen.add(node))]
            part = part.take(pa.array(fresh, pa.int64()))
            grams, limits = ngrams(*arrays.text_bytes(part.column(1)), n)
            sets = [np.unique(grams[a:b]) for a, b in zip(limits[:-1].tolist(), limits[1:].tolist())]
            yield pa.record_batch({
                "node": part.column(0), "size": pa.array([len(x) for x in sets], pa.int64()),
                "grams": pa.array([x.tobytes() for x in sets], pa.binary())})

    cut_here = texts.mapInArrow(cut, "node long, size long, grams binary")
    return cut_here.dropDuplicates(["node"])  # copies under one id may lie in several tasks


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of the left has in common with each of the right."""
    sizes = [np.array([len(x) for x in side], np.int64) for side in (left, right)]
    values = np.concatenate([*left, *right])
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    several = times[column] > 1
    number = np.cumsum(times > 1) - 1
    rows, column = rows[several], number[column[several]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    common = np.zeros((len(left), len(right)))
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        part = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        part[rows[a:b], column[a:b] - begin] = 1
        common += part[:len(left)] @ part[len(left):].T
    return common


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets of the left are at least so similar to which of the right."""
    common = shared(left, right)
    sizes = [np.array([len(x) for x in side], np.int64) for side in (left, right)]
    union = sizes[0][:, None] + sizes[1][None, :] - common
    return common / np.maximum(union, 1) >= threshold


def _labels(links: np.ndarray) -> np.ndarray:
    """Smallest index of each one's component in a symmetric matrix of links."""
    label = np.arange(len(links))
    while True:
        best = np.where(links, label[None, :], len(links)).min(1, initial=len(links))
        best = np.minimum(label, best)
        best = np.minimum(best, best[best])
        if (best == label).all():
            return label
        label = best


def _compare(threshold: float):
    def compare(group: pa.Table) -> pa.Table:
        """Count links between the texts of one block, or across two, of a bucket."""
        key, i, j = (group.column(name)[0].as_py() for name in ("key", "i", "j"))
        nodes, own = group.column("node").to_numpy(), group.column("own").to_numpy()
        earlier = [np.array([k for k in keys if k < key], np.int64) for keys in group.column("keys").to_pylist()]
        left = np.flatnonzero(own == i)
        right = left if i == j else np.flatnonzero(own == j)
        pick = lambda items, some: [items[k] for k in some]
        new = shared(pick(earlier, left), pick(earlier, right)) == 0  # pairs that no smaller bucket has
        if i == j:
            np.fill_diagonal(new, False)
        links = np.zeros((len(nodes), len(nodes)), bool)
        if new.any():
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("grams").combine_chunks()]
            across = linked(pick(sets, left), pick(sets, right), threshold) & new
            links[np.ix_(left, right)] = across
            if i != j:
                links[np.ix_(right, left)] = across.T
        found = np.flatnonzero(links.any(1))
        order = found[np.argsort(nodes[found])]
        links = links[np.ix_(order, order)]
        return pa.table({
            "node": nodes[order], "key": nodes[order][_labels(links)] if len(order) else nodes[:0],
            "links": links.sum(1).astype(np.int64)})

    return compare


def _buckets(banded: DataFrame) -> DataFrame:
    """(key, node, n) for (key, node): buckets of two texts and more, of those with equal members one."""
    members = [F.bit_xor(F.xxhash64(F.lit(seed), "node")) for seed in (1, 2)]
    full = banded.groupBy("key").agg(F.count("*").alias("n"), members[0].alias("m1"), members[1].alias("m2")).filter("n > 1")
    kept = full.groupBy("n", "m1", "m2").agg(F.min("key").alias("key"))
    return banded.join(kept.select("key", "n"), "key")


def _dealt(rows: DataFrame, threshold: float) -> DataFrame:
    """Members (key, node, size, ...) with their own block and every pair of blocks (i, j) they take part in.

    ``rows`` should be a written table.  A bucket that fits one block is block 0.  The blocks of another are numbered by
    step of set size, in the upper bits, and by hash within the step; only those of one step, or of two next
    to each other, meet.
    """
    blocks = lambda: F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_NGRAMS)).cast("long")
    step = F.floor(F.log("size") / F.lit(-log(threshold) * 1.0001)).cast("long")  # a little wide, against rounding
    whole = rows.groupBy("key").agg(blocks().alias("_whole")).filter("_whole > 1")
    narrow = rows.select("key", "size", step.alias("_step")).join(whole.select("key"), "key", "left_semi")
    counted = narrow.groupBy("key", "_step").agg(blocks().alias("_n"))
    beside = Window.partitionBy("key").orderBy("_step")  # some ten steps of a bucket
    next_to = lambda f, d: F.when(f("_step", 1).over(beside) == F.col("_step") + d, f("_n", 1).over(beside)).otherwise(0)
    steps = counted.select("key", "_step", "_n", next_to(F.lag, -1).alias("_below"), next_to(F.lead, 1).alias("_above"))
    found = rows.withColumn("_step", step).join(steps, ["key", "_step"], "left")
    number = lambda s, k: F.shiftleft(s, 40) + k
    own = F.when(F.col("_n").isNull(), F.lit(0).cast("long")).otherwise(number(F.col("_step"), F.pmod(F.xxhash64("node"), F.col("_n"))))
    some = lambda shift, n: F.when(F.col(n) > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), F.col(n) - 1), lambda k: number(F.col("_step") + shift, k))).otherwise(F.array().cast("array<long>"))
    others = F.when(F.col("_n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.concat(some(-1, "_below"), some(0, "_n"), some(1, "_above")))
    dealt = found.withColumn("own", own).withColumn("_other", F.explode(others))
    return dealt.withColumns({"i": F.least("own", "_other"), "j": F.greatest("own", "_other")}).drop("_step", "_n", "_below", "_above", "_other")


def classify(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS,
             id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: class and links, text keys (k1, k2), and whether it is its class's first.  See ``near_duplicates``."""
    source = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    source = source.withColumns(text_keys(F.col("text")))
    signed = _signed(source.select("doc_id", "text", "k1", "k2"), n, bands_for(threshold, recall, rows), rows)
    nodes = stage(signed.groupBy("k1", "k2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least_id"), F.count("*").alias("n_copies")), "nodes")

    banded = signed.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    banded = stage(banded.select(F.explode("bands").alias("key"), F.col("row").alias("node")), "banded")
    entries = stage(_buckets(banded).select("key", "node"), "entries")
    keys = entries.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # one per band at most

    # Texts of candidates, and of these alone; a bitmap of them keeps all others where they are.
    wanted = stage(nodes.join(entries.select("node").distinct(), "node").select("node", "k1", "k2"), "wanted")
    first = signed.select(F.col("row").alias("node"), F.col("doc_id").alias("_id")).join(wanted, "node")
    maybe = with_maybe(source, wanted, ["k1", "k2"], "_maybe").filter("_maybe").drop("_maybe")
    texts = maybe.join(first, (maybe.k1 == first.k1) & (maybe.k2 == first.k2) & maybe.doc_id.eqNullSafe(first._id))
    sets = stage(_sets(texts.select("node", "text"), n).join(keys, "node"), "sets")
    sizes = stage(entries.join(sets.select("node", "size"), "node"), "sizes")
    members = _dealt(sizes, threshold).drop("size").join(sets.select("node", "keys", "grams"), "node")
    compared = stage(members.groupBy("key", "i", "j").applyInArrow(
        _compare(threshold), "node long, key long, links long"), "compared")

    own_class = connect(stage(compared.select("key", "node").distinct(), "linked")).withColumnRenamed("label", "class")
    links = compared.groupBy("node").agg(F.sum("links").alias("n_links"))
    found = stage(nodes.join(own_class, "node", "left").join(links, "node", "left").select(
        "k1", "k2", "node", "least_id", "n_copies", F.coalesce("class", "node").alias("class"),
        F.coalesce("n_links", F.lit(0)).alias("n_links")), "found")

    # A class's first document, worked out over texts, so that copies add nothing to a large class.
    classes = stage(found.groupBy("class").agg(F.min("least_id").alias("class_id")), "classes")
    named = stage(found.join(classes, "class"), "named")
    leading = named.filter(F.col("least_id").eqNullSafe(F.col("class_id")))
    leaders = stage(leading.groupBy("class").agg(F.min("node").alias("leader")), "leaders")
    texts = stage(named.join(leaders, "class").select(
        "k1", "k2", "class_id", "n_links", (F.col("n_copies") - 1).alias("n_copies"), (F.col("node") == F.col("leader")).alias("_leads")), "texts")
    members = signed.select("doc_id", "k1", "k2").join(texts, ["k1", "k2"])
    return members.withColumn("is_first", F.col("_leads") & F.col("doc_id").eqNullSafe(F.col("class_id"))).drop("_leads")


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """Classes of near-duplicate documents, one row per document.

    ``class_id``: smallest id of the documents linked to it, directly or over others.
    ``n_links``: other texts of similarity ``threshold`` or more, each text once.
    ``n_copies``: other documents with the very same text.

    Words stand between white space.  A text of fewer than ``n`` words is one n-gram.  A text
    without words is linked to nothing but its copies; null texts are copies of each other.
    Null ids stay null; a class of nothing else has a null class.  Repeated rows are copies.
    An empty table gives no rows.  Columns besides id and text are ignored.
    """
    return classify(docs, **settings).select("doc_id", "class_id", "n_links", "n_copies")


def without_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents with all their columns, but only the first of each class, once."""
    stays = classify(docs, id=id, text=text, **settings).filter("is_first").select("doc_id", "k1", "k2").distinct()
    keys = text_keys(docs[text].cast("string"))
    packed = docs.select(  # names of the documents' own columns cannot clash inside a struct
        docs[id].cast("long").alias("_id"), *[key.alias(f"_{name}") for name, key in keys.items()],
        F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    same = (packed["_k1"] == stays["k1"]) & (packed["_k2"] == stays["k2"]) & packed["_id"].eqNullSafe(stays["doc_id"])
    return packed.join(stays, same, "left_semi").dropDuplicates(["_id", "_k1", "_k2"]).select("_doc.*")
