"""Merkle manifest of a table: one hash tree per group, one tree over the groups' roots, a proof per row.

Slot pivot: children of a parent are spread into ``FANOUT`` columns by conditional aggregates over
(tree, position div FANOUT).  All columns together hash to the parent; all but a child's own column are
its siblings.  So neither an ordered list nor a self-join is needed on any level.

1. Leaves are numbered by ranges of (group, order): two passes over narrow rows, one count per range
   reaches the driver.  A group of any size is spread over many ranges.
2. Upwards, every level is one aggregation of an eighth of the rows below, written once.
3. Downwards, a parent's siblings are put behind those of its children by a join on (tree, position),
   on rows of parents only.  Keys are unique on both sides, so no task is larger than the others.

All hashes are sha256 in lowercase hex.  Everything here is DataFrame expressions.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm.sharding import row_numbers
from gazette_lake.session import stage

FANOUT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("", *parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(*values: Column) -> Column:
    return digest(*[encoded(value) for value in values])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def group_key(group: Column) -> Column:
    """A key that is never null, in the order of the groups: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``_number``, from 0 in the given order.  ``rows`` should be a written table."""
    written, before = row_numbers(rows, *order)
    spark = rows.sparkSession
    starts = spark.createDataFrame(list(enumerate(before[:-1].tolist())), "_part int, _before long")
    return written.join(starts, "_part").withColumn("_number", F.col("_before") + F.col("_pos")).drop("_part", "_pos", "_before")


def levels_of(n: int, fanout: int = FANOUT) -> int:
    """How often ``n`` nodes are put together until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def grow(nodes: DataFrame, levels: int, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``nodes`` (tree, pos, n, hash, load): the parents of each level, and the tops (tree, hash, load, level).

    ``n`` is the number of nodes of the tree on this level.  Parents are (tree, pos, c0, c1, ...); a slot is
    (hash, load), null where the run is shorter.
    """
    parents, tops = [], [nodes.filter("n = 1").select("tree", "hash", F.lit(0).alias("level"))]
    for level in range(1, levels + 1):
        slot, child = F.col("pos") % fanout, F.struct("hash", "load") if level == 1 else F.struct("hash")
        spread = nodes.filter("n > 1").groupBy(
            "tree", F.floor(F.col("pos") / fanout).alias("pos"), F.ceil(F.col("n") / fanout).alias("n"))
        pivot = stage(spread.agg(*[F.max(F.when(slot == i, child)).alias(f"c{i}") for i in range(fanout)]), "parents")
        parents.append(pivot)
        nodes = pivot.select("tree", "pos", "n", digest(*[F.col(f"c{i}.hash") for i in range(fanout)]).alias("hash"))
        tops.append(nodes.filter("n = 1").select("tree", "hash", F.lit(level).alias("level")))
    union = tops[0]
    for more in tops[1:]:
        union = union.unionAll(more)
    return parents, union


def descend(parents: list[DataFrame], tops: DataFrame, nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, hash, load, top, path) of every node: ``path`` is (left, right) siblings of each level, upwards.

    ``tops`` (tree, level, top, path) says where each tree ends and what lies above it.
    """
    column = lambda i: F.col(f"c{i}")
    beside = lambda some: F.concat_ws("", *[F.col(f"c{i}.hash") for i in some])
    children = F.array(*[
        F.struct(F.lit(i).alias("slot"), column(i).alias("node"), F.struct(
            beside(range(i)).alias("left"), beside(range(i + 1, fanout)).alias("right")).alias("sides"))
        for i in range(fanout)])
    present = F.filter(children, lambda child: child["node"].isNotNull())
    above = None
    for level in range(len(parents), 0, -1):
        here = tops.filter(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("pos"), "top", "path")
        above = here if above is None else above.select("tree", "pos", "top", "path").unionAll(here)
        pairs = parents[level - 1].drop("n").join(above, ["tree", "pos"])
        opened = pairs.select("tree", "pos", "top", "path", F.explode(present).alias("child"))
        above = opened.select(
            "tree", (F.col("pos") * fanout + F.col("child.slot")).alias("pos"), "top",
            F.concat(F.array("child.sides"), "path").alias("path"), "child.node.*")
    alone = nodes.filter("n = 1").select("tree", "hash", "load").join(
        tops.filter("level = 0").select("tree", "top", "path"), "tree")
    columns = ["tree", "hash", "load", "top", "path"]
    return alone.select(*columns) if above is None else above.select(*columns).unionAll(alone.select(*columns))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way up."""
    return F.aggregate(path, leaf, lambda hash, at: digest(at["left"], hash, at["right"]))


def proof_hash(path: Column) -> Column:
    """Hash of all siblings, level by level upwards, left to right."""
    return digest(F.array_join(F.flatten(F.transform(path, lambda at: F.array(at["left"], at["right"]))), ""))


_PATH = "array<struct<left:string,right:string>>"


def prove(leaves: DataFrame, order: list[str], fanout: int = FANOUT) -> DataFrame:
    """Columns of ``load``, and ``leaf``, ``subroot``, ``root`` and ``path`` of every row.

    ``leaves`` has tree (see ``group_key``), leaf, the columns of ``order`` and load, a struct that is
    carried along.  Leaves of one tree ascend by ``order`` and then by leaf; what is equal in both is
    interchangeable.  An empty table gives no rows.  A single row is subroot and root itself, its path is empty.
    """
    rows = numbered(stage(leaves, "leaves"), "tree", *order, "leaf")
    trees = stage(rows.groupBy("tree").agg(F.min("_number").alias("_first"), F.count("*").alias("n")), "trees")
    largest = trees.agg(F.max("n")).first()[0] or 0
    nodes = rows.join(trees, "tree").select(
        "tree", (F.col("_number") - F.col("_first")).alias("pos"), "n", F.col("leaf").alias("hash"), "load")
    parents, tops = grow(nodes, levels_of(largest, fanout), fanout)

    tops = stage(tops, "tops")
    total = tops.count()
    over = numbered(tops, "tree").select(
        F.lit("").alias("tree"), F.col("_number").alias("pos"), F.lit(total).cast("long").alias("n"), "hash",
        F.struct("tree", "level").alias("load"))
    upper, peak = grow(over, levels_of(total, fanout), fanout)
    root = (peak.first() or {"hash": None})["hash"]  # one row
    summit = peak.select("tree", "level", F.lit(root).alias("top"), F.array().cast(_PATH).alias("path"))
    above = descend(upper, summit, over, fanout).select(
        "load.tree", "load.level", F.col("hash").alias("top"), "path")
    found = descend(parents, stage(above, "subroots"), nodes, fanout)
    return found.select(
        "load.*", F.col("hash").alias("leaf"), F.col("top").alias("subroot"), F.lit(root).alias("root"), "path")


def manifest(docs: DataFrame, values: list[str], group: str, id: str = "doc_id", text: str = "text",
             tampered: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """Leaf, subroot, root, hash of the proof, and the check of a table that may have been tampered with.

    ``values`` are hashed in this order (a null is ``-``); one tree per value of ``group``, null being
    a group of its own, before all others.  ``tampered`` is the text as it is found at the check, by
    default the text itself.  ``folded_root`` is worked out from the leaf as found and the original
    siblings, and a row is ``verified`` if that is the root.

    Equal ids are ordered by leaf, null ids come first; repeated rows are leaves of their own.  Texts of
    any length are hashed whole.  An empty table gives no rows.  Columns not named are ignored.
    """
    named = {name: docs[name].cast("long") if name == id else docs[name] for name in values}
    leaf = row_hash(*named.values())
    found = leaf if tampered is None else F.when(
        tampered.eqNullSafe(docs[text]), leaf).otherwise(row_hash(*[tampered if name == text else value for name, value in named.items()]))
    number = docs[id].cast("long")
    leaves = docs.select(
        group_key(docs[group]).alias("tree"), number.alias("number"), leaf.alias("leaf"),
        F.struct(number.alias("doc_id"), found.alias("found")).alias("load"))
    folded = prove(leaves, ["number"], fanout).withColumn("folded_root", fold(F.col("found"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def lowered_third(docs: DataFrame, id: str = "doc_id", text: str = "text") -> Column:
    """The text, its A-Z in lower case where 3 divides the crc32 of the decimal id.  Rows without an id stay."""
    hit = F.crc32(docs[id].cast("long").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, ascii_lower(docs[text])).otherwise(docs[text])
