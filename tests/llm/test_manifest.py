"""Merkle manifest beside a plain tree over collected rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tests_llm_rows import ODD, prose

from gazette_lake.llm import manifest
from gazette_lake.llm.oracles import ORACLES
from gazette_lake.llm.queries import REGISTRY

VALUES = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        found = r.text
        if r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
            found = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        leaf = lambda text: leaf_of(r.doc_id, r.source, r.lang, r.n_chars, text)
        groups[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf(r.text), r.doc_id, leaf(found)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in groups[name]])
    top = tree([trees[name][-1][0] for name in names])
    out = Counter()
    for g, name in enumerate(names):
        for i, (_, _, leaf, doc_id, found) in enumerate(groups[name]):
            siblings, hashed = [], found
            for levels, place in ((trees[name], i), (top, g)):
                for nodes in levels[:-1]:
                    begin = place // 8 * 8
                    run = nodes[begin:begin + 8]
                    siblings += run[:place - begin] + run[place - begin + 1:]
                    hashed = sha("".join([*run[:place - begin], hashed, *run[place - begin + 1:]]))
                    place //= 8
            root = top[-1][0]
            out[doc_id, leaf, trees[name][-1][0], root, sha("".join(siblings)), hashed, hashed == root] += 1
    return out


def checked(docs):
    return manifest.manifest(docs, VALUES, "lang", tampered=manifest.lowered_third(docs))


def same(docs):
    got = checked(docs).collect()
    assert Counter(map(tuple, got)) == plain(docs.collect())
    return got


def test_odd_rows(odd, none):
    got = same(odd)
    assert any(r.verified for r in got)
    assert checked(none).count() == 0
    assert checked(none).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n", [1, 8, 9, 600])
def test_trees_of_many_sizes(spark, n):
    docs = spark.range(n).select(
        (F.col("id") * 7 % 1000).alias("doc_id"), F.concat(F.lit("Some TEXT é "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 50 != 49, F.lit("en")).alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    got = same(docs.repartition(5))
    assert n < 20 or 0 < sum(r.verified for r in got) < n


def test_more_groups_than_a_run(spark):
    rows = [(i, prose(5, i).upper(), f"l{i % 70}" if i % 7 else None, None, None) for i in range(300)]
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_untouched_rows_are_verified(odd):
    rows = manifest.manifest(odd, VALUES, "lang").collect()
    assert len(rows) == len(ODD) and all(r.verified and r.folded_root == r.root for r in rows)


def test_another_fanout_and_equal_rows(spark):
    docs = spark.range(100).select(
        F.lit(5).cast("long").alias("doc_id"), F.lit("a").alias("text"), F.lit("x").alias("lang"), F.lit("s").alias("source"),
        F.lit(1).cast("long").alias("n_chars"))
    two = manifest.manifest(docs, VALUES, "lang", fanout=2)
    leaf, nodes = leaf_of(5, "s", "x", 1, "a"), None
    nodes = [leaf] * 100
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    assert {(r.leaf, r.root, r.verified) for r in two.collect()} == {(leaf, nodes[0], True)}


def test_the_query_and_its_sql(spark, sf):
    from compare import connect, differences

    n, problems = differences(spark, connect(sf), "op11_manifest", REGISTRY["op11_manifest"], ORACLES["op11_manifest"], sf)
    assert n > 0 and not problems
