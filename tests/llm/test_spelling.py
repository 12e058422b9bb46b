"""Spelling variants beside all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests_llm_rows import ODD

from gazette_lake.llm import spelling
from gazette_lake.llm.oracles import ORACLES
from gazette_lake.llm.queries import REGISTRY


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes a to b."""
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def grouped(words, times=10):
    out = {}
    for w, n in words.items():
        beside = [v for v in words if near(w, v)]
        best = min(beside, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= times * n else None, len(beside))
    rows = []
    for w, (form, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, words[w], n_near, words[form] if form else None))
    return sorted(rows)


def got(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()))


def made(n, seed, letters="aeéintßr"):
    """Many words, some of them few letters apart, in chains of frequencies."""
    rng, words = random.Random(seed), {}
    while len(words) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))
        count = rng.choice([3000, 20000])
        for _ in range(rng.randint(1, 4)):
            words.setdefault(word, max(2, count))
            i, c = rng.randrange(len(word)), rng.choice(letters)
            changed = rng.choice([word[:i] + word[i + 1:], word[:i] + c + word[i:], word[:i] + c + word[i + 1:]])
            word, count = (changed, count // rng.choice([9, 10, 11])) if len(changed) >= 7 else (word, count)
    return words


def frame(spark, words, parts=4):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(parts)


def test_groups(spark):
    words = made(900, 1)
    want = grouped(words)
    assert sum(r[1] is not None for r in want) > 100 and any(r[2] != r[1] for r in want if r[1])
    assert got(spelling.group(frame(spark, words))) == want


def test_large_buckets_are_cut(spark, monkeypatch):
    words = made(500, 2, letters="ab") | {"commonbeginning" + x: 5 for x in "abcdefghij"}
    want = grouped(words)
    monkeypatch.setattr(spelling, "BUCKET_ROWS", 1 << 20)
    monkeypatch.setattr(spelling, "BLOCK_ROWS", 90)
    assert spelling.dealt(frame(spark, words)).select("i", "j").distinct().count() > 10
    assert got(spelling.group(frame(spark, words))) == want
    monkeypatch.setattr(spelling, "BLOCK_ROWS", 4096)
    monkeypatch.setattr(spelling, "BLOCK_CHARACTERS", 2000)
    assert got(spelling.group(frame(spark, words))) == want


def test_small_buckets(spark, monkeypatch):
    words = made(300, 3, letters="xyz")
    monkeypatch.setattr(spelling, "BUCKET_ROWS", 3)
    assert got(spelling.group(frame(spark, words))) == grouped(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=90, unique=True), st.integers(1, 6))
def test_the_recurrence(words, longer):
    words = [w for w in words if len(w) in (longer, longer - 1)] or ["a" * longer]
    lengths = np.array([len(w) for w in words])
    codes = np.zeros((len(words), longer), np.uint32)
    for i, w in enumerate(words):
        codes[i, :len(w)] = [ord(c) for c in w]
    a, b = spelling.one_apart(codes, lengths, longer)
    want = {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if len(x) == longer and near(x, y)}
    assert Counter(zip(a.tolist(), b.tolist())) == Counter(want)


def test_very_long_words(spark):
    long = "ab" * 30000
    words = {long: 50, long[:-1]: 5, long[:100] + "x" + long[101:]: 2, "y" + long: 600, "abababab": 3}
    assert got(spelling.group(frame(spark, words))) == grouped(words)


def words_of(rows, spoilt):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if spoilt and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


@pytest.mark.parametrize("spoilt", [True, False])
def test_odd_rows(spark, odd, none, spoilt):
    assert got(spelling.variants(odd, spoilt=spoilt)) == grouped(words_of(ODD, spoilt))
    assert got(spelling.variants(none, spoilt=spoilt)) == []


def test_few_letters_and_other_limits(spark, odd):
    text = [(1, "Ab ab abc ABC aBc b b bc bc É É é é × × ÷a ÷a")]
    docs = spark.createDataFrame(text, "doc_id long, text string")
    words = Counter("ab ab abc abc abc b b bc bc É É é é × × ÷a ÷a".split())
    assert got(spelling.variants(docs, least_length=1, times=1)) == grouped(words, 1)


def test_a_hot_word_is_one_row(spark):
    docs = spark.range(20000).select(F.lit(1).alias("doc_id"), F.lit("wonderful wonderfull").alias("text")).union(
        spark.createDataFrame([(2, "wonderfol wonderfol")], "doc_id int, text string"))
    rows = got(spelling.variants(docs))
    assert [(r[0], r[1], r[3], r[4]) for r in rows] == [
        ("wonderfol", "wonderful", 2, 1), ("wonderful", None, 20000, 2), ("wonderfull", None, 20000, 1)]


def test_the_query_and_its_sql(spark, sf):
    from compare import connect, differences

    n, problems = differences(spark, connect(sf), "op13_spelling", REGISTRY["op13_spelling"], ORACLES["op13_spelling"], sf)
    assert n > 0 and not problems
