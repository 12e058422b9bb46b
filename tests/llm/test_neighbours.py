"""Nearest vectors beside brute force."""

import numpy as np
import pytest

from gazette_lake.llm import neighbours
from gazette_lake.llm.queries import REGISTRY


def plain(rows, every, k):
    """Query id to the list of (id, score), for rows with distinct ids."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % every == 0:
            others = [(j, float((v * w).sum())) for j, w in good if j != i and len(w) == len(v)]
            out[i] = sorted(others, key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, row string").repartition(parts)


def made(n, dim, shift, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((30, dim)) * 2
    values = (base[rng.integers(0, 30, n)] + rng.standard_normal((n, dim)) + shift) * rng.uniform(0.5, 2, (n, 1))
    return [(i, [float(np.float32(x)) for x in v], "clash") for i, v in enumerate(values)]


def recall(got, want):
    assert set(got) == set(want)
    pairs = [(set(j for j, _ in got[q]), set(j for j, _ in want[q])) for q in want]
    assert all(len(a) == len(b) for a, b in pairs)
    return sum(len(a & b) for a, b in pairs) / sum(len(b) for _, b in pairs)


@pytest.mark.parametrize("dim, shift", [(64, 0.0), (64, 5.0), (17, 1.0), (1, 0.0)])
def test_recall(spark, dim, shift):
    rows = made(3000, dim, shift)
    got, want = found(neighbours.nearest(frame(spark, rows), 20, 20)), plain([r[:2] for r in rows], 20, 20)
    assert recall(got, want) >= 0.98
    exact = dict((i, np.array(v)) for i, v, _ in rows)
    for q, best in got.items():
        assert all(abs(s - (exact[q] * exact[j]).sum()) <= 1e-9 * max(1, abs(s)) for j, s in best)
        assert best == sorted(best, key=lambda x: (-x[1], x[0]))


def test_most_vectors_are_never_multiplied():
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((20000, 128))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    mean, turn, n = vectors.mean(0), neighbours.rotation(128), np.arange(20000)
    searcher = neighbours.Searcher(n[::200], vectors[::200], mean, turn, 20, neighbours.SIGMAS)
    for at in range(0, 20000, neighbours.BLOCK):
        s = slice(at, at + neighbours.BLOCK)
        searcher.block(n[s], n[s], vectors[s], *neighbours.encode(vectors[s], mean, turn))
    assert searcher.reranked < 0.2 * 20000 * 100  # random directions are the hardest case


def test_bounds_hold_as_often_as_said():
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((4000, 64)) + 1
    mean, turn = vectors.mean(0), neighbours.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, norm, align = neighbours.encode(vectors, mean, turn)
    signs = np.unpackbits(bits, axis=1, count=64) * 2.0 - 1
    query = rng.standard_normal((50, 64))
    estimate = (query @ turn) @ signs.T * norm / (align * 8) + (query @ mean)[:, None]
    error = np.linalg.norm(query, axis=1)[:, None] / np.sqrt(63) * norm * np.sqrt(1 - align ** 2) / align
    beyond = np.abs(estimate - query @ vectors.T) > 2 * error
    assert 0.01 < beyond.mean() < 0.08


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []),
            (8, [0.5, 0.5]), (20, [-1.0, 2.0]), (40, [1.0, 2.0, 3.0]), (41, [1.0, 0.0, 0.0]), (60, [0.0, 0.0]), (None, [1.0, 1.0]),
            (80, [1.0] * 5), (100, [3e38, 3e38]), (-20, [1e-30, 0.0])]
    got = found(neighbours.nearest(frame(spark, [(*r, "clash") for r in rows]), 20, 20))
    single = lambda v: None if v is None else [None if x is None else float(np.float32(x)) for x in v]
    want = plain([(i, single(v)) for i, v in rows], 20, 20)
    want.pop(80)  # nothing of its length
    assert got == want


def test_repeated_rows_and_ties(spark):
    rows = [(0, [1.0, 2.0, 2.0], "")] * 3 + [(i, [2.0, 1.0, 2.0], "") for i in range(1, 60) if i % 20] + [(7, [2.0, 1.0, 2.0], "")] * 30
    got = neighbours.nearest(frame(spark, rows), 20, 20).collect()
    assert len(got) == 60  # a query that comes three times is answered three times
    per = sorted((r["rank"], r.vec_id, r.score) for r in got)
    want = [(0, 9.0)] * 2 + sorted([(i, 8.0) for i in range(1, 60) if i % 20] + [(7, 8.0)] * 30)[:18]
    assert per == sorted((k + 1, i, s) for k, (i, s) in enumerate(want) for _ in range(3))


def test_no_rows_and_no_queries(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(empty).count() == 0
    assert neighbours.nearest(frame(spark, [(1, [1.0], ""), (2, [2.0], "")])).count() == 0


def test_waves_change_nothing(spark, monkeypatch):
    rows = frame(spark, made(600, 16, 0.5))
    want = found(neighbours.nearest(rows, 5, 7, sigmas=50.0))
    monkeypatch.setattr(neighbours, "WAVE_BYTES", 16 * 8 * 50)
    monkeypatch.setattr(neighbours, "BLOCK", 37)
    monkeypatch.setattr(neighbours, "TILE", 11)
    assert found(neighbours.nearest(rows, 5, 7, sigmas=50.0)) == want == plain(
        [(r.vec_id, list(r.embedding)) for r in rows.collect()], 5, 7)


def test_the_query(spark, sf):
    got = found(REGISTRY["op12_neighbours"](spark, sf))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert recall(got, plain([(r.vec_id, r.embedding) for r in rows], 20, 20)) >= 0.95
