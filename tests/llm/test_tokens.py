"""Counting, id files and packing beside the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests_llm_rows import ODD, thue_morse

from gazette_lake.llm import arrays, binary, counting, packing
from gazette_lake.llm.common import tokenizer_file
from gazette_lake.llm.encoders import Encoder, character_tables, load

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")


def ids_of(path, text):
    return load(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoders():
    return {path: Encoder(path, character_tables(), path == WORDS) for path in (BYTES, WORDS)}


def check(encoder, path, texts, size):
    k = 0
    for rows in arrays.slices([pa.record_batch({"text": pa.array(texts, pa.string())})], size=size):
        ids, limits = encoder.encode(*arrays.text_bytes(rows.column(0)), 7)
        for r in range(rows.num_rows):
            assert ids[limits[r]:limits[r + 1]].tolist() == ids_of(path, texts[k]) + [7], texts[k]
            k += 1
    assert k == len(texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_equal_the_library(encoders, path):
    rng = random.Random(4)
    alphabet = "abs tredlmv'''  \n\t1239!?.-é́İΣ漢½ \x85<|"
    texts = [text for _, text in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    check(encoders[path], path, texts, 1000)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"])), max_size=5))
def test_ids_equal_the_library_on_any_text(encoders, texts):
    for path in (BYTES, WORDS):
        check(encoders[path], path, texts, 50)


def test_a_shared_hash_changes_no_ids(monkeypatch):
    class Coarse(arrays.RangeHash):
        def __call__(self, starts, ends):
            return super().__call__(starts, ends) % np.uint64(3) + np.uint64(1 << 60)

    monkeypatch.setattr("gazette_lake.llm.encoders.RangeHash", Coarse)
    monkeypatch.setattr(arrays, "RangeHash", Coarse)
    for path in (BYTES, WORDS):
        check(Encoder(path, character_tables(), path == WORDS), path, [text for _, text in ODD if len(text or "") < 5000], 1000)
    table = counting.LengthTable([" river", " stone", "the"], BYTES)
    cp = np.frombuffer("the river stoned".encode("utf-32-le"), np.uint32)
    lengths, missed = table.look_up(cp, np.array([0, 3, 9]), np.array([3, 9, 16]))
    assert missed[2] and not missed.all() and (lengths[~missed] == 1).all()


def test_long_ranges_of_regular_order_differ():
    for dtype in (np.uint8, np.uint32):
        a, b = (np.array([ord(c) for c in thue_morse(*pair, 4096)], dtype) for pair in (("o", "n"), ("n", "o")))
        both = arrays.RangeHash(np.concatenate([a, b, a]))
        for n in (65, 128, 512, 1024, 2048, 4096):
            first, second, third = both(np.array([0, 4096, 8192]), np.array([0, 4096, 8192]) + n)
            assert first != second and first == third


def test_a_full_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr("gazette_lake.llm.encoders.STORE_IDS", 50)
    encoder = Encoder(WORDS, character_tables(), True)
    check(encoder, WORDS, [f"word{i} other{i * 7}" for i in range(200)], 64)


def test_token_counts(spark, odd, none):
    got = counting.count_tokens(odd, BYTES)
    want = Counter((i, len((t or "").encode()), n := len(ids_of(BYTES, t)), n > 1024) for i, t in ODD)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert counting.count_tokens(none, BYTES).count() == 0


def test_the_table_decides_no_count(odd, monkeypatch):
    want = sorted(map(str, counting.count_tokens(odd, BYTES).collect()))
    for name, value in (("FREQUENT", 1), ("PER_TASK", 3), ("HELD", 4)):
        monkeypatch.setattr(counting, name, value)
    assert sorted(map(str, counting.count_tokens(odd, BYTES).collect())) == want


def test_id_files(spark, odd, none, tmp_path):
    files = binary.write(odd, f"file://{tmp_path}/ids", WORDS, end_id=2, length=64)
    rows = binary.read_documents(files).collect()
    assert len(rows) == len(ODD)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i or 0))
    crc = lambda t: zlib.crc32(np.array(ids_of(WORDS, t) + [2], "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((i, len(ids_of(WORDS, t)) + 1, crc(t)) for i, t in ODD)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    assert binary.read_documents(binary.write(none, f"file://{tmp_path}/none", WORDS, 2)).count() == 0


def test_any_sequence_can_be_read_alone(odd, tmp_path):
    path = binary.write(odd.coalesce(1), f"file://{tmp_path}/ids", WORDS, end_id=2, length=64).first().path
    with pa.memory_map(path.removeprefix("file://")) as source:
        file = pa.ipc.open_file(source)
        batch = file.get_batch(file.num_record_batches - 1)
        assert batch.schema.field("ids").type == pa.list_(pa.uint16(), 64)
        ids, mask = batch.column("ids").values, batch.column("mask").values
        assert len(ids) == len(mask) == 64 * batch.num_rows
        before = pa.total_allocated_bytes()
        assert ids.to_numpy(zero_copy_only=True)[0] >= 0 and pa.total_allocated_bytes() == before
        assert mask.false_count < 64


def packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    return by


def test_packing(odd, none):
    rows = packing.best_fit(odd, WORDS, 0, 2048).collect()
    sequences = packed(rows, 2048)
    want = Counter()
    for i, t in ODD:
        ids = np.array(ids_of(WORDS, t) + [0], "<u4")
        for k in range(0, len(ids), 2048):
            want[i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 2048) + 1
    assert packing.best_fit(none, WORDS, 0, 2048).count() == 0


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 50), max_size=200), limit=st.integers(1, 8))
def test_open_bins_are_bounded_and_filled_best(lengths, limit):
    bins, free = packing.OpenBins(50, limit), {}
    for n in lengths:
        fits = [f for f in free.values() if f >= n]
        into, offset = bins.place(n)
        now = {b: f for f, own in enumerate(bins.bins) for b in own}
        assert (free[into] == min(fits)) if fits else (into not in free)
        assert offset == 50 - free.get(into, 50) and now.get(into, 0) == free.get(into, 50) - n
        gone = set(free) - set(now) - {into}
        assert [free[b] for b in gone] == ([min(free.values())] if not fits and len(free) == limit else [])
        assert len(now) == bins.open <= limit
        free = now


def test_equal_pieces_are_spread(spark):
    pieces = spark.range(4000).selectExpr("cast(null as long) doc_id", "0 piece", "0L start", "1L length", "7L ids_crc32")
    rows = packing.pack(pieces, 8, pieces_per_task=500).collect()
    tasks = {}
    for row in rows:
        tasks[row.sequence_id >> 40] = tasks.get(row.sequence_id >> 40, 0) + 1
    assert len(rows) == 4000 and len(tasks) == 8 and max(tasks.values()) < 700


def test_a_worker_keeps_a_bounded_store_of_pieces():
    encoder, letters, sizes = Encoder(WORDS, character_tables(), word_level=True), np.random.default_rng(5), set()
    for _ in range(45):  # 650,000 different words of eight letters
        text = " ".join(np.frombuffer(letters.integers(97, 123, (14_500, 8), np.uint8).tobytes(), "S8").astype(str))
        ids, limits = encoder.encode(*arrays.text_bytes(pa.array([text])))
        sizes.add((encoder.pieces_text.characters.nbytes, encoder.ids.nbytes, encoder.starts.nbytes))
    assert ids.tolist() == ids_of(WORDS, text) and limits.tolist() == [0, len(ids)]
    assert max(size[0] for size in sizes) <= 16 << 20 and max(size[1] for size in sizes) <= 8 << 20 and max(size[2] for size in sizes) <= 4 << 20


def test_unused_memory_is_given_back_after_each_batch(monkeypatch):
    given = []
    monkeypatch.setattr(arrays, "release", lambda: given.append(1))
    batches = [pa.record_batch({"text": pa.array(["a" * n, None, "b"])}) for n in (1, 1 << 18, 0)]
    rows = [text for part in arrays.slices(iter(batches)) for text in part.column(0).to_pylist()]
    assert rows == ["a", None, "b", "a" * (1 << 18), None, "b", "", None, "b"] and len(given) == 3
