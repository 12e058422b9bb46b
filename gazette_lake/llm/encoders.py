"""Token ids and counts of many texts at once, equal to those of the tokenizers library.

Pre-tokens are cut with arrays of character classes, not text by text.  Each worker asks
the library only for pre-tokens that its cache does not hold.  Texts that contain a special
token's string go to the library whole.
"""

import os
import unicodedata
from functools import lru_cache

import numpy as np

from gazette_lake.llm.arrays import RangeHash

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
CACHE_BITS = 20  # slots of a worker's cache: 2**20, 12 MB
# What a worker keeps before it starts afresh.  A slice fits above each limit, so that no array grows past the next power of two.
STORE_IDS = (1 << 21) - (1 << 18)  # ids: 8 MB
STORE_CHARACTERS = (1 << 22) - (1 << 18)  # characters: 16 MB
STORE_PIECES = (1 << 20) - (1 << 18)  # pre-tokens: 12 MB; far more than these would not find a slot
COMPARED = 1 << 15  # characters compared at a time

# The endings that the public patterns split off after an apostrophe.
_ONE, _TWO = "stmd", ("re", "ve", "ll")


@lru_cache(maxsize=4)
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def character_tables() -> dict[str, np.ndarray]:
    """Class and lower case of every code point, asked from the library's own patterns.

    5.5 MB whatever the input, so it may be sent to all workers.
    """
    from tokenizers import Regex, normalizers

    code = np.array([i for i in range(0x110000) if not 0xD800 <= i < 0xE000], np.uint32)
    every = code.tobytes().decode("utf-32-le")
    as_codes = lambda text: np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = np.zeros(0x110000, np.uint8)
    for value, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        marked = as_codes(normalizers.Replace(Regex(pattern), "\u0000").normalize_str(every))
        kind[code[(marked == 0) & (code != 0)]] = value
    lower = np.arange(0x110000, dtype=np.uint32)
    single = code[code != 0x130]  # the one character with two lower-case characters
    lower[single] = as_codes(normalizers.Lowercase().normalize_str(every.replace("İ", "")))
    return {"kind": kind, "lower": lower}


def _contractions(cp, kind, run_start, row_start, start) -> None:
    """Split off endings after a lone apostrophe in ``start``, in place."""
    n = len(cp)
    at = np.flatnonzero((cp == 0x27) & run_start & start)
    at = at[at + 1 < n]
    at = at[(kind[at + 1] == LETTER) & ~row_start[at + 1]]
    if not len(at):
        return
    first = cp[at + 1]
    inside = at + 2 < n
    behind = np.where(inside, at + 2, at)
    second = np.where(inside & ~row_start[behind] & (kind[behind] == LETTER), cp[behind], 0)
    one = np.isin(first, [ord(c) for c in _ONE])
    two = np.zeros(len(at), bool)
    for a, b in _TWO:
        two |= (first == ord(a)) & (second == ord(b))
    for hit, length in ((one, 1), (two & ~one, 2)):
        start[at[hit] + 1] = False
        rest = at[hit] + 1 + length
        rest = rest[rest < n]
        start[rest[(kind[rest] == LETTER) & ~row_start[rest]]] = True


def _row_starts(n: int, offsets: np.ndarray) -> np.ndarray:
    marks = np.zeros(n + 1, bool)
    marks[offsets] = True
    return marks[:-1]


def byte_level_pieces(cp, offsets, tables) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of the byte-level pattern; they cover all characters."""
    kind, row_start = tables["kind"][cp], _row_starts(len(cp), offsets)
    run_start = row_start.copy()
    run_start[1:] |= kind[1:] != kind[:-1]
    start = run_start.copy()
    # The last space of a run belongs to what follows it.
    follows = np.flatnonzero(run_start & ~row_start & (kind != SPACE))
    follows = follows[kind[follows - 1] == SPACE]
    start[follows - 1] = True
    start[follows[cp[follows - 1] == 0x20]] = False
    _contractions(cp, kind, run_start, row_start, start)
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], len(cp))[:len(starts)]


def word_level_pieces(cp, offsets, tables) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of the word pattern in lower-case text; white space is in none."""
    kind, row_start = tables["kind"][cp], _row_starts(len(cp), offsets)
    run_start = row_start.copy()
    run_start[1:] |= kind[1:] != kind[:-1]
    start = (run_start | (kind == NUMBER)) & (kind != SPACE)
    _contractions(cp, kind, run_start, row_start, start)
    limits = np.append(np.flatnonzero(start | row_start | (kind == SPACE)), len(cp))
    starts = np.flatnonzero(start)
    return starts, limits[np.searchsorted(limits, starts, "right")]


class PieceTexts:
    """Characters of many pre-tokens, to compare others with."""

    def __init__(self, pieces: list[str] = ()):
        self.characters, self.starts, self.used, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0, 0
        self.add(list(pieces))

    def add(self, pieces: list[str]) -> None:
        new = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        while self.used + len(new) > len(self.characters):
            self.characters = np.concatenate([self.characters, np.zeros_like(self.characters)])
        while self.n + len(pieces) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.characters[self.used:self.used + len(new)] = new
        self.starts[self.n + 1:self.n + len(pieces) + 1] = self.used + np.cumsum([len(piece) for piece in pieces], dtype=np.int64)
        self.used, self.n = self.used + len(new), self.n + len(pieces)

    def same(self, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether each range of ``cp`` is the pre-token of that number."""
        length, begin = ends - starts, self.starts[number]
        alike = self.starts[number + 1] - begin == length
        long = np.flatnonzero(alike & (length > COMPARED))
        for i in long.tolist():
            alike[i] = np.array_equal(cp[starts[i]:ends[i]], self.characters[begin[i]:begin[i] + length[i]])
        length = np.where(alike & (length <= COMPARED), length, 0)
        after = np.cumsum(length)
        limits = np.searchsorted(after, np.arange(0, after[-1] if len(after) else 0, COMPARED), "left")
        for a, b in zip(limits.tolist(), [*limits[1:].tolist(), len(length)]):  # some ``COMPARED`` characters at a time
            size = length[a:b]
            to = np.cumsum(size)
            place = np.arange(to[-1] if len(to) else 0)
            here = np.repeat(starts[a:b] - to + size, size) + place
            there = np.repeat(begin[a:b] - to + size, size) + place
            differ = np.flatnonzero(cp[here] != self.characters[there])
            if len(differ):
                alike[a + np.searchsorted(to, differ, "right")] = False
        return alike


class Encoder:
    """Ids of many texts.  One object per worker and tokenizer file.

    ``word_level`` says which public pattern the file has: words in lower case with word
    ends, or bytes with leading spaces.
    """

    def __init__(self, path: str, tables: dict, word_level: bool):
        self.whole, self.tables, self.word_level = load(path), tables, word_level
        self.special = sorted(t.content for t in self.whole.get_added_tokens_decoder().values())
        if word_level:
            from tokenizers import Tokenizer, normalizers

            self.plain = Tokenizer.from_file(path)  # its words come in lower case already
            self.plain.normalizer = normalizers.Sequence([])
            vocabulary = self.plain.get_vocab(with_added_tokens=False)
            self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
            self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        else:
            self.plain = self.whole
        self.key = np.zeros(1 << CACHE_BITS, np.uint64)
        self.entry = np.zeros(1 << CACHE_BITS, np.int32)
        self._clear()

    def _clear(self) -> None:
        self.key[:] = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int32)
        self.pieces_text = PieceTexts()
        self.used_ids = self.used = 0

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has."""
        if self.word_level:
            flat = np.array(self.plain.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.is_end[flat]) + 1
            if len(ends) == len(pieces):
                return flat, np.diff(ends, prepend=0)
        found = [e.ids for e in self.plain.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _learn(self, pieces: list[str]) -> np.ndarray:
        flat, counts = self._ids_of(pieces)
        self.pieces_text.add(pieces)
        while self.used_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.used + len(counts) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used_ids:self.used_ids + len(flat)] = flat
        entries = np.arange(self.used, self.used + len(counts))
        self.starts[entries + 1] = self.used_ids + np.cumsum(counts)
        self.used_ids += len(flat)
        self.used += len(counts)
        return entries

    def _entries(self, cp, starts, ends) -> np.ndarray:
        """The store's entry of each pre-token.  Each may lie in either of two slots.

        Hashes only say where to look: what is found there is compared, character by character.
        """
        if self.used_ids > STORE_IDS or self.pieces_text.used > STORE_CHARACTERS or self.used > STORE_PIECES:
            self._clear()
        hashes = RangeHash(cp)(starts, ends)
        slot = (hashes >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        entry = self.entry[slot]
        missed = np.flatnonzero(self.key[slot] != hashes)
        if len(missed):
            other = (hashes[missed] & np.uint64((1 << CACHE_BITS) - 1)).astype(np.int64)
            entry[missed] = self.entry[other]
            missed = missed[self.key[other] != hashes[missed]]
        if len(missed):
            keys, first, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
            text = cp.tobytes().decode("utf-32-le")
            at = missed[first]
            learnt = self._learn([text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            entry[missed] = learnt[back]
            into = (keys >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
            into = np.where(self.key[into] == 0, into, (keys & np.uint64((1 << CACHE_BITS) - 1)).astype(np.int64))
            self.entry[into] = learnt  # where several want one slot, the last stays
            last = self.entry[into] == learnt
            self.key[into[last]] = keys[last]
        others = np.flatnonzero(~self.pieces_text.same(cp, starts, ends, entry))
        if len(others):  # another pre-token has the same hash
            text = cp.tobytes().decode("utf-32-le")
            pieces = [text[a:b] for a, b in zip(starts[others].tolist(), ends[others].tolist())]
            number = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
            entry[others] = self._learn(list(number))[[number[piece] for piece in pieces]]
        return entry

    def counts(self, cp, starts, ends) -> np.ndarray:
        """How many ids each pre-token has."""
        entry = self._entries(cp, starts, ends)
        return self.starts[entry + 1] - self.starts[entry]

    def _codes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points, in lower case for a word-level file, and where each row starts."""
        text = data.tobytes().decode("utf-8")
        if self.word_level and not text.isascii():
            if not unicodedata.is_normalized("NFC", text) or "İ" in text:
                raw = data.tobytes()
                rows = [raw[a:b].decode("utf-8") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                rows = [unicodedata.normalize("NFC", row).replace("İ", "i̇") for row in rows]
                cp = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32)
                return self.tables["lower"][cp], np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int64)
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if len(cp) != len(data):
            before = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=before[1:])
            offsets = before[offsets]
        return (self.tables["lower"][cp] if self.word_level else cp), offsets

    def pieces(self, data, offsets):
        """Code points of a slice, starts and ends of its pre-tokens, and each row's first one."""
        cp, at = self._codes(data, offsets)
        starts, ends = (word_level_pieces if self.word_level else byte_level_pieces)(cp, at, self.tables)
        return cp, starts, ends, np.searchsorted(starts, at)

    def special_rows(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, str]:
        """Rows that hold a special token's string, with their texts."""
        raw = data.tobytes()
        found: dict[int, str] = {}
        for token in self.special:
            at = raw.find(token.encode())
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                found[row] = raw[offsets[row]:offsets[row + 1]].decode("utf-8")
                at = raw.find(token.encode(), at + 1)
        return {row: text for row, text in found.items() if any(token in text for token in self.special)}

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and where each row's ids start.  ``end_id`` closes each row."""
        cp, starts, ends, first = self.pieces(data, offsets)
        entry = self._entries(cp, starts, ends)
        begin, counts = self.starts[entry].astype(np.int64), (self.starts[entry + 1] - self.starts[entry]).astype(np.int64)
        after = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(begin - after[:-1], counts) + np.arange(after[-1])]
        limits = after[first]
        special = self.special_rows(data, offsets)
        if special or end_id is not None:
            close = [] if end_id is None else [end_id]
            rows, lengths = len(limits) - 1, np.diff(limits)
            own = {row: self.whole.encode(text, add_special_tokens=False).ids for row, text in special.items()}
            for row, got in own.items():
                lengths[row] = len(got)
            to = np.concatenate([[0], np.cumsum(lengths + len(close))])
            out = np.empty(to[-1], np.uint32)
            plain = np.ones(rows, bool)
            plain[list(own)] = False
            keep = np.repeat(plain, np.diff(limits))
            where = np.repeat(to[:-1] - limits[:-1], np.diff(limits)) + np.arange(len(ids))
            out[where[keep]] = ids[keep]
            for row, got in own.items():
                out[to[row]:to[row] + len(got)] = got
            if close:
                out[to[1:] - 1] = end_id
            ids, limits = out, to
        return ids, limits
