"""Language by unigram models over a fixed public vocabulary, summed over all segmentations.

A text is a sequence of words (runs of letters, in lower case for ASCII), each with a mark in front.  A
language gives every piece of the vocabulary, and every single byte, a probability; a word's
probability is the sum, over all ways to cut it into pieces, of the products of theirs (forward
algorithm on bytes).  Short words are summed by length, long ones, such as whole lines of a script without
spaces, side by side, byte after byte, over the pieces that occur in them.  Pieces do not cross words, so a text's probability is the product over its
words, and each distinct word of a slice is worked out once.

Piece probabilities are learned by expectation maximisation from all training texts.  Each pass
yields expected counts by piece and language, a bounded number of rows per task; texts are not
shuffled.  Counts are rounded to fixed point, so sums do not depend on their order.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette_lake.llm import arrays, common

PASSES = 2
LINEAR_BYTES = 32  # longer words, as in scripts without spaces, are walked together, byte by byte, and scaled against underflow
WALKED = 1 << 20  # bytes of longer words times languages that are walked together, one word at least
STRETCH_BYTES, OVERLAP_BYTES = 1 << 16, 256  # still longer words are learned from in stretches, seen with so much before and after
RESCALED, EVERY = 1e-150, 8  # sums below are scaled up, looked at after so many bytes
HELD_BYTES = 1 << 24  # of distinct words that a learning task holds, likewise
SMOOTHING = 0.1
FIXED_POINT = 1 << 20
SLICE_BYTES = 1 << 22  # larger than elsewhere: few words of a slice are new to a worker
HELD_WORDS = 300_000  # distinct words that a learning task holds before it counts their pieces
CACHE_BITS = 20  # slots of a scoring worker's cache: 2**20 words, 40 MB for four languages
UNDETERMINED = "und"
HELD_OUT, FOLDS = 2, 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SLOTS = 20


class Pieces:
    """Byte strings of the vocabulary's pieces and all single bytes, found by hash.  Space marks a word's start."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        strings = {model.id_to_piece(i).replace("▁", " ").encode() for i in usual}
        strings = {s for s in strings if s and _LETTER[list(s.removeprefix(b" "))].all()} | {bytes([b]) for b in range(256)}
        self.strings = sorted(strings)
        self.longest = max(map(len, self.strings))
        self.reach = np.ones(1 << 16, np.int64)  # of the longest piece that begins with two bytes
        for s in self.strings:
            if len(s) > 1:
                self.reach[s[0] << 8 | s[1]] = max(self.reach[s[0] << 8 | s[1]], len(s))
        flat = np.frombuffer(b"".join(self.strings), np.uint8)
        ends = np.cumsum([len(s) for s in self.strings])
        self.keys = np.append(arrays.RangeHash(flat)(np.append(0, ends[:-1]), ends), np.uint64(0))
        self.first, self.second = np.full(1 << _SLOTS, -1, np.int32), np.full(1 << _SLOTS, -1, np.int32)
        for i, (a, b) in enumerate(zip(*self._slots(self.keys[:-1]))):
            table, slot = (self.first, a) if self.first[a] < 0 else (self.second, b)
            if table[slot] >= 0:
                raise ValueError("two pieces share both slots")
            table[slot] = i

    def __len__(self) -> int:
        return len(self.strings)

    @staticmethod
    def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (hashes >> np.uint64(64 - _SLOTS)).astype(np.int64), (hashes & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece, or -1."""
        a, b = self._slots(hashes)
        found = self.first[a]
        other = np.flatnonzero(self.keys[found] != hashes)
        found[other] = self.second[b[other]]
        wrong = other[self.keys[found[other]] != hashes[other]]
        found[wrong] = -1
        return found


@dataclass
class Uses:
    """Pieces in words that are walked together: word, start, end, number of the piece."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray

    def turned(self, lengths: np.ndarray) -> "Uses":
        """The same in words read backwards."""
        n = lengths[self.word]
        return Uses(self.word, n - self.end, n - self.start, self.piece)

    def sums(self, probabilities: np.ndarray, lengths: np.ndarray, begin: np.ndarray | None = None) -> np.ndarray:
        """Logarithms of the sums over all segmentations up to each place: place, word, language.

        ``begin`` has the sums of the first places, where a word goes on from what was walked before.
        """
        n, words, languages = int(lengths.max()), len(lengths), probabilities.shape[1]
        order = np.lexsort([self.word, self.end])
        word, start, piece, end = self.word[order], self.start[order], self.piece[order], self.end[order]
        limits = np.searchsorted(end, np.arange(n + 2))
        sums, scale = np.zeros((n + 1, words, languages)), np.zeros((n + 1, words, languages), np.int32)
        sums[0] = 1
        if begin is not None:
            sums[:len(begin)] = begin
        back = int((end - start).max(initial=1))
        for place in range(1 if begin is None else len(begin), n + 1):
            some = slice(limits[place], limits[place + 1])
            of = word[some]
            if not len(of):
                continue
            parts = sums[start[some], of] * probabilities[piece[some]]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            sums[place, of[first]] = np.add.reduceat(parts, first)
            scale[place, of[first]] = scale[place - 1, of[first]]
            if place % EVERY == 0:
                small = (sums[place] < RESCALED) & (sums[place] > 0)
                if small.any():
                    low = max(0, place - back)
                    sums[low:place + 1, small] /= RESCALED
                    scale[low:place + 1, small] += 1
        with np.errstate(divide="ignore"):
            return np.log(sums) + scale * np.log(RESCALED)


@dataclass
class Words:
    """Distinct words by hash, each with a mark in front."""

    keys: np.ndarray
    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> tuple["Words", np.ndarray, np.ndarray]:
        """The distinct words of a slice, which of them its words are, and each row's first word."""
        low = _LOWER[data]
        starts, ends = arrays.runs(_LETTER[data], offsets)
        keys, at, which = np.unique(arrays.RangeHash(low)(starts, ends), return_index=True, return_inverse=True)
        size = ends[at] - starts[at] + 1
        begin = np.concatenate([[0], np.cumsum(size)])
        flat = np.full(begin[-1], 0x20, np.uint8)
        inner = np.repeat(starts[at] - 1 - begin[:-1], size) + np.arange(begin[-1])
        letters = np.ones(len(flat), bool)
        letters[begin[:-1]] = False
        flat[letters] = low[inner[letters]]
        return cls(keys, flat, begin[:-1], size), which, np.searchsorted(starts, offsets)

    @classmethod
    def joined(cls, parts: list[tuple["Words", np.ndarray]]) -> tuple["Words", np.ndarray]:
        """Words of several slices with their counts added up."""
        keys, first, back = np.unique(np.concatenate([w.keys for w, _ in parts]), return_index=True, return_inverse=True)
        counts = np.concatenate([c for _, c in parts])
        counts = np.stack([np.bincount(back, column, len(keys)) for column in counts.T], 1)
        before = np.cumsum([0] + [len(w.flat) for w, _ in parts])
        starts = np.concatenate([w.starts + n for (w, _), n in zip(parts, before)])[first]
        size = np.concatenate([w.lengths for w, _ in parts])[first]
        begin = np.concatenate([[0], np.cumsum(size)])
        flat = np.concatenate([w.flat for w, _ in parts])[np.repeat(starts - begin[:-1], size) + np.arange(begin[-1])]
        return cls(keys, flat, begin[:-1], size), counts

    def groups(self, pieces: Pieces, of: np.ndarray) -> Iterator[tuple[np.ndarray, int, dict[tuple[int, int], np.ndarray]]]:
        """The words numbered ``of`` by length: which, the length, and the pieces (start, end) that some of them have."""
        value = arrays.RangeHash(self.flat)
        order = of[np.argsort(self.lengths[of], kind="stable")]
        for own in np.split(order, np.flatnonzero(np.diff(self.lengths[order])) + 1):
            for low in range(0, len(own), 1 << 14):
                part, found = own[low:low + (1 << 14)], {}
                n, start = int(self.lengths[part[0]]), self.starts[part]
                for a in range(n):
                    for b in range(a + 1, min(n, a + pieces.longest) + 1):
                        piece = pieces.find(value(start + a, start + b))
                        if piece.max() >= 0:
                            found[a, b] = piece
                yield part, n, found

    def walks(self, pieces: Pieces, of: np.ndarray, languages: int) -> Iterator[tuple[np.ndarray, Uses]]:
        """Words numbered ``of`` of nearly one length, and the uses of pieces in them."""
        value = arrays.RangeHash(self.flat)
        second = np.append(self.flat[1:], np.uint8(0))
        reach = pieces.reach[self.flat.astype(np.int64) << 8 | second] if len(self.flat) else np.zeros(0, np.int64)
        order = of[np.argsort(self.lengths[of], kind="stable")]
        while len(order):
            n = int(self.lengths[order[0]])
            alike = int(np.searchsorted(self.lengths[order], n + n // 4, "right"))
            own = order[:max(1, min(alike, WALKED // max(1, languages) // (n + n // 4)))]
            order = order[len(own):]
            size = self.lengths[own]
            word = np.repeat(np.arange(len(own)), size)
            start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            flat = np.repeat(self.starts[own], size) + start
            most = np.minimum(reach[flat], size[word] - start)
            found = []
            for length in range(1, int(most.max(initial=0)) + 1):
                at = np.flatnonzero(most >= length)
                piece = pieces.find(value(flat[at], flat[at] + length))
                at, piece = at[piece >= 0], piece[piece >= 0]
                found.append((word[at], start[at], start[at] + length, piece))
            yield own, Uses(*(np.concatenate(column) for column in zip(*found)))

    def stretches(self) -> tuple["Words", np.ndarray, np.ndarray, np.ndarray]:
        """All words in parts of ``STRETCH_BYTES`` at most, cut between characters, each with up to ``OVERLAP_BYTES`` around.

        Also the word of each part, and which of its places (from, to) are its own: every place of a word is
        one part's own.  A word that fits is one part.
        """
        flats, word, own_from, own_to = [], [], [], []
        for i, (start, size) in enumerate(zip(self.starts.tolist(), self.lengths.tolist())):
            whole = self.flat[start:start + size]
            limits = [0, size]
            if size > STRETCH_BYTES:
                begins = np.flatnonzero((whole & 0xC0) != 0x80)  # of characters
                if len(begins) * 8 < size:  # not UTF-8
                    begins = np.arange(size)
                at = lambda n: int(begins[max(0, np.searchsorted(begins, n, "right") - 1)])
                limits = sorted({0, size, *(at(n) for n in range(STRETCH_BYTES, size, STRETCH_BYTES))})
            for a, b in zip(limits[:-1], limits[1:]):
                low = at(a - OVERLAP_BYTES) if a > OVERLAP_BYTES else 0
                high = at(b + OVERLAP_BYTES) if b + OVERLAP_BYTES < size else size
                flats.append(whole[low:high])
                word.append(i)
                own_from.append(a - low)
                own_to.append(b - low)
        size = np.array([len(f) for f in flats], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint8), *flats])
        parts = Words(np.arange(len(size), dtype=np.uint64), flat, np.cumsum(size) - size, size)
        return parts, np.array(word, np.int64), np.array(own_from, np.int64), np.array(own_to, np.int64)

    def only(self, of: np.ndarray) -> "Words":
        """The words numbered ``of``."""
        return Words(self.keys[of], self.flat, self.starts[of], self.lengths[of])


@dataclass
class Model:
    """Languages with their priors (logarithms), and piece probabilities by language; the last row, of no piece, is 0."""

    languages: list[str]
    priors: np.ndarray
    probabilities: np.ndarray

    def _sums(self, n: int, found: dict, size: int, backward: bool = False) -> np.ndarray:
        sums = np.zeros((n + 1, size, self.probabilities.shape[1]))
        sums[n if backward else 0] = 1
        for (a, b), piece in sorted(found.items(), key=lambda x: -x[0][0] if backward else x[0][1]):
            sums[a if backward else b] += sums[b if backward else a] * self.probabilities[piece]
        return sums

    def word_scores(self, words: Words, pieces: Pieces, of: np.ndarray) -> np.ndarray:
        """log P(word) by word, of those numbered, and language."""
        out = np.zeros((len(words.keys), self.probabilities.shape[1]))
        short, giant = words.lengths[of] <= LINEAR_BYTES, words.lengths[of] > STRETCH_BYTES
        for own, n, found in words.groups(pieces, of[short]):
            out[own] = np.log(self._sums(n, found, len(own))[n])
        for one in of[giant].tolist():
            out[one] = self._giant_score(words, pieces, one)
        for own, uses in words.walks(pieces, of[~short & ~giant], out.shape[1]):
            n = words.lengths[own]
            out[own] = uses.sums(self.probabilities, n)[n, np.arange(len(own))]
        return out[of]

    def _giant_score(self, words: Words, pieces: Pieces, one: int) -> np.ndarray:
        """log P of one very long word, walked in parts; what is carried on are the sums of the last places."""
        n, total = int(words.lengths[one]), np.zeros(self.probabilities.shape[1])
        tail = np.zeros((1, len(total)))
        for low in range(0, n, STRETCH_BYTES):
            high, known = min(n, low + STRETCH_BYTES), len(tail)
            first = low - known + 1
            part = Words(words.keys[:1], words.flat, words.starts[[one]] + first, np.array([high - first]))
            [(_, uses)] = part.walks(pieces, np.zeros(1, np.int64), len(total))
            new = uses.end >= known
            uses = Uses(uses.word[new], uses.start[new], uses.end[new], uses.piece[new])
            sums = uses.sums(self.probabilities, part.lengths, np.exp(tail)[:, None, :])[:, 0]
            tail = sums[-pieces.longest:]
            total, tail = total + tail.max(0), tail - tail.max(0)
        return total + tail[-1]

    def cached_scores(self, words: Words, pieces: Pieces) -> np.ndarray:
        """log P(word) by word and language; a worker works out a word it does not hold."""
        if not hasattr(self, "cache"):
            self.cache = np.zeros(1 << CACHE_BITS, np.uint64), np.zeros((1 << CACHE_BITS, self.probabilities.shape[1]))
        keys, scores = self.cache
        slot = (words.keys >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out, new = scores[slot], np.flatnonzero(keys[slot] != words.keys)
        if len(new):
            out[new] = self.word_scores(words, pieces, new)
            keys[slot[new]] = words.keys[new]  # of several words of one slot, the last stays
            stay = new[keys[slot[new]] == words.keys[new]]
            scores[slot[stay]] = out[stay]
        return out

    def expected(self, words: Words, pieces: Pieces, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by language, given how often each language has each word.

        Of a word longer than a stretch, every piece counts in the stretch where it starts.
        """
        total = np.zeros((len(pieces) + 1, counts.shape[1]))
        long = np.flatnonzero(words.lengths > LINEAR_BYTES)
        if len(long):
            parts, word, own_from, own_to = words.only(long).stretches()
            with np.errstate(divide="ignore"):
                logs = np.log(self.probabilities)
            for own, uses in parts.walks(pieces, np.arange(len(word)), counts.shape[1]):
                n, weight = parts.lengths[own], counts[long[word[own]]]
                forward, backward = uses.sums(self.probabilities, n), uses.turned(n).sums(self.probabilities, n)
                here = (own_from[own][uses.word] <= uses.start) & (uses.start < own_to[own][uses.word])
                at, start, end, piece = uses.word[here], uses.start[here], uses.end[here], uses.piece[here]
                used = np.exp(forward[start, at] + logs[piece] + backward[n[at] - end, at] - forward[n[at], at]) * weight[at]
                for language in range(counts.shape[1]):
                    total[:, language] += np.bincount(piece, used[:, language], len(total))
        for own, n, found in words.groups(pieces, np.flatnonzero(words.lengths <= LINEAR_BYTES)):
            forward, backward = self._sums(n, found, len(own)), self._sums(n, found, len(own), backward=True)
            weight = counts[own] / forward[n]
            for (a, b), piece in found.items():
                used = forward[a] * self.probabilities[piece] * backward[b] * weight
                known = np.where(piece < 0, len(pieces), piece)
                for language in range(counts.shape[1]):
                    np.add.at(total[:, language], known, used[:, language])
        return total[:-1]

    def predict(self, data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Likeliest language of each row, and its probability."""
        words, which, first = Words.of(data, offsets)
        scores = self.cached_scores(words, pieces)[which]
        total = np.stack([arrays.sum_rows(column, first) for column in scores.T], 1) + self.priors
        best = total.argmax(1)
        return best, 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a letter of any script."""
    ascii_letter = _LETTER & (np.arange(256) < 128)
    out = arrays.sum_rows(ascii_letter[data], offsets) > 0
    for row in np.flatnonzero(~out & (arrays.sum_rows(data >= 128, offsets) > 0)).tolist():
        out[row] = any(c.isalpha() for c in data[offsets[row]:offsets[row + 1]].tobytes().decode("utf-8"))
    return out


def held_out(id: Column) -> Column:
    """A quarter of the ids, never learned from; a null id is among the others."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def learn(training: DataFrame, pieces: Pieces, passes: int = PASSES) -> Model:
    """Model from texts with languages (text, lang).  Without any, there is no language."""
    spark = training.sparkSession
    seen = sorted(training.groupBy("lang").count().collect())  # one row per language
    languages, documents = [row[0] for row in seen], np.array([row[1] for row in seen], float)
    size, sent = len(pieces), spark.sparkContext.broadcast(pieces)
    flat = np.append(np.full(size, 1 / size), 0)[:, None]  # one column: at first all languages are alike
    model = Model(languages, np.log(documents / documents.sum()) if languages else np.zeros(1), flat)
    for _ in range(passes if languages else 0):
        now = spark.sparkContext.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            number = {name: i for i, name in enumerate(languages)}
            total, held = np.zeros((size, len(languages))), []
            for part in arrays.slices(batches, size=SLICE_BYTES):
                words, which, first = Words.of(*arrays.text_bytes(part.column(0)))
                language = np.array([number[name] for name in part.column(1).to_pylist()])
                key = which * len(languages) + language[arrays.row_of(first)]
                counts = np.bincount(key, minlength=len(words.keys) * len(languages)).reshape(-1, len(languages))
                held.append((words, counts))
                if sum(len(w.keys) for w, _ in held) > HELD_WORDS or sum(len(w.flat) for w, _ in held) > HELD_BYTES:
                    held = [Words.joined(held)]
                    if len(held[0][0].keys) > HELD_WORDS // 2 or len(held[0][0].flat) > HELD_BYTES // 2:
                        total += now.value.expected(held[0][0], sent.value, held[0][1])
                        held = []
            if held:
                words, counts = Words.joined(held)
                total += now.value.expected(words, sent.value, counts)
            fixed = np.rint(total * FIXED_POINT).astype(np.int64)
            piece, language = np.nonzero(fixed)
            yield pa.record_batch({
                "piece": pa.array(piece.astype(np.int32)), "language": pa.array(language.astype(np.int32)),
                "n": pa.array(fixed[piece, language])})

        counted = training.select("text", "lang").mapInArrow(count, "piece int, language int, n long")
        table = counted.groupBy("piece", "language").agg(F.sum("n").alias("n")).toArrow()  # pieces x languages at most
        counts = np.full((size, len(languages)), SMOOTHING)
        counts[table.column("piece").to_numpy(), table.column("language").to_numpy()] += table.column("n").to_numpy() / FIXED_POINT
        model = Model(languages, model.priors, np.vstack([counts / counts.sum(0), np.zeros(len(languages))]))
    return model


def identify(docs: DataFrame, model_file: str, passes: int = PASSES, id: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score (probability of lang_pred).

    Learned from texts with a language whose id is not held out; a prediction sees the text
    only.  ``und`` with score 0 where a text is null or has no letter, or nothing could be
    learned.  A null id stays null, repeated rows stay, an empty table gives no rows.
    Columns besides those named are ignored.
    """
    source = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                         F.col(lang).cast("string").alias("lang"), held_out(F.col(id)).alias("held_out"))
    pieces = Pieces(model_file)
    model = learn(source.filter("lang is not null and text is not null and not held_out"), pieces, passes)
    sent = docs.sparkSession.sparkContext.broadcast((model, pieces))  # fixed by vocabulary and languages

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, pieces = sent.value
        for part in arrays.slices(batches, size=SLICE_BYTES):
            data, offsets = arrays.text_bytes(part.column(2))
            known = has_letter(data, offsets) & bool(model.languages)
            best, score = model.predict(data, offsets, pieces)
            names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
            yield pa.record_batch({"doc_id": part.column(0), "held_out": part.column(1), "lang_pred": pa.array(names, pa.string()),
                                   "score": pa.array(np.where(known, score, 0.0))})

    return source.select("doc_id", "held_out", "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")
