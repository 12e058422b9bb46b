"""Secrets in text: fixed patterns, and character Markov models compared by log-likelihood ratio.

Everything is column expressions.  A pattern's places come from splitting the text by it: the
lengths of the parts between and of the hits add up to code-point positions.  Texts that
cannot match are passed by after a plain search.

Beyond the patterns, every long run of token characters, or what the patterns' spans leave of it, is
found in a copy of the text in which those spans are hidden, character by character, so that places stay and
one search finds all runs, however many there are; it is
scored: the largest mean, over the neighbouring characters of a stretch of ``LEAST_RANDOM`` or
more, of log P(next | random) - log P(next | ordinary), held against ``THRESHOLD``.  A run with
such a stretch is a span as a whole, so that no end of a secret is left.  Both models count
character pairs in labelled strings: what the patterns found is random, words of letters,
digits and underscores outside of it are ordinary identifiers.  Random strings come from all
documents, as they may be rare; ordinary ones, of which every text has many, from a bounded sample
(``SAMPLE`` documents, chosen by a hash).  Distinct strings are shuffled, then their pairs, of which there
are a few thousand.
"""

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette_lake.functions.text import let

SAMPLE = 20_000  # documents that ordinary identifiers are taken from, about
LEAST_RANDOM = 20  # characters of a run that is scored
THRESHOLD = 0.4  # mean log-likelihood ratio from which a stretch of a run is a secret
UNIFORM = 0.05  # share of a character that no string had
DISCOUNT = 2  # strings with a pair that count for nothing: among ordinary ones are some secrets
BACKOFF = 10.0  # weight, in counted pairs, of how frequent the next character is by itself
MASK = "[secret]"
_BLOCK = 256
_CODES = 128

# The base patterns, with the least length of what they find, and the kinds in order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

# Runs of 16 or 24 and more characters are what is left of all runs after the short ones are dropped:
# a shorter run holds no longer one.  For assignments this does not hold, so those are dropped afterwards.
_MAY_ASSIGN = ASSIGN[:-2] + f"{{{ASSIGN_LENGTH}}})"
TOKEN = rf"[A-Za-z0-9+/_=-]{{{LEAST_RANDOM},}}"
IDENTIFIER = r"[A-Za-z0-9_]{8,}"

# Hidden characters: each character of a hidden span as one of a private block, by which the patterns that
# are searched for later still know what it was.
_HIDDEN_FROM = 0xE000
_HIDDEN, _OTHER = r"[\x{E000}-\x{E0FF}]", chr(0xE100)
_FILLER = chr(0xE0FF)

SPAN = "array<struct<start:bigint,rank:int,end:bigint,value:string>>"


def _before(sizes: Column) -> Column:
    """Sums of all sizes before each, worked out by blocks, so that many sizes take linear time."""
    def running(items: Column, start: Column) -> Column:
        sums = F.aggregate(items, F.array(start), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))
        return sums

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")),
        lambda k: F.slice(sizes, k * _BLOCK + 1, F.lit(_BLOCK)))
    within = lambda blocks: F.zip_with(
        blocks,
        running(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x)), F.lit(0).cast("bigint")),
        lambda b, start: F.slice(running(F.coalesce(b, F.array().cast("array<bigint>")), start), F.lit(1), F.coalesce(F.size(b), F.lit(0))))
    return F.when(F.size(sizes) > 0, let(blocks, lambda b: F.flatten(F.slice(within(b), F.lit(1), F.size(b)))))


def _places(text: Column, pattern: str, rank: int, group: int, may: Column) -> Column:
    """Hits of a pattern from left to right: start, rank, end in code points, and the group's text."""
    def located(hits: Column) -> Column:
        sizes = F.transform(hits, lambda h: (F.length(h.gap) + F.length(h.hit)).cast("bigint"))
        return F.zip_with(hits, _before(sizes), lambda h, n: F.struct(
            (n + F.length(h.gap)).cast("bigint").alias("start"), F.lit(rank).alias("rank"),
            (n + F.length(h.gap) + F.length(h.hit)).cast("bigint").alias("end"), h.value.alias("value")))

    hits = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    found = F.when(may, let(hits, located))
    return F.coalesce(found.cast(SPAN), F.array().cast(SPAN))


def _may_assign(text: Column) -> Column:
    return (text.contains("=") | text.contains(":")) & text.rlike(_MAY_ASSIGN)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the base patterns by kind."""
    assign = _places(text, ASSIGN, 0, 2, _may_assign(text))
    return {
        "assign": F.filter(assign, lambda s: F.length(s.value) >= ASSIGN_LENGTH),
        "access": _places(text, ACCESS, 1, 0, text.contains("AKIA") & text.rlike(ACCESS)),
        "hex": _places(text, HEX, 2, 0, text.rlike(HEX)),
    }


def _private(text: str) -> str:
    return "".join(chr(_HIDDEN_FROM + ord(c)) for c in text)


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ANY_HIDDEN = f"{_private('+')}-{_private('z')}"


def _replaced(text: Column, pattern: str, by, group: int = 0) -> Column:
    """The text with each hit replaced by a text of the same length; ``by`` gets the hit and its group."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    new = F.transform(hits, lambda h: by(h, h)) if not group else F.zip_with(
        hits, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), by)
    return F.array_join(F.zip_with(F.split(text, pattern, -1), F.concat(new, F.array(F.lit(""))), lambda gap, hit: F.concat(gap, hit)), "")


def _known_or_hidden(pattern: str) -> str:
    """ASSIGN for a text with hidden characters: each letter of a name in either case, plain or hidden."""
    names, rest = pattern.removeprefix("(?i)")[1:].split(")", 1)
    letters = "".join(f"[{c}{c.upper()}{_private(c + c.upper())}]" if c.isalpha() else c for c in names)
    return f"({letters}){rest.replace('[A-Za-z0-9', f'[A-Za-z0-9{_ANY_HIDDEN}')}"


def hidden(text: Column) -> Column:
    """The text, as long as it was, with every character of the base spans hidden.

    Each pattern finds what it finds in the text itself: hidden characters count as what they were.  Characters
    of the private block that a text has of its own become others; no pattern has either.
    """
    plain = F.when(text.rlike(_HIDDEN), F.regexp_replace(text, _HIDDEN, _OTHER)).otherwise(text)
    no_hex = F.when(text.rlike(HEX), _replaced(plain, HEX, lambda h, _: F.translate(h, _DIGITS + "abcdef", _private(_DIGITS + "abcdef")))).otherwise(plain)

    def access(t: Column) -> Column:
        pattern = ACCESS.replace("0-9", f"0-9{_private('0')}-{_private('9')}")
        return F.when(text.contains("AKIA") & text.rlike(ACCESS), _replaced(
            t, pattern, lambda h, _: F.translate(h, _DIGITS + _UPPER, _private(_DIGITS + _UPPER)))).otherwise(t)

    def assign(t: Column) -> Column:
        filled = lambda hit, value: F.when(F.length(value) >= ASSIGN_LENGTH, F.repeat(F.lit(_FILLER), F.length(hit))).otherwise(hit)
        return F.when(_may_assign(text), _replaced(t, _known_or_hidden(ASSIGN), filled, 2)).otherwise(t)

    return let(no_hex, lambda t: let(access(t), assign))


def _pairs(strings: Column) -> Column:
    """Numbers of neighbouring characters of a string: first code times 128 plus second."""
    codes = F.transform(F.split(strings, ""), F.ascii)
    return let(codes, lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))),
        lambda a, b: a * _CODES + b))


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio of each pair of characters: random against ordinary."""

    ratios: tuple[float, ...]

    def random(self, run: Column) -> Column:
        """Whether some stretch of ``LEAST_RANDOM`` characters or more has a mean ratio of ``THRESHOLD`` or more.

        One pass over sums of what each pair has beyond the threshold: up to a pair, less the least of
        those up to a pair at least a stretch before.
        """
        table = F.from_json(F.lit("[" + ",".join(f"{x:.6g}" for x in self.ratios) + "]"), "array<double>")
        least, zero = LEAST_RANDOM - 1, F.lit(0.0)
        beyond = lambda pairs: F.transform(pairs, lambda p: F.coalesce(F.get(table, p), zero) - THRESHOLD)

        def search(x: Column) -> Column:
            steps = F.zip_with(
                F.slice(x, F.lit(least), F.size(x)), F.concat(F.array(zero), F.slice(x, F.lit(1), F.size(x) - least)),
                lambda new, old: F.struct(new.alias("new"), old.alias("old")))
            start = F.struct(
                F.aggregate(F.slice(x, F.lit(1), F.lit(least - 1)), zero, lambda a, b: a + b).alias("upto"),
                zero.alias("before"), zero.alias("least"), F.lit(False).alias("found"))

            def step(state: Column, pair: Column) -> Column:
                upto, before = state.upto + pair.new, state.before + pair.old
                low = F.least(state.least, before)
                return F.struct(upto.alias("upto"), before.alias("before"), low.alias("least"), (state.found | (upto - low >= 0)).alias("found"))

            return F.aggregate(steps, start, step, lambda state: state.found)

        return let(_pairs(run), lambda p: let(beyond(p), lambda x: F.when(F.size(x) >= least, search(x)).otherwise(False)))


def train(docs: DataFrame, sample: int = SAMPLE) -> Models:
    """Both models from ``docs`` (doc_id, text).  Without random strings no run is random."""
    n = docs.count()
    share = min(1.0, sample / max(1, n))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    text = F.coalesce("text", F.lit(""))
    found = docs.select(chosen.alias("chosen"), text.alias("text")).withColumns(base_spans(F.col("text")))
    known = found.select("chosen", "text", F.transform(F.concat("assign", "access", "hex"), lambda s: s.value).alias("random"))
    words = F.when(F.col("chosen"), F.regexp_extract_all(hidden(F.col("text")), F.lit(IDENTIFIER), F.lit(0)))
    labelled = known.select(F.explode(F.concat(
        F.transform("random", lambda r: F.struct(F.lit(True).alias("random"), r.alias("value"))),
        F.coalesce(F.transform(words, lambda w: F.struct(F.lit(False).alias("random"), w.alias("value"))), F.array())
    )).alias("s"))
    # Each distinct string counts once by label: copies of one document add nothing.
    distinct = labelled.select("s.random", "s.value").distinct()
    counted = distinct.select("random", F.explode(_pairs(F.col("value"))).alias("pair")).groupBy("random", "pair").count()
    counts = {(row[0], row[1]): row[2] for row in counted.collect()}  # two labels, 65 x 65 pairs at most
    usual = [c for c in range(_CODES) if chr(c).isalnum() or chr(c) in "+/_=-."]
    ratios = [0.0] * (_CODES * _CODES)
    if any(label for label, _ in counts):
        logs = {}
        for label in (False, True):
            single = {b: sum(counts.get((label, a * _CODES + b), 0) for a in usual) for b in usual}
            whole = max(1, sum(single.values()))
            for a in usual:
                seen = {b: counts.get((label, a * _CODES + b), 0) for b in usual}
                sure = {b: max(0, n - DISCOUNT) for b, n in seen.items()}
                left = BACKOFF + sum(seen.values()) - sum(sure.values())
                for b in usual:
                    by_itself = (1 - UNIFORM) * single[b] / whole + UNIFORM / len(usual)
                    logs[label, a, b] = log((sure[b] + left * by_itself) / (sum(seen.values()) + BACKOFF))
        for a in usual:
            for b in usual:
                ratios[a * _CODES + b] = logs[True, a, b] - logs[False, a, b]
    return Models(tuple(ratios))


def with_spans(rows: DataFrame, models: Models, text: str) -> DataFrame:
    """Adds assign, access, hex, markov: arrays of spans.  ``text`` is a string column without nulls."""
    based = rows.withColumns(base_spans(F.col(text)))
    runs = let(hidden(F.col(text)), lambda t: _places(t, TOKEN, 3, 0, t.rlike(TOKEN)))
    markov = F.when(F.col(text).rlike(TOKEN), F.filter(runs, lambda s: models.random(s.value)))
    return based.withColumn("markov", F.coalesce(markov, F.array().cast(SPAN)))


def _listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s.rank), s.start, s.end)), ",")


def scan(docs: DataFrame, sample: int = SAMPLE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of every whole text: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then kind; ``base_sha256`` is the
    checksum of the same list without ``markov``.  A ``markov`` span never overlaps one of the others.
    A null text is an empty one and has none.  A null id stays null, repeated rows stay, an
    empty table gives no rows.  Columns besides id and text are ignored.
    """
    source = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = with_spans(source, train(source, sample), "text")
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed(F.concat("assign", "access", "hex")), 256).alias("base_sha256"),
        _listed(F.concat(*KINDS)).alias("spans"))


def all_hidden(text: Column, models: Models) -> Column:
    """The text, as long as it was, with every secret's characters hidden."""
    found = lambda run, _: F.when(models.random(run), F.repeat(F.lit(_FILLER), F.length(run))).otherwise(run)
    return let(hidden(text), lambda t: F.when(t.rlike(TOKEN), _replaced(t, TOKEN, found)).otherwise(t))


def masked(text: Column, covered: Column) -> Column:
    """The text with a mask for every stretch that is hidden in ``covered``; null where nothing is.

    Where a text has characters of the private block itself, its own parts are put together around the
    masks, since the copy lacks those.
    """
    stretch = f"{_HIDDEN}+"
    sizes = lambda: F.transform(F.regexp_extract_all(covered, F.lit(stretch), F.lit(0)), lambda h: F.length(h))
    gaps = F.transform(F.split(covered, stretch, -1), lambda g: F.length(g))
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("parts"))
    own = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), F.concat(sizes(), F.array(F.lit(0))).alias("size")), begin,
        lambda state, part: F.struct((state.at + part["gap"] + part["size"]).alias("at"), F.concat(
            state.parts, F.array(text.substr(state.at, part["gap"]))).alias("parts")), lambda state: F.array_join(state.parts, MASK))
    return F.when(covered.rlike(_HIDDEN), F.when(text.rlike(_HIDDEN), own).otherwise(F.regexp_replace(covered, stretch, MASK)))


def without_secrets(docs: DataFrame, sample: int = SAMPLE, id: str = "doc_id", text: str = "text",
                    n_chars: str | None = None) -> DataFrame:
    """The documents, all kept, with secrets masked in their texts, and ``n_chars`` brought in line.

    Spans that overlap or touch get one mask.  Texts without secrets, null ones too, stay as they are.
    """
    models = train(docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), sample)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    clean = packed.withColumn("_clean", let(all_hidden(F.col("_text"), models), lambda t: masked(F.col("_text"), t)))
    changed = F.col("_clean").isNotNull()
    return clean.select(*[
        F.when(changed, F.col("_clean")).otherwise(F.col(f"_doc.{c}")).alias(c) if c == text
        else F.when(changed, F.length("_clean").cast(docs.schema[c].dataType)).otherwise(F.col(f"_doc.{c}")).alias(c) if c == n_chars
        else F.col(f"_doc.{c}").alias(c) for c in docs.columns])
