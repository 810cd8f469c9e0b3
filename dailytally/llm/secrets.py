"""Secret scan: fixed patterns, and values that would be costly to guess.

The base kinds (assign, access, hex) are regular expressions. The method adds
kind ``guess``: after a wider set of credential words, a value is cut into
dictionary words, dates, repeats, sequences, keyboard walks and brute-force
spans so that the product of their guess counts is least (dynamic programming
over the value, in log10); a value that costs at least ``MIN_COST`` is a secret.
Guess spans that a base span already covers are left out.

The dictionary is the corpus's own: words of at least ``WORD_DOCS`` documents, by the
number of documents that hold them outside the values themselves, the ``WORDS`` most
frequent (fewer, where that would part words of equal number); and a short list of
words common in passwords. A word's guess count is its place.

Spans are in code points, end exclusive, ordered by start and then by kind in the
order assign, access, hex, guess. Null or empty text: no spans. Repeated rows:
each gets its own row. Empty table: no rows. Texts are scanned whole; spans of a value
may be as long as it is, and the dynamic programming is linear in it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import stored

KINDS = ("assign", "access", "hex", "guess")

#: The patterns of the base kinds, and the least lengths of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
#: A text without any of these (lower-cased) has no assign or guess span.
ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
LONG_HEX = re.compile(r"[0-9a-f]{16}")

#: Words that announce a credential, then a separator, then its value.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth|bearer)"""
    r"""["']?\x20*(?:[:=]|=>)\x20*["']?([^\s"',;<>]+)""", re.I | re.A)
CONTEXT_HINT = re.compile(r"pass|pwd|secret|token|key|credential|auth|bearer", re.I | re.A)

#: log10 of the guesses from which a value counts as a secret; least length of a value.
MIN_COST = 10.0
MIN_VALUE = 8
#: Units of repeats tried first; longer ones only where they could be cheaper (``guess_cost``).
UNITS = 9

#: Common words of passwords, most frequent first; the place is the word's guess count.
COMMON = (
    "password pass admin user login welcome qwerty letmein monkey dragon master shadow sunshine princess football baseball "
    "secret token test example sample changeme default root guest hello world love iloveyou summer winter spring autumn "
    "server client service system public private access key value data base mail web site home work office company "
    "database dev prod stage demo temp none null true false your here placeholder insert redacted hidden the and for"
).split()
#: Words of the corpus: letters (at most ``WORD_LETTERS``), how many at most, in how many documents at least; words counted at a time in a task.
WORD = re.compile(r"[^\W\d_]{3,}")
WORD_LETTERS = 24
WORDS = 100_000
WORD_DOCS = 3
COUNTED = 200_000
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "qazwsxedcrfvtgbyhnujm")
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
#: Guesses of a date: days of about a hundred years; of a year alone: a hundred.
DATE_GUESSES, YEAR_GUESSES = 365 * 100, 100
#: Usual spellings of letters by other characters.
LEET = str.maketrans("4301$5@7", "aeolssat")


def brute(c: str) -> float:
    """log10 of the alphabet from which a character is guessed."""
    return math.log10(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33)


class Ranks(dict):
    """The guess count of each word of a dictionary."""

    @cached_property
    def lengths(self) -> list[int]:
        return sorted({len(w) for w in self})

    @cached_property
    def ends(self) -> frozenset[str]:
        return frozenset(w[-1:] for w in self)


@lru_cache(maxsize=1)
def words() -> Ranks:
    return Ranks((w, i + 1) for i, w in enumerate(COMMON))


def words_of(text: str) -> set[str]:
    """The words of a text outside the values that follow credential words."""
    if CONTEXT_HINT.search(text):
        text = CONTEXT.sub(" ", text)
    return {m[0] for m in WORD.finditer(text.lower()) if m.end() - m.start() <= WORD_LETTERS}


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def told_counts() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0):
            counts.update(words_of(text.as_py()))
            if len(counts) >= COUNTED:
                yield told_counts()
                counts.clear()
    yield told_counts()


def word_ranks(docs: DataFrame) -> Broadcast:
    """The guess count of each word, for the tasks; at most ``WORDS`` words of the corpus reach the driver."""
    rows = docs.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    counts = rows.mapInArrow(_count_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts.filter(F.col("n") >= WORD_DOCS), "words")
    least, held = None, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect():
        if (held := held + r.words) > WORDS:
            break
        least = r.n
    ranks = Ranks()
    if least is not None:
        for r in sorted(counts.filter(F.col("n") >= least).collect(), key=lambda r: (-r.n, r.word)):
            ranks[r.word] = len(ranks) + 1
    for w, rank in words().items():
        ranks[w] = min(rank, ranks.get(w, rank))
    return docs.sparkSession.sparkContext.broadcast(ranks)


@lru_cache(maxsize=1)
def walks() -> frozenset[str]:
    """Steps of two neighbours along a row of keys or an alphabet, either way."""
    rows = [*KEY_ROWS, "abcdefghijklmnopqrstuvwxyz", "0123456789"]
    return frozenset(s for r in rows for x in (r, r[::-1]) for s in (x[i : i + 2] for i in range(len(x) - 1)))


def _start(held: list[tuple[int, float]], i: int, base: float, least: int) -> None:
    """Adds a start of spans of equal units to those worth keeping: a span of j - i characters from it
    costs ``base`` and the logarithm of its length, ``least`` at least. An older start that costs no less is
    never better again; the new one never is if an older one is better at its first span, as
    the gap only closes from there."""
    while held and held[-1][1] >= base:
        held.pop()
    if all(base < b + math.log10((i - k + least) / least) for k, b in held):
        held.append((i, base))


def _least(value: str, enough: float, ranks: Ranks, units: int) -> float:
    """``guess_cost`` with repeated units of at most ``units`` characters."""
    low = value.lower()
    if len(low) != len(value):  # a few letters change length
        low = value
    leet = low.translate(LEET)
    cut, walk, pairs = math.log10(2), math.log10(47), walks()
    steps = [brute(c) for c in value]
    done, tail = [0.0], math.inf  # least cost up to here; the same with a brute-force span open
    # Per unit: how long the text has repeated what stood so far before, and the starts of spans, by remainder.
    again, held = [0] * (units + 1), [[[] for _ in range(u)] for u in range(units + 1)]
    walked, walk_held = 0, []
    window = max(10, 3, 2 * units, *ranks.lengths)
    for j in range(1, len(value) + 1):
        step = steps[j - 1]
        tail = min(tail + step, done[j - 1] + (cut if j > 1 else 0) + step)
        best = tail
        if low[j - 1] in ranks.ends or leet[j - 1] in ranks.ends:
            for n in ranks.lengths:
                if n > j:
                    break
                i = j - n
                to = done[i] + (cut if i else 0)
                if to < best and (rank := ranks.get(low[i:j]) or ranks.get(leet[i:j])):
                    best = min(best, to + math.log10(rank) + (0.5 if low[i:j] != value[i:j] else 0) + (0.5 if leet[i:j] != low[i:j] else 0))
        if value[j - 1].isdigit():
            for n in (4, 8, 9, 10):
                if n <= j and DATE.fullmatch(value, j - n, j):
                    best = min(best, done[j - n] + (cut if j > n else 0) + math.log10(YEAR_GUESSES if n == 4 else DATE_GUESSES))
        for u in range(1, min(units, j - 1) + 1):
            if low[j - 1] != low[j - 1 - u]:
                if again[u]:
                    again[u] = 0
                    for starts in held[u]:
                        starts.clear()
                continue
            again[u] += 1
            least = 3 if u == 1 else 2 * u
            if again[u] >= least - u:
                starts, i = held[u][j % u], j - least
                _start(starts, i, done[i] + (cut if i else 0) + sum(steps[i : i + u]), least)
                best = min(best, *(base + math.log10((j - k) // u) for k, base in starts))
        if j > 1 and low[j - 2 : j] in pairs:
            walked += 1
            if walked >= 2:
                _start(walk_held, j - 3, done[j - 3] + (cut if j > 3 else 0) + walk, 3)
                best = min(best, *(base + math.log10(j - k) for k, base in walk_held))
        else:
            walked = 0
            walk_held.clear()
        done.append(best)
        if best >= enough:
            open_starts = [base for of_unit in held for starts in of_unit for _, base in starts] + [base for _, base in walk_held]
            if (least_now := min(tail, *done[-window - 1 :], *open_starts)) >= enough:
                return least_now
    return done[-1]


def guess_cost(value: str, enough: float = math.inf, ranks: Mapping[str, int] | None = None) -> float:
    """Least log10 guesses over all ways to cut the value into spans: words, dates, repeats of any unit,
    keyboard walks, and brute force.

    Each span past the first doubles the guesses, for the order of spans;
    neighbouring brute-force characters form one span. Repeats and walks may be as
    long as the value; of their many starts only those that can still be best are kept, so the
    time is linear in the value. Costs only add up, so once all that a later step can
    start from costs ``enough``, the whole value does: a bound of at least
    ``enough`` is then returned. A character costs one at least, so a repeat whose unit is longer
    than the least cost found without it can't be cheaper, and need not be tried.
    """
    ranks = words() if ranks is None else ranks if isinstance(ranks, Ranks) else Ranks(ranks)
    units = min(UNITS, len(value) // 2)
    while True:
        cost = _least(value, enough, ranks, units)
        if units >= len(value) // 2 or min(cost, enough) <= units + 1:
            return cost
        units = min(len(value) // 2, int(min(cost, enough)) + 1)


def scan(text: str, ranks: Mapping[str, int] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of every span, in order."""
    found = []
    if ASSIGN_HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if LONG_HEX.search(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    if CONTEXT_HINT.search(text):
        base = sorted(found)
        for m in CONTEXT.finditer(text):
            a, b = m.span(1)
            if b - a >= MIN_VALUE and not any(x <= a and b <= y for x, _, y in base) and guess_cost(m[1], MIN_COST, ranks) >= MIN_COST:
                found.append((a, 3, b))
    return sorted(found)


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan_batches(ranks: Broadcast):  # noqa: ANN202
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans")}
            for text in batch.column(1):
                spans = scan(text.as_py() or "", ranks.value)
                for kind, name in enumerate(("n_assign", "n_access", "n_hex", "n_guess")):
                    out[name].append(sum(k == kind for _, k, _ in spans))
                out["base_sha256"].append(hashlib.sha256(told([x for x in spans if x[1] < 3]).encode()).hexdigest())
                out["spans"].append(told(spans))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **out})

    return batches


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _scan_batches(word_ranks(docs)), "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")


def redact(text: str, ranks: Mapping[str, int] | None = None) -> str:
    """The text with every stretch of spans replaced by the name of its first kind."""
    out, at, spans = [], 0, scan(text, ranks)
    k = 0
    while k < len(spans):
        a, kind, b = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] < b:
            k += 1
            b = max(b, spans[k][2])
        out += [text[at:a], f"<{KINDS[kind]}>"]
        at, k = b, k + 1
    return "".join([*out, text[at:]]) if out else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The same rows with their secrets replaced; null stays null."""
    ranks = word_ranks(docs)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            k = b.schema.get_field_index("text")
            new = pa.array([None if t is None else redact(t, ranks.value) for t in b.column(k).to_pylist()], b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays([new if i == k else c for i, c in enumerate(b.columns)], schema=b.schema)

    return docs.mapInArrow(batches, docs.schema)
