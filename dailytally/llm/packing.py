"""Best-fit packing of tokenised documents, with large items matched first.

Every document is tokenised once, in tasks, and cut into pieces of at most
``CAPACITY`` ids. Lengths are whole numbers up to the capacity, so how to pack
follows from one count per length: the driver holds these counts and a plan
whose size depends on the capacity, not on the corpus.

Pieces above a third of the capacity fit at most two to a sequence (three would
overflow): from the longest on, each is matched with the longest other one that
still fits. Smaller pieces then go, longest first, into the fullest sequence
with room for them, and open new sequences when none has. The plan says, for each
length, which ranks go to which sequences and where; Spark numbers the pieces of
each length (without a task per length) and places each by its rank.

Null or empty text: the closing id alone. Repeated rows: each is packed. Null
doc_id: packed like others. Empty table: no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import gapless_rank, stored

CAPACITY = 2048
#: The id after each document.
CLOSING = 0
#: Stretches whose ids a task remembers: so many new ones, and as many of before.
REMEMBERED = 150_000
#: Marks that form a pre-token of their own at the end of a stretch.
MARKS = (",", ".")
#: A space at which no token of a byte-level BPE can start before and end after it.
CUT = re.compile(r"(?<=\S)(?= \S)")
LOOSE = re.compile(r"\s\s")


class Ids:
    """Ids of texts as little-endian 32-bit bytes, the same as the tokenizer's.

    The pre-tokenizer splits before each single space that stands between
    characters that aren't white space, so the stretches between such spaces can
    be tokenised apart, and frequent ones be remembered. Stretches are found by a
    plain split; texts with other white space in a row go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self._ranked(spec)

    def _ranked(self, spec: dict) -> None:
        """The same vocabulary as merge ranks, for a faster encoder of plain text."""
        import public_tokenizers
        import tiktoken

        back = {c: b for b, c in _byte_letters().items()}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("from_json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.marks = {c: self.plain(c) for c in MARKS}

    def plain(self, stretch: str) -> bytes:
        return array("I", self.fast.encode_ordinary(stretch)).tobytes()

    def after_space(self, stretch: str) -> bytes:
        """The ids of a stretch with its leading space, remembered if it is short."""
        ids = self.young.get(stretch) or self.old.get(stretch)
        if ids is None:
            if stretch.isalpha():  # one pre-token
                ids = array("I", self.fast._encode_single_piece(" " + stretch)).tobytes()
            elif stretch[-1:] in MARKS and stretch[:-1].isalpha():
                ids = self.after_space(stretch[:-1]) + self.marks[stretch[-1]]
            else:
                ids = self.plain(" " + stretch)
        if len(stretch) <= 32:
            if len(self.young) >= REMEMBERED:
                self.young, self.old = {}, self.young
            self.young[stretch] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if LOOSE.search(text) or text[:1].isspace() or text[-1:].isspace():
            first, *rest = CUT.split(text)
            rest = [p[1:] for p in rest]
        else:
            first, *rest = text.split(" ")
        out = list(map(self.young.get, rest))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self.after_space(rest[i])
        return b"".join([self.plain(first), *out])


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte: itself where it
    is printable Latin-1, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: one row per piece."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(path)
        end = np.array([CLOSING], "<u4").tobytes()
        for b in it:
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = ids(text.as_py() or "") + end
                n = len(raw) // 4
                at = [0, *range(n % capacity or capacity, n, capacity), n]
                out += [(doc, k, s, e - s, zlib.crc32(raw[4 * s : 4 * e])) for k, (s, e) in enumerate(zip(at, at[1:], strict=False))]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(batches, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, pieces in each sequence, offset):
    where the pieces of each length go. Sequences of equal filling are kept as one
    group, so the plan's size follows from the capacity."""
    left, taken = dict(counts), dict.fromkeys(counts, 0)
    steps: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # room -> groups (first sequence, sequences)
    rooms: list[int] = []
    opened = 0

    def put(length: int, sequences: int, first: int, each: int, offset: int) -> None:
        steps.append((length, taken[length], sequences * each, first, each, offset))
        taken[length] += sequences * each
        left[length] -= sequences * each

    def leave(room: int, first: int, sequences: int) -> None:
        if room and sequences:
            if room not in gaps:
                gaps[room] = []
                insort(rooms, room)
            gaps[room].append((first, sequences))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for x in large:
        while left[x]:
            # The longest piece that fits beside this one, by the lengths that are left.
            y = next((y for y in large if y <= capacity - x and left[y] > (y == x)), None)
            n = left[x] if y is None else left[x] // 2 if y == x else min(left[x], left[y])
            put(x, n, opened, 1, 0)
            if y is not None:
                put(y, n, opened, 1, x)
            leave(capacity - x - (y or 0), opened, n)
            opened += n
    for x in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[x]:
            k = bisect_left(rooms, x)
            if k == len(rooms):  # as many new sequences as these pieces fill
                each = min(capacity // x, left[x])
                n = left[x] // each
                put(x, n, opened, each, 0)
                leave(capacity - each * x, opened, n)
                opened += n
                continue
            room = rooms[k]
            first, n = gaps[room].pop()
            if not gaps[room]:
                del gaps[room]
                rooms.pop(k)
            each = min(room // x, left[x])
            use = min(n, left[x] // each)
            put(x, use, first, each, capacity - room)
            leave(room - each * x, first, use)
            leave(room, first + use, n - use)
    return steps


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to (stored) pieces."""
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most one per length
    steps = pd.DataFrame(plan(counts, capacity), columns=["length", "low", "n", "first", "each", "at"]).sort_values(["length", "low"])
    table = steps.to_numpy(np.int64)
    ranked = gapless_rank(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "rank", sum(counts.values()))

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = table[:, 0] << 44 | table[:, 1]  # ranks of one length stay below 2 to the 44
        for b in it:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            t = table[np.searchsorted(key, length << 44 | rank, "right") - 1] if len(b) else table[:0]
            at = rank - t[:, 1]
            yield b.drop(columns="rank").assign(sequence_id=t[:, 3] + at // t[:, 4], offset=t[:, 5] + at % t[:, 4] * length)

    return ranked.select(*pieces.columns, "rank").mapInPandas(batches, pieces.schema.add("sequence_id", "long").add("offset", "long"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stored(pieces_of(docs, path, capacity), "pieces"), capacity)
