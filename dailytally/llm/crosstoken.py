"""Alignment of two tokenizers' tokens, by an associative monoid of fragments.

Both tokenizers cut the same bytes. Where tokens of both end, the text falls into groups;
within a group, A and B tokens whose byte ranges overlap are linked.

A fragment describes a range of bytes: an open prefix (tokens up to the first shared end,
which may continue a group begun before), closed groups, and an open suffix (tokens after
the last shared end); without a shared end all of it is open. Two neighbours compose by
joining the left suffix to the right prefix, which is a closed group if both hold a shared end. That is associative, so texts of more than ``CHUNK`` bytes are cut into byte
ranges, which tasks turn into fragments, and neighbours are composed ``FAN`` at a time until
one is left. Shorter texts are one fragment, made where they are encoded.

An id pair's count is the number of documents that hold it linked. Pairs of a document are
stored once, packed; counts are summed after a combine within each task. Counts of up to
``PAIRS`` different pairs are broadcast, in sorted arrays of 13 bytes a pair, so at most
54 MB; beyond that the documents' pairs are joined with them by a shuffle.

Null or empty text, or one whose joined A or B bytes aren't a space and the text: no tokens,
zeros, empty groups. Special tokens' strings are plain text. Repeated rows: each is a document
and counts. Null doc_id: aligned like others. Very long texts: encoded by one task (a
row's text is in one task anyway), aligned by many. Empty table: no rows. Extra columns are never
read.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.llm import packing
from dailytally.llm.common import stored, utf8

#: Bytes of a chunk of a long text.
CHUNK = 1 << 16
#: Neighbours composed at a time.
FAN = 8
#: Different pairs whose counts are broadcast, at most.
PAIRS = 1 << 22
#: Bytes of text encoded at a time.
RUN = 1 << 18
#: The space sign of B's pieces; the printable bytes that A's vocabulary writes as themselves.
SPACE_SIGN = "▁"
FAR = 1 << 62
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]


class Vocabulary:
    """Token bytes by id, one after the other, and their lengths."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens) + b"\0", np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, joined."""
        n = self.size[ids]
        total = int(n.sum())
        shift = np.repeat(self.start[ids] - (np.cumsum(n) - n), n)
        return self.data[np.arange(total) + shift]


class Tokenizers:
    """A: byte-level BPE from a JSON file; B: a piece model. Loaded once per task."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.a = packing.Ids(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = {chr(b): b for b in PRINTABLE}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(PRINTABLE))}
        vocab = self.a.tokenizer.get_vocab(with_added_tokens=True)
        of_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            of_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        of_b = []
        for i in range(self.b.get_piece_size()):
            p = self.b.id_to_piece(i)
            of_b.append(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_SIGN, " ").encode())
        self.of_a, self.of_b = Vocabulary(of_a), Vocabulary(of_b)
        self.ids = Ids(len(of_a), len(of_b))

    def ids_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has. Texts with a special token's string are encoded as plain text."""
        got = [self.a.plain(" " + t) if any(s in t for s in self.a.special) else self.a(" " + t) for t in texts]
        return np.frombuffer(b"".join(got), "<u4").astype(np.int64), np.array([len(x) // 4 for x in got], np.int64)

    def ids_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.b.encode(texts, num_threads=1)
        return np.fromiter(itertools.chain.from_iterable(got), np.int64), np.array([len(x) for x in got], np.int64)


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Tokenizers(a_path, b_path)
    return _LOADED[a_path, b_path]


@dataclass
class Tokens:
    """Tokens of both sides in a range of bytes: ids, and ends from the text's start."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def part(self, after: int, to: int) -> Tokens:
        """The tokens that end in (after, to]."""
        i, j = (np.searchsorted(e, (after, to), "right") for e in (self.a_end, self.b_end))
        return Tokens(self.a[i[0] : i[1]], self.a_end[i[0] : i[1]], self.b[j[0] : j[1]], self.b_end[j[0] : j[1]])

    def __add__(self, right: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(vars(self).values(), vars(right).values(), strict=True)))

    def shared(self) -> np.ndarray:
        return np.intersect1d(self.a_end, self.b_end, assume_unique=True)


NO_TOKENS = Tokens(*[np.zeros(0, np.int64)] * 4)


@dataclass
class Closed:
    """Closed groups: how many tokens, groups and links, their text, the linked pairs and how often each is."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: str = ""  # each group behind a ``;``
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, "<u8"))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, "<u4"))

    def __add__(self, right: Closed) -> Closed:
        codes, at = np.unique(np.concatenate([self.codes, right.codes]), return_inverse=True)
        times = np.zeros(len(codes), "<u4")
        np.add.at(times, at, np.concatenate([self.times, right.times]))
        return Closed(self.n_a + right.n_a, self.n_b + right.n_b, self.n_groups + right.n_groups,
                      self.n_links + right.n_links, self.text + right.text, codes, times)


@dataclass
class Fragment:
    """A range of bytes. ``split``: it holds a shared end; if not, the head is all of it."""

    head: Tokens  # open prefix, up to the first shared end
    closed: Closed
    tail: Tokens  # open suffix, after the last shared end
    split: bool

    @classmethod
    def of(cls, t: Tokens, ids: Ids) -> Fragment:
        ends = t.shared()
        if not len(ends):
            return cls(t, Closed(), NO_TOKENS, False)
        first, last = int(ends[0]), int(ends[-1])
        return cls(t.part(-1, first), closed(t.part(first, last), ids), t.part(last, FAR), True)

    def then(self, right: Fragment, ids: Ids) -> Fragment:
        """The neighbour to the right, composed: associative."""
        if not self.split:
            return Fragment(self.head + right.head, right.closed, right.tail, right.split)
        if not right.split:
            return Fragment(self.head, self.closed, self.tail + right.head, True)
        return Fragment(self.head, self.closed + closed(self.tail + right.head, ids) + right.closed, right.tail, True)

    def whole(self, ids: Ids) -> Closed:
        """All groups of a whole text: its first one is the head, nothing is open at its end."""
        return closed(self.head, ids) + self.closed


def closed(t: Tokens, ids: Ids) -> Closed:
    """Tokens that begin and end at a shared end."""
    if not len(t.a):
        return Closed()
    got = {k: v[0] for k, v in results(t, t.a_end[-1:], ids).items()}
    return Closed(got["n_a"], got["n_b"], got["n_groups"], got["n_links"], ";" + got["groups"],
                  np.frombuffer(got["pairs"], "<u8"), np.frombuffer(got["times"], "<u4"))


class Ids:
    """Decimal ids behind the sign that comes before them, and the code of a pair."""

    def __init__(self, size_a: int, size_b: int) -> None:
        self.size, self.width = max(size_a, size_b), size_b
        ids = [str(i) for i in range(self.size)]
        self.all = np.array([s + i for s in ",;|" for i in ids], object)

    def __call__(self, ids: np.ndarray, sign: np.ndarray) -> np.ndarray:
        return self.all[ids + sign * self.size]


def results(t: Tokens, text_end: np.ndarray, ids: Ids) -> dict[str, list]:
    """The results of texts, one after the other, that end at ``text_end``."""
    ends, stretch = t.shared(), np.union1d(t.a_end, t.b_end)
    a_group, b_group = np.searchsorted(ends, t.a_end), np.searchsorted(ends, t.b_end)
    # One link for each stretch between two ends of any side.
    link_a, link_b = np.searchsorted(t.a_end, stretch), np.searchsorted(t.b_end, stretch)
    cut = {"n_a": t.a_end, "n_b": t.b_end, "n_groups": ends, "n_links": stretch}
    cut = {k: np.searchsorted(v, text_end, "right") for k, v in cut.items()}
    out: dict[str, list] = {k: np.diff(v, prepend=0).tolist() for k, v in cut.items()}

    # All ids as text, by group, A's before B's: ``;`` opens a group, ``|`` its B side.
    in_a, in_b = np.bincount(a_group, minlength=len(ends)), np.bincount(b_group, minlength=len(ends))
    before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    items = np.empty(len(t.a) + len(t.b), object)
    i, j = np.arange(len(t.a)), np.arange(len(t.b))
    items[i + before_b[a_group]] = ids(t.a, (i == before_a[a_group]) * 1)
    items[j + (before_a + in_a)[b_group]] = ids(t.b, (j == before_b[b_group]) * 2)
    said = items.tolist()
    at = [0, *(cut["n_a"] + cut["n_b"]).tolist()]
    out["groups"] = ["".join(said[s:e])[1:] for s, e in zip(at[:-1], at[1:], strict=True)]

    code = t.a[link_a] * ids.width + t.b[link_b]
    text = np.searchsorted(text_end, stretch)
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    codes, times = code[first].astype("<u8"), np.diff(first, append=len(code)).astype("<u4")
    of = np.searchsorted(text[first], np.arange(len(text_end) + 1))
    out["pairs"] = [codes[s:e].tobytes() for s, e in zip(of[:-1], of[1:], strict=True)]
    out["times"] = [times[s:e].tobytes() for s, e in zip(of[:-1], of[1:], strict=True)]
    return out


ALIGNED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"
CHUNKS = ", row_chunk int, fragment binary"
NAMES = [f.split()[0] for f in ALIGNED.split(", ")]


def _batch(columns: dict[str, list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def _encoded(docs: DataFrame, a_path: str, b_path: str, chunk: int) -> DataFrame:
    """Short texts' results, and long texts' chunks of tokens (without results)."""
    schema = ALIGNED + CHUNKS
    names = [*NAMES, "row_chunk", "fragment"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a_path, b_path)
        for b in batches:
            data, off = utf8(b.column(2))
            size = np.diff(off) + 1
            a = 0
            while a < b.num_rows:  # a text longer than a chunk is a run of its own
                to = min(b.num_rows, max(a + 1, int(np.searchsorted(off, off[a] + RUN, "right")) - 1))
                over = np.flatnonzero(size[a:to] > chunk)
                if len(over):
                    to = a + max(1, int(over[0]))
                yield run(t, b.slice(a, to - a), data[off[a] : off[to]], size[a:to])
                a = to

    def run(t: Tokenizers, b: pa.RecordBatch, data: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        said = b.column(2).to_pylist()
        a, n_a = t.ids_a(said)
        c, n_c = t.ids_b(said)
        # What the joined bytes must be: a space and the text.
        want = np.full(int(size.sum()), 32, np.uint8)
        rest = np.ones(len(want), bool)
        rest[np.cumsum(size) - size] = False
        want[rest] = data
        good = size > 1
        for ids, n, vocab in ((a, n_a, t.of_a), (c, n_c, t.of_b)):
            good &= np.bincount(np.repeat(np.arange(len(n)), n), vocab.size[ids], len(n)).astype(np.int64) == size
        kept, text = np.repeat(good, size), np.repeat(np.arange(len(size)), size)
        fits = good.copy()
        for ids, n, vocab in ((a, n_a, t.of_a), (c, n_c, t.of_b)):
            other = vocab.joined(ids[np.repeat(fits, n)]) != want[kept]
            good[text[kept][other]] = False
        a, c = a[np.repeat(good, n_a)], c[np.repeat(good, n_c)]
        f = Tokens(a, np.cumsum(t.of_a.size[a]), c, np.cumsum(t.of_b.size[c]))
        ids, rows = b.column(0).to_pylist(), b.column(1).to_pylist()
        if (good & (size > chunk)).any():
            return _batch(chunks(f, ids[0], rows[0]), schema)
        out = {n: [None] * len(size) for n in names} | {"doc_id": ids, "row": rows}
        number = np.cumsum(good) - 1
        for k, v in results(f, np.cumsum(size[good]), t.ids).items():
            empty = 0 if k.startswith("n_") else "" if k == "groups" else b""
            out[k] = [v[i] if g else empty for i, g in zip(number.tolist(), good.tolist(), strict=True)]
        return _batch(out, schema)

    def chunks(f: Tokens, doc_id: int | None, row: int) -> dict[str, list]:
        """The tokens that end in each range of bytes, nothing else done about them."""
        bounds = [-1, *range(chunk, int(f.a_end[-1]), chunk), int(f.a_end[-1])]
        parts = [pickle.dumps(f.part(s, e)) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        out = {n: [None] * len(parts) for n in names}
        return out | {"doc_id": [doc_id] * len(parts), "row": [row] * len(parts), "row_chunk": list(range(len(parts))), "fragment": parts}

    return docs.mapInArrow(encode, schema)


FRAGMENT = "doc_id long, row long, row_chunk int, fragment binary"


def _reduced(chunks: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Long texts: a fragment of each chunk, composed with its neighbours until one is left."""
    names = [f.split()[0] for f in FRAGMENT.split(", ")]

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokenizers(a_path, b_path).ids
        for b in batches:
            for i in range(b.num_rows):
                f = Fragment.of(pickle.loads(b.column(3)[i].as_py()), ids)
                yield pa.RecordBatch.from_arrays([*[c.slice(i, 1) for c in b.columns[:3]], pa.array([pickle.dumps(f)], pa.binary())], names=names)

    def composed(key: tuple, table: pa.Table) -> pa.Table:
        ids = tokenizers(a_path, b_path).ids
        t = table.sort_by("row_chunk")
        f, *others = (pickle.loads(x.as_py()) for x in t.column("fragment"))
        for o in others:
            f = f.then(o, ids)
        return pa.table([t.column("doc_id").slice(0, 1), t.column("row").slice(0, 1), pa.array([key[1].as_py()], pa.int32()),
                         pa.array([pickle.dumps(f)], pa.binary())], names=names)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokenizers(a_path, b_path).ids
        for b in batches:
            for i in range(b.num_rows):
                c = pickle.loads(b.column(3)[i].as_py()).whole(ids)
                yield _batch({"doc_id": [b.column(0)[i].as_py()], "row": [b.column(1)[i].as_py()], "n_a": [c.n_a], "n_b": [c.n_b], "n_groups": [c.n_groups],
                              "n_links": [c.n_links], "groups": [c.text[1:]], "pairs": [c.codes.tobytes()], "times": [c.times.tobytes()]}, ALIGNED)

    most = chunks.agg(F.max("row_chunk")).first()[0]
    if most is None:
        return chunks.select(*NAMES)  # none
    parts = chunks.select(*names).repartition("row", "row_chunk").mapInArrow(fragments, FRAGMENT)
    while most > 0:
        up = parts.withColumn("up", F.floor(F.col("row_chunk") / FAN).cast("int"))
        parts, most = up.groupBy("row", "up").applyInArrow(composed, FRAGMENT), most // FAN
    return parts.mapInArrow(finished, ALIGNED)


def align(docs: DataFrame, a_path: str, b_path: str, groups: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id, row (unique), n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``: A and B ids), pairs
    and times (the linked id pairs, packed as 64-bit codes A * size of B + B, and how often each is there).
    ``groups`` may be an expression on that column, which is then kept in its place."""
    groups = F.col("groups") if groups is None else groups
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    got = stored(_encoded(own, a_path, b_path, chunk).withColumn("groups", groups), "crosstoken")
    long = _reduced(got.filter(F.col("row_chunk").isNotNull()), a_path, b_path).withColumn("groups", groups)
    return got.filter(F.col("row_chunk").isNull()).select(*NAMES).unionByName(stored(long, "crosstoken-long"))


def align_digests(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK, broadcast: int = PAIRS) -> DataFrame:
    """Per document the alignment's counts and digest, and how its links fare in the corpus."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = align(docs, a_path, b_path, digest, chunk)
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    score = scored(found, pair_counts(found), width, broadcast)
    return found.join(score, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), F.col("groups").alias("groups_sha256"))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch with its pairs' codes and the number of pairs of each row."""
    for b in batches:
        data, off = utf8(b.column("pairs"))
        yield b, np.frombuffer(data[off[0] : off[-1]].tobytes(), "<u8"), np.diff(off) // 8


def pair_counts(found: DataFrame, held: int = PAIRS) -> DataFrame:
    """code, count: how many documents hold the pair linked. Combined within a task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, total = [], 0

        def batch() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"])

        for _, codes, _ in _codes(batches):
            parts.append(codes)
            total += len(codes)
            if total >= held:
                yield batch()
                parts, total = [], 0
        if total:
            yield batch()

    return found.select("pairs").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("count"))


SCORED = "row long, n_best long, count_sum long"


def scored(found: DataFrame, counts: DataFrame, width: int, broadcast: int = PAIRS) -> DataFrame:
    """row, n_best, count_sum: a document's links whose count is the highest of their A id, and the sum of counts."""
    a_id = F.floor(F.col("code") / width)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("top"))
    known = stored(counts.withColumn("a", a_id).join(top, "a").select("code", "count", (F.col("count") == F.col("top")).alias("best")), "crosstoken-counts")
    if known.count() <= broadcast:
        got = known.orderBy("code").toArrow()
        code, count, best = (got.column(i).to_numpy() for i in range(3))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, codes, n in _codes(batches):
                at = np.searchsorted(code, codes.astype(np.int64))
                data, off = utf8(b.column("times"))
                times = np.frombuffer(data[off[0] : off[-1]].tobytes(), "<u4").astype(np.int64)
                row = np.repeat(np.arange(b.num_rows), n)
                sums = [np.zeros(b.num_rows, np.int64) for _ in range(2)]
                np.add.at(sums[0], row, times * best[at])
                np.add.at(sums[1], row, times * count[at])
                yield pa.RecordBatch.from_arrays([b.column("row"), *map(pa.array, sums)], names=["row", "n_best", "count_sum"])

        return found.select("row", "pairs", "times").mapInArrow(look_up, SCORED)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, codes, n in _codes(batches):
            data, off = utf8(b.column("times"))
            times = np.frombuffer(data[off[0] : off[-1]].tobytes(), "<u4").astype(np.int64)
            row = np.repeat(np.asarray(b.column("row")), n)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(codes.astype(np.int64)), pa.array(times)], names=["row", "code", "times"])

    links = found.select("row", "pairs", "times").mapInArrow(spread, "row long, code long, times long")
    return links.join(known, "code").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
