"""Removal of repeated 50-byte strings by phrases of a content-defined parse and their hashes.

This is not prefix-free parsing with suffix arrays: phrases come from window minima, the
dictionary is a grouping by hashes, and strings are ordered and held equal by their 64-bit
hashes, not by their bytes. There is no suffix array of the parse and no corpus order.

A rolling hash of ``K`` bytes triggers: in every string of ``LENGTH`` bytes the
(leftmost) least hash is its trigger, so equal strings have the same trigger at the
same place in them. The strings that share a trigger occurrence form a phrase: the
bytes from the first of these strings to the end of the last. A document's phrases
are its parse; each of its strings of ``LENGTH`` bytes lies in exactly one phrase.

0. Hot triggers. Triggers with more than ``HOT`` different phrases are counted out. A
   phrase of theirs is taken apart into its strings: each is a phrase of its own, known
   by its own hash, so that no task meets all phrases of a hot trigger.
1. Parse. Each task takes blocks of texts and tells phrases by their trigger's
   hash and a hash of their bytes. Of phrases repeated within a block only those of
   the smallest doc_id go on; the others are decided there.
2. Dictionary. Phrases meet by trigger. Equal ones in larger doc_ids are repeated in
   full. A trigger with several different phrases leaves candidates.
3. Suffixes. The candidates' bytes are fetched, and their strings of ``LENGTH``
   bytes are ordered by their hashes in each part of the dictionary: equal ones are
   neighbours, and the smallest doc_id keeps its own.
4. The repeated strings of each document are put together and its bytes removed.

What one task holds follows from ``PART`` and ``SUFFIX_PART``: the number of parts
grows with the input, and a trigger has at most about ``HOT`` phrases in a part, besides
equal ones: those are one document's for each block. Texts travel compressed and once: both joins use one shuffle.

Null or empty text: no bytes. Null doc_id: neither removed from nor a source. Rows
that share a doc_id are told apart by their text and don't repeat one another.
Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import runs, stored, texts, utf8

LENGTH = 50
K = 16
#: Bytes hashed at a time; bytes of text in a block; phrases and candidates in a part.
RUN_BYTES = 1 << 19
BLOCK_BYTES = 12 << 20
PART = 1_000_000
SUFFIX_PART = 100_000
#: Different phrases from which a trigger is hot; at most so many triggers are (twice this number, for the driver).
HOT = 20_000
HOT_TRIGGERS = 10_000_000

#: Odd factors of the hashes.
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_P = 0x5851F42D4C957F2D
_SPAN = RUN_BYTES + LENGTH + 8


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POW, _INV = _powers(_P, _SPAN), _powers(pow(_P, -1, 1 << 64), _SPAN)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def trigger_hashes(x: np.ndarray) -> np.ndarray:
    """The hash of the K bytes from each byte on (short ones at the end count zeros)."""
    padded = np.zeros(len(x) + K + 8, np.uint8)
    padded[: len(x)] = x
    u = np.ndarray((len(x) + K - 8,), "<u8", buffer=padded, strides=(1,)).copy()
    return _mixed((u[: len(x)] * _C1) ^ _mixed(u[8 : len(x) + 8] * _C2))


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least of each ``width`` neighbours, by doubling."""
    v, p, n = h, np.arange(len(h), dtype=np.int32), 1
    while n < width:
        d = min(n, width - n)
        right = v[d:] < v[:-d]
        p = np.where(right, p[d:], p[:-d])
        v = np.where(right, v[d:], v[:-d])
        n += d
    return p


def prefix_sums(x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * _POW[: len(x)], out=total[1:])
    return total


def stretch_hashes(total: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed((total[b] - total[a]) * _INV[a])


NO_HOT = np.zeros(0, np.uint64)


def parse(x: np.ndarray, ends: np.ndarray, hot: np.ndarray = NO_HOT) -> tuple[np.ndarray, ...]:
    """Phrases of texts that lie one after the other in x, up to ``ends``: first string's
    place, strings, place of the trigger from there, trigger's hash, bytes' hash.

    Phrases of the (sorted) hot triggers come as single strings, whose hash stands for both."""
    if len(x) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h = trigger_hashes(x)
    p = least_places(h, LENGTH - K + 1)
    valid = np.ones(len(x) + 1, bool)
    for e in ends:
        valid[max(0, e - LENGTH + 1) : e] = False
    s = np.flatnonzero(valid[: len(x) - LENGTH + 1])
    at = p[s]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(s) else np.zeros(0, np.int64)
    lo, count = s[first], np.diff(np.concatenate([first, [len(s)]]))
    total, place, h = prefix_sums(x), at[first] - lo, h[at[first]]
    hc = stretch_hashes(total, lo, lo + count + LENGTH - 1)
    if len(hot) and (own := hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h).any():
        n = count[own]
        each = np.repeat(lo[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        sh = stretch_hashes(total, each, each + LENGTH)
        lo, count, place, h, hc = (
            np.concatenate([v[~own], w])
            for v, w in ((lo, each), (count, np.ones_like(each)), (place, np.zeros_like(each)), (h, sh), (hc, sh)))
    return lo, count, place, h, hc


def parsed(data: np.ndarray, off: np.ndarray, hot: np.ndarray = NO_HOT) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, lo, count, trigger, h, hc) for runs of texts; long texts in overlapping stretches,
    which at most cuts a phrase in two."""
    for at, to in runs(off, RUN_BYTES):
        n = int(off[to] - off[at])
        if n <= RUN_BYTES:
            lo, count, place, h, hc = parse(data[off[at] : off[to]], off[at + 1 : to + 1] - off[at], hot)
            row = np.searchsorted(off[at : to + 1] - off[at], lo, "right") - 1
            yield row + at, lo - (off[at : to] - off[at])[row] if len(row) else lo, count, place, h, hc
            continue
        for a in range(0, n - LENGTH + 1, RUN_BYTES):
            x = data[off[at] + a : min(off[to], off[at] + a + RUN_BYTES + LENGTH - 1)]
            lo, count, place, h, hc = parse(x, np.array([len(x)]), hot)
            yield np.full(len(lo), at), lo + a, count, place, h, hc


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length or not, byte planes apart, compressed."""
    parts = [np.array([len(a) for a in arrays], "<u4").tobytes()]
    parts += [a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    sizes, at, out = raw[: 4 * len(kinds)].view("<u4"), 4 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        w = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).reshape(-1).view(kind))
        at += n * w
    return out


#: doc_id, key, rows of the document; then for each row: trigger's hash, bytes' hash, lo, strings, trigger's place.
PHRASES = ("<i8", "<u4", "<u4", "<u4", "<u8", "<u4", "u1", "u1")
PARSED = "part int, kind int, n int, blob binary"
#: Ranges of documents travel by buckets of documents: doc_id, key, lo, strings, trigger's place.
RANGES = ("<i8", "<u4", "<u4", "<u4", "u1")
FOUND = "bucket int, kind int, n int, blob binary"
#: Kinds of rows: repeated strings; candidates; phrases.
REPEATED, CANDIDATE, PHRASE = 0, 1, 2


def by_bucket(buckets: int, doc: np.ndarray, tk: np.ndarray, lo: np.ndarray, count: np.ndarray, place: np.ndarray | None = None) -> Iterator[tuple]:
    """(bucket, rows, packed rows): a blob for each bucket of documents."""
    if not len(doc):
        return
    place = np.zeros(len(doc), np.uint8) if place is None else place
    bucket = _mixed(doc.astype(np.int64).view(np.uint64)) % np.uint64(buckets)
    o = np.lexsort((lo, tk, doc, bucket))
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket[o])) + 1, [len(o)]])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        i = o[a:b]
        yield int(bucket[i[0]]), b - a, packed(*(v[i].astype(kind) for v, kind in zip((doc, tk, lo, count, place), RANGES, strict=True)))


def _by_document(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket's rows, one for each document: first string, strings and trigger's place, in u4."""
    got = [unpacked(x, *RANGES) for x in pdf["blob"]]
    doc, tk, *rest = (np.concatenate([g[k] for g in got]) for k in range(5))
    o = np.lexsort((rest[0], tk, doc))
    doc, tk, body = doc[o], tk[o], np.stack([c[o] for c in rest], 1).astype("<u4")
    cut = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (tk[1:] != tk[:-1])) + 1, [len(doc)]])
    rows = [(int(doc[a]), int(tk[a]), body[a:b].tobytes()) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    return pd.DataFrame(rows, columns=["doc_id", "tk", "blob"])


def joined_runs(doc: np.ndarray, tk: np.ndarray, lo: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring ranges of a document made one."""
    o = np.lexsort((lo, tk, doc))
    doc, tk, lo, count = doc[o], tk[o], lo[o], count[o]
    new = np.ones(len(o), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tk[1:] != tk[:-1]) | (lo[1:] != lo[:-1] + count[:-1])
    first = np.flatnonzero(new)
    return doc[first], tk[first], lo[first], np.add.reduceat(count, first) if len(first) else count


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["part", "kind", "n", "blob"])


def _blocks(it: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc_id, key, lo, count, place, h, hc) of the phrases of a block of texts."""
    held: list[tuple] = []
    size = 0
    for b in it:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        data, off = utf8(b.column(1))
        keys = np.array([zlib.crc32(data[off[i] : off[i + 1]]) for i in range(len(ids))], np.int64)
        for row, lo, count, place, h, hc in parsed(data, off, hot):
            held.append((ids[row], keys[row], lo, count, place, h, hc))
            size += RUN_BYTES
            if size >= BLOCK_BYTES:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _crowded_batches(share: float):  # noqa: ANN202
    """Triggers with at least this share of a block's phrases, and two, and how many different ones they have."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, h, hc in _blocks(it, NO_HOT):
            o = np.lexsort((hc, h))
            h, hc = h[o], hc[o]
            new = np.ones(len(o), bool)
            new[1:] = (h[1:] != h[:-1]) | (hc[1:] != hc[:-1])
            trigger, n = np.unique(h[new], return_counts=True)
            most = n >= max(2.0, share * len(o))
            yield pa.RecordBatch.from_arrays([pa.array(trigger[most].view(np.int64)), pa.array(n[most], pa.int64())], names=["h", "n"])

    return batches


def hot_triggers(own: DataFrame, phrases: int) -> tuple[np.ndarray, int]:
    """The sorted triggers of more than ``HOT`` different phrases (of some with half as many
    or more, too), and the number of their phrases that was counted.

    Of a trigger's phrases those are missed that lie in blocks where it has less than half the
    share that ``HOT`` is of all phrases, in all less than half of ``HOT``, or that are the only
    one in their block, so that half of ``HOT`` is asked of the others.
    """
    at = max(HOT, phrases // HOT_TRIGGERS)
    if phrases <= at:
        return NO_HOT, 0
    counted = own.mapInArrow(_crowded_batches(at / phrases / 2), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counted.filter(F.col("n") >= at / 2).collect()
    return np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64)), sum(r.n for r in rows)


def _parse_batches(parts: int, hot: np.ndarray = NO_HOT):  # noqa: ANN202
    def block(doc, tk, lo, count, place, h, hc) -> pa.RecordBatch:  # noqa: ANN001
        o = np.lexsort((doc, hc, h))
        first = np.ones(len(o), bool)
        first[1:] = (h[o][1:] != h[o][:-1]) | (hc[o][1:] != hc[o][:-1])
        least = doc[o][np.flatnonzero(first)][np.cumsum(first) - 1]
        again = np.zeros(len(o), bool)
        again[o] = doc[o] > least
        rows = []
        done = joined_runs(doc[again], tk[again], lo[again], count[again])
        rows += [(p, REPEATED, n, blob) for p, n, blob in by_bucket(parts, *done)]
        keep = np.flatnonzero(~again)
        part = (h[keep] >> np.uint64(32)) % np.uint64(parts)
        keep = keep[np.lexsort((lo[keep], tk[keep], doc[keep], part))]
        part = (h[keep] >> np.uint64(32)) % np.uint64(parts)
        cut = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(keep)]]) if len(keep) else [0]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            i = keep[a:b]
            new = np.flatnonzero(np.concatenate([[True], (doc[i][1:] != doc[i][:-1]) | (tk[i][1:] != tk[i][:-1])]))
            blob = packed(
                doc[i][new].astype("<i8"), tk[i][new].astype("<u4"), np.diff(np.concatenate([new, [len(i)]])).astype("<u4"),
                h[i].astype("<u4"), hc[i], lo[i].astype("<u4"), count[i].astype(np.uint8), place[i].astype(np.uint8))
            rows.append((int(part[a]), PHRASE, len(i), blob))
        return _table(rows)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _blocks(it, hot):
            yield block(*own)

    return batches


def _dictionary(buckets: int):  # noqa: ANN202
    """One part of the dictionary: repeated phrases and candidates, by buckets of documents."""
    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        # Ranges decided in their block came to the part of their bucket's number.
        rows = list(pdf.loc[pdf["kind"] == REPEATED, ["part", "kind", "n", "blob"]].itertuples(index=False, name=None))
        got = [unpacked(x, *PHRASES) for x in pdf.loc[pdf["kind"] == PHRASE, "blob"]]
        if got:
            doc = np.concatenate([np.repeat(g[0], g[2]) for g in got])
            tk = np.concatenate([np.repeat(g[1], g[2]) for g in got])
            h, hc, lo, count, place = (np.concatenate([g[k] for g in got]) for k in range(3, 8))
            del got
            o = np.lexsort((doc, hc, h))
            doc, tk, h, hc, lo, count, place = (v[o] for v in (doc, tk, h, hc, lo, count, place))
            group = np.concatenate([[True], h[1:] != h[:-1]])
            phrase = group | np.concatenate([[True], hc[1:] != hc[:-1]])
            least = doc[np.flatnonzero(phrase)][np.cumsum(phrase) - 1]
            again = doc > least
            several = np.add.reduceat(phrase.astype(np.int64), np.flatnonzero(group))[np.cumsum(group) - 1] > 1
            for kind, own in ((REPEATED, again), (CANDIDATE, several & ~again)):
                found = by_bucket(buckets, doc[own], tk[own].astype(np.int64), lo[own], count[own], place[own])
                rows += [(k, kind, n, blob) for k, n, blob in found]
        return pd.DataFrame(rows, columns=["bucket", "kind", "n", "blob"])

    return part


def _zipped(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zipper = zstandard.ZstdCompressor(level=3)
    for b in it:
        data, off = utf8(b.column(1))
        raw = [data[off[i] : off[i + 1]].tobytes() for i in range(len(off) - 1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array([zipper.compress(x) for x in raw], pa.binary())],
            names=["doc_id", "tk", "z"])


def _unzipped(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


#: doc_id, key, lo, strings of each candidate; and the bytes of all.
CANDIDATES = ("<i8", "<u4", "<u4", "u1", "u1")


def _fetch_batches(parts: int):  # noqa: ANN202
    """The candidates' bytes, dealt by the hash of their triggers."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            held: dict[int, list] = {}
            for d, t, z, blob in b.itertuples(index=False, name=None):
                x = np.frombuffer(_unzipped(z), np.uint8)
                lo, count, place = np.frombuffer(blob, "<u4").reshape(-1, 3).T.astype(np.int64)
                grams = x[(lo + place)[:, None] + np.arange(K)]
                u = np.ascontiguousarray(grams).view("<u8")
                part = _mixed(_mixed(u[:, 0] * _C1) ^ (u[:, 1] * _C2)) % np.uint64(parts)
                for i, p in enumerate(part.tolist()):
                    held.setdefault(p, []).append((d, t, lo[i], count[i], x[lo[i] : lo[i] + count[i] + LENGTH - 1]))
            rows = []
            for p, own in held.items():
                d, t, lo, count, body = zip(*own, strict=True)
                blob = packed(np.array(d, "<i8"), np.array(t, "<u4"), np.array(lo, "<u4"), np.array(count, np.uint8), np.concatenate(body))
                rows.append((p, len(own), blob))
            yield pd.DataFrame(rows, columns=["part", "n", "blob"])

    return batches


def _suffixes(buckets: int):  # noqa: ANN202
    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(by_bucket(buckets, *_earlier(pdf))), columns=["bucket", "n", "blob"])

    return part


def _earlier(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """The strings of one part's candidates, ordered by their hashes: those with an earlier document."""
    got = [unpacked(x, *CANDIDATES) for x in pdf["blob"]]
    doc, tk, lo, count, body = (np.concatenate([g[k] for g in got]) for k in range(5))
    del got
    count = count.astype(np.int64)
    size = count + LENGTH - 1
    start = np.cumsum(size) - size
    hashes = np.empty(int(count.sum()), np.uint64)
    first = np.cumsum(count) - count
    # Some phrases at a time, as many as the powers reach.
    a = 0
    while a < len(count):
        b = max(a + 1, int(np.searchsorted(start + size, start[a] + RUN_BYTES, "right")))
        total = prefix_sums(body[start[a] : start[b - 1] + size[b - 1]])
        k = np.arange(first[a], first[b - 1] + count[b - 1])
        owner = np.repeat(np.arange(a, b), count[a:b])
        s = start[owner] - start[a] + (k - first[owner])
        hashes[k] = stretch_hashes(total, s, s + LENGTH)
        a = b
    owner = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((doc[owner], hashes))
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    least = doc[owner[order[np.flatnonzero(new)]]][np.cumsum(new) - 1]
    hit = np.zeros(len(order), bool)
    hit[order] = doc[owner[order]] > least
    i = np.flatnonzero(hit)
    place = lo[owner[i]].astype(np.int64) + (i - first[owner[i]])
    return joined_runs(doc[owner[i]], tk[owner[i]].astype(np.int64), place, np.ones(len(i), np.int64))


def removed_mask(size: int, blob: bytes) -> np.ndarray:
    """Bytes covered by the repeated strings."""
    lo, count, _ = np.frombuffer(blob, "<u4").reshape(-1, 3).T.astype(np.int64)
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, lo + count + LENGTH - 1, -1)
    return np.cumsum(step[:-1]) > 0


def _cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in it:
        rows = []
        for d, z, blob in b[["doc_id", "z", "blob"]].itertuples(index=False, name=None):
            x = _unzipped(z)
            n, gone, spans = len(x), 0, 0
            if blob:
                mask = removed_mask(n, blob)
                gone = int(mask.sum())
                spans = int((mask[1:] & ~mask[:-1]).sum() + mask[0])
                x = np.frombuffer(x, np.uint8)[~mask].tobytes()
            rows.append((None if pd.isna(d) else int(d), n, gone, spans, hashlib.sha256(x).hexdigest(), x))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    own = texts(docs)
    size = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    named = own.filter("doc_id IS NOT NULL")
    hot, crowded = hot_triggers(named, size // 17)  # a phrase to about 17 bytes
    parts = max(1, -(-(size // 17 + 17 * crowded) // PART))
    phrases = named.mapInArrow(_parse_batches(parts, hot), PARSED)
    found = stored(phrases.groupBy("part").applyInPandas(_dictionary(parts), FOUND), "phrases")

    def by_document(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket").applyInPandas(_by_document, "doc_id long, tk long, blob binary")

    zipped = own.mapInArrow(_zipped, "doc_id long, tk long, z binary")
    candidates = found.filter(F.col("kind") == CANDIDATE)
    n = candidates.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    spans = found.filter(F.col("kind") == REPEATED).select("bucket", "n", "blob")
    if n:
        suffix_parts = max(1, -(-n // SUFFIX_PART))
        got = zipped.join(by_document(candidates), ["doc_id", "tk"]).select("doc_id", "tk", "z", "blob").mapInPandas(
            _fetch_batches(suffix_parts), "part int, n int, blob binary")
        spans = spans.unionByName(got.groupBy("part").applyInPandas(_suffixes(parts), "bucket int, n int, blob binary"))
    return zipped.join(by_document(spans), ["doc_id", "tk"], "left").select("doc_id", "z", "blob").mapInPandas(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
