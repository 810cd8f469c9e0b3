"""Near-duplicate groups by MinHash: banding, signatures, exact confirmation, components.

A text's set is its distinct hashed shingles of ``k`` words (fewer words: the
whole sequence; none: empty, linked with nothing). Texts of equal sets form one
node. ``BANDS`` bands of ``ROWS`` universal-hash minima bring nodes together: a
pair at the threshold 0.8 shares no band with a chance of about 3 in a million.

First each node is compared with one centre per bucket, the node that meets most
others, so a bucket costs as many pairs as it has nodes. The links found give
components. Buckets that still hold several components are then compared within
tasks, in blocks of about ``SIGNATURE_ROWS`` nodes against as many, by signatures alone: only
pairs of different components, each pair in the first bucket that it shares. Nodes
with a likely partner meet again with their texts, in blocks of about ``BLOCK_ROWS``,
where pairs are confirmed, the likeliest first, until they are joined. No pairs are handed on but links, and no link is lost
that could join two groups. Pairs whose signatures are far below the threshold
are dropped, all others confirmed on the full sets.

Words are runs without white space, A-Z lower-cased. Null doc_id: linked like
others but never a group's id; without any other id in the group component_id is
null and the row is kept. Repeated rows: one document, each row returned.
Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import runs, stored, text_key, texts, utf8
from dailytally.llm.components import components

BANDS, ROWS = 32, 5
PERCENT = 80
#: Hash functions (a multiple of 8, below 2040); the first BANDS * ROWS make the bands, all together (a byte each) the signature.
HASHES = 480
#: Pairs whose signatures agree in less than this share are not confirmed: five
#: standard deviations below the threshold.
LIKELY = 0.71
#: Nodes of a block: with their texts, and with their signatures alone.
BLOCK_ROWS = 400
SIGNATURE_ROWS = 2000
RUN_BYTES = 1 << 20
#: Shingles hashed at once, for the processor's cache.
BLOCK = 128

_SEED = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A value for each byte at each of the first places of a word; later places take theirs when met.
PLACES = 64
_VALUES = mixed(np.arange(1, PLACES * 256 + 1, dtype=np.uint64) * _SEED)


def _values(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The value of each byte at its place in its word. A word's hash is their sum, so words are told
    apart like random numbers of 64 bits, whatever pattern their bytes have."""
    at = place * 256 + x
    out = _VALUES.take(at, mode="clip")
    far = np.flatnonzero(place >= PLACES)
    out[far] = mixed((at[far].astype(np.uint64) + np.uint64(1)) * _SEED)
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts data[off[i]:off[i+1]], and the number of each text's words."""
    if off[-1] - off[0] > RUN_BYTES:  # a single long text: in stretches that end with white space
        text, found, at = data[off[0] : off[-1]], [], 0
        while at < len(text):
            to = min(len(text), at + RUN_BYTES)
            if to < len(text):
                gaps = np.flatnonzero(_SPACE[text[at:to]])
                if not len(gaps):  # one word longer than a run: by its digest
                    rest = np.flatnonzero(_SPACE[text[to:]])
                    to = to + int(rest[0]) if len(rest) else len(text)
                    word = _LOWER[text[at:to]].tobytes()
                    found.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64))
                    at = to
                    continue
                to = at + int(gaps[-1]) + 1
            found.append(word_hashes(text, np.array([at, to]))[0])
            at = to
        h = np.concatenate(found)
        return h, np.array([len(h)])
    base, x = off[0], _LOWER[data[off[0] : off[-1]]]
    n = len(x)
    word = ~_SPACE[x]
    edge = np.zeros(n + 1, bool)
    edge[off - base] = True
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | edge[1:n]
    ends[:-1] &= ~word[1:] | edge[1:n]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total = np.zeros(n + 1, np.uint64)
    if len(a):
        place = np.arange(n)
        place[a[0] :] -= np.repeat(a, np.diff(a, append=n))
        np.cumsum(_values(x, place), out=total[1:])
    h = mixed(total[b] - total[a])
    return h, np.diff(np.searchsorted(a, off - base))


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    c = mixed(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    for at, to in runs(off, RUN_BYTES):
        h, counts = word_hashes(data, off[at : to + 1])
        ends = np.cumsum(counts)
        whole = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for j in range(k if len(whole) else 0):
            whole += h[j : j + len(whole)] * c[j]
        whole = mixed(whole)
        for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
            if n >= k:
                yield np.unique(whole[end - n : end - k + 1])
            elif n:
                with np.errstate(over="ignore"):
                    yield mixed(np.array([(h[end - n : end] * c[:n]).sum() + np.uint64(n)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash functions of 32 bits, which a processor takes several at a time: odd factors and offsets, from a fixed seed."""
    a, b = np.random.default_rng(8).integers(0, 1 << 32, (2, n), np.uint32)
    return a | np.uint32(1), b


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least hash of each function over the set, of its shingles' upper 32 bits."""
    a, b = family
    x = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), BLOCK):
        h = x[at : at + BLOCK] * a
        h += b
        np.minimum(least, h.min(0), out=least)
    return least


def digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def band_keys(least: np.ndarray) -> np.ndarray:
    """For each signature, a hash of each band's minima, and of the band's number."""
    c = mixed(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    sums = (least[:, : BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS) * c).sum(2, dtype=np.uint64)
    return mixed(mixed(sums) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, tk (of the text), n_shingles, node (a digest of the set, null if empty), keys (of its bands), sig."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(HASHES)
        for b in it:
            n, node, found = [], [], []
            for s in shingle_sets(*utf8(b.column(1)), k):
                n.append(len(s))
                node.append(digest(s))
                if len(s):
                    found.append(signature(s, family))
            least = np.array(found, np.uint32).reshape(-1, HASHES)
            own = zip(band_keys(least).tolist(), least.astype(np.uint8), strict=True)
            keys, sig = zip(*[next(own) if m else (None, None) for m in n], strict=True) if n else ((), ())
            sig = [None if x is None else x.tobytes() for x in sig]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["doc_id", "tk", "n_shingles", "node", "keys", "sig"])

    own = texts(docs).withColumn("tk", text_key(F.col("text")))
    return own.mapInArrow(batches, "doc_id long, tk long, n_shingles long, node binary, keys array<long>, sig binary")


def _near_size(a: str, b: str) -> Column:
    """Sets whose sizes differ more can't reach the threshold."""
    return (F.lit(100) * F.least(F.col(a), F.col(b))) >= (F.lit(PERCENT) * F.greatest(F.col(a), F.col(b)))


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(key, node, n, m): the buckets of m > 1 nodes, a row per node."""
    rows = nodes.select(F.explode("keys").alias("key"), "node", "n")
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "key")


def star_pairs(buckets: DataFrame) -> DataFrame:
    """Each node with the centre of each of its buckets: the node of most encounters."""
    met = buckets.groupBy("node").agg(F.sum(F.col("m") - 1).alias("met"))
    centres = buckets.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node", "n")).alias("c"))
    both = buckets.join(centres, "key").filter(F.col("node") != F.col("c.node"))
    return _pairs(both.select(F.col("node").alias("a"), F.col("n").alias("x"), F.col("c.node").alias("b"), F.col("c.n").alias("y")).filter(_near_size("x", "y")))


def crowded(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, node, n, component): the buckets that hold several components."""
    named = buckets.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter(F.col("lo") != F.col("hi"))
    return named.join(several.select("key"), "key").select("key", "node", "n", "component")


def blocks(rows: DataFrame, most: int) -> DataFrame:
    """(part, side, key, node, n, component): buckets, cut into blocks of about ``most`` nodes.

    A bucket of g blocks makes a part of each pair of blocks; a node goes to
    the g parts that hold its block (side 0 or 1; 2 where both blocks are the same).
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("g"))
    own = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("g")).cast("int"))
    other = own.select("*", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    return other.select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("part"), side.alias("side"),
        "key", "node", "n", "component")


def agreement(sig: np.ndarray, own: np.ndarray) -> np.ndarray:
    """In how many places each signature (a row of bytes) agrees with ``own``: eight places are summed at once, in the bytes of a word."""
    words = np.ascontiguousarray(sig == own).view(np.uint64).sum(1, dtype=np.uint64)
    return words.view(np.uint8).reshape(-1, 8).sum(1, dtype=np.int64)


def likely_in_block(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row i, other rows, and how far their signatures agree: pairs of different components
    of one part whose sizes and signatures are near enough, in the first bucket they share."""
    group = pd.factorize(pdf["component"])[0]
    # Two parts whose hashes are the same would only bring more rows together: a bucket at a time.
    for bucket, at in pdf.groupby("key").indices.items():
        own = pdf.iloc[at]
        at, own = at[order := np.argsort(own["n"].to_numpy(), kind="stable")], own.iloc[order]
        n, side, part = own["n"].to_numpy(), own["side"].to_numpy(), group[at]
        sig = np.frombuffer(b"".join(own["sig"]), np.uint8).reshape(len(own), -1)
        # Buckets before this one, a row each: a pair that shares one of them is judged there.
        keys = np.stack(own["keys"].tolist())
        before = np.ascontiguousarray(keys[:, : int((keys[0] == bucket).argmax())].T)
        ends = np.searchsorted(PERCENT * n, 100 * n, side="right")
        for i in range(len(own) - 1):
            w = slice(i + 1, ends[i])
            met = (part[w] != part[i]) & ((side[w] != side[i]) | (side[w] == 2))
            if not met.any():
                continue
            for k in before:
                met &= k[w] != k[i]
            j = np.flatnonzero(met) + i + 1
            if not len(j):
                continue
            agree = agreement(sig[j], sig[i]) / sig.shape[1]
            near = agree >= LIKELY
            if near.any():
                yield at[i], at[j[near]], agree[near]


def partnered(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows of one part that have a likely partner in it."""
    met = np.zeros(len(pdf), bool)
    for i, j, _ in likely_in_block(pdf):
        met[i] = met[j] = True
    return pdf.loc[met, ["key", "node"]]


def link_block(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """Links between different components of one part, enough to join what they join."""
    node, group = pdf["node"].tolist(), pd.factorize(pdf["component"])[0].tolist()
    tried = [(-a, i, b) for i, j, agree in likely_in_block(pdf) for a, b in zip(agree.tolist(), j.tolist(), strict=True)]
    root = list(range(max(group) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    sets: dict[int, np.ndarray] = {}

    def own(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(unzipped(pdf["z"].iat[i]), k)
        return sets[i]

    links = []
    for _, i, j in sorted(tried):
        x, y = find(group[i]), find(group[j])
        if x != y and similar(own(i), own(j)):
            root[x] = y
            links.append((node[i], node[j]))
    return pd.DataFrame(links, columns=["a", "b"])


def shingle_set(text: bytes, k: int) -> np.ndarray:
    return next(shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]), k))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def unzipped(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree well enough to be confirmed."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            if len(b):
                x, y = (np.frombuffer(b"".join(b[c]), np.uint8).reshape(len(b), -1) for c in ("sa", "sb"))
                b = b[agreement(x, y) / x.shape[1] >= LIKELY]
            yield b[["a", "b"]]

    sig = nodes.select("node", "sig")
    both = pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    return both.mapInPandas(batches, "a binary, b binary")


def node_texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(node, z): the compressed text of a document of each wanted node."""
    rows = wanted.distinct().join(nodes.select("node", F.col("source.doc_id").alias("d"), F.col("source.tk").alias("t")), "node")
    same_text = F.col("doc_id").eqNullSafe(F.col("d")) & (text_key(F.col("text")) == F.col("t"))
    own = texts(docs).join(rows, same_text).select("node", "text")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zipper = zstandard.ZstdCompressor(level=3)
        for b in it:
            data, off = utf8(b.column(1))
            node = b.column(0).to_pylist()
            # Rows that share a doc_id and a hash but not the set are not the node's text.
            keep = [i for i, s in enumerate(shingle_sets(data, off, k)) if digest(s) == node[i]]
            z = [zipper.compress(data[off[i] : off[i + 1]].tobytes()) for i in keep]
            yield pa.RecordBatch.from_arrays([pa.array([node[i] for i in keep], pa.binary()), pa.array(z, pa.binary())], names=["node", "z"])

    return own.mapInArrow(batches, "node binary, z binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, own: DataFrame, k: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple = (None, None)
        for b in it:
            keep = []
            for _, right, za, zb in b.itertuples(index=False, name=None):
                if last[0] != right:
                    last = (right, shingle_set(unzipped(zb), k))
                keep.append(similar(shingle_set(unzipped(za), k), last[1]))
            yield b.loc[np.array(keep, bool), ["a", "b"]]

    za = own.select(F.col("node").alias("a"), F.col("z").alias("za"))
    zb = own.select(F.col("node").alias("b"), F.col("z").alias("zb"))
    return pairs.join(za, "a").join(zb, "b").select("a", "b", "za", "zb").mapInPandas(batches, "a binary, b binary")


def near_duplicates(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, node, tk, which tells rows of one doc_id apart, and component (null if the set is empty)."""
    sketch = stored(sketches(docs, k), "sketches")
    nodes = stored(
        sketch.filter("node IS NOT NULL").groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "tk")).alias("source"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig")), "nodes")
    buckets = stored(shared_buckets(nodes), "buckets")
    own = stored(node_texts(buckets.select("node"), nodes, docs, k), "texts")
    links = stored(confirmed(likely(star_pairs(buckets), nodes), own, k), "links")
    comp = stored(components(links), "components")
    # Signatures alone first: texts go to the blocks only for nodes with a likely partner.
    rows, sig = stored(crowded(buckets, comp), "crowded"), nodes.select("node", "keys", "sig")
    met = blocks(rows, SIGNATURE_ROWS).join(sig, "node").groupBy("part").applyInPandas(partnered, "key long, node binary")
    rows = rows.join(stored(met.distinct(), "partnered"), ["key", "node"])
    more = blocks(rows, BLOCK_ROWS).join(sig.join(own, "node"), "node").groupBy("part").applyInPandas(lambda pdf: link_block(pdf, k), "a binary, b binary")
    more = stored(more, "links")
    if more.take(1):
        comp = stored(components(links.unionByName(more)), "components")
    groups = nodes.select("node", "doc_id").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = groups.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = groups.join(least, "component").select("node", "component_id", "component")
    out = sketch.select("doc_id", "tk", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"), "node", "tk", "component")
