"""Exact top-k search by inner product, with MaxScore over the components as terms.

A vector is taken as a document whose terms are its non-zero components. Each task
builds, for a bounded shard of rows, one posting list per component with the bounds
of its values. A query's terms are sorted by the most they can add; the longest run
of the smallest ones whose bounds stay below the k-th best score known is
non-essential: a row that is in no essential list cannot enter the result. Essential
lists are traversed, the others probed, the largest first, only for rows that can
still reach that score. The shards' best are merged by a window.

The k-th best score starts from a first search of one row in ``SEED``, so that a
shard returns only rows that can matter. Queries go to the tasks in blocks of at most
``BLOCK`` components, and rows are read once per block; nothing is dealt to pairs.

Scores are exact: sums below 2^53 in doubles, larger ones in whole numbers of any
size; what a long cannot hold counts as its nearest end. Vectors that are null, or
hold a null or a component that isn't finite, take no part. Vectors of other
lengths: missing components count as zero, an empty vector scores zero. Ties: the
smaller vec_id first, null ids last. Repeated rows: each is a row of its own, a query
of its own, and a candidate of the others. Null vec_id: a candidate, no query. Empty
table, or no query: no rows. Very long vectors: a shard holds fewer rows, one at
least. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailytally.llm.common import gapless_rank, stored

K = 10
SCALE = 1024.0
#: Components of a block of queries, and of a shard of rows, at most.
BLOCK = 1 << 20
SHARD = 1 << 20
#: One row in so many gives the first bounds.
SEED = 16
#: Sums below it are exact in doubles.
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def whole(x: np.ndarray) -> np.ndarray:
    """The components as whole numbers, in doubles."""
    return np.floor(SCALE * x.astype(np.float64))


@dataclass
class Block:
    """Queries: row, id, components one after the other, and the least score of interest (or none)."""

    rows: np.ndarray
    ids: np.ndarray
    flat: np.ndarray
    off: np.ndarray
    least: list[int | None]


class Shard:
    """Posting lists of a bounded number of rows."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, known: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.rows, self.ids, self.known = rows, ids, known
        n, width = len(rows), int(sizes.max(initial=0))
        self.x = np.zeros((n, width), order="F")
        at = np.repeat(np.arange(n), sizes)
        self.x[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        self.high = self.x.max(0, initial=0.0)
        self.low = self.x.min(0, initial=0.0)
        # A list that most rows are in is a whole column; others hold their rows.
        self.lists = [r if len(r := np.flatnonzero(self.x[:, d])) * 4 < n else None for d in range(width)]

    def exact(self, q: np.ndarray) -> np.ndarray:
        """All scores in whole numbers of any size, for queries beyond what doubles hold."""
        terms = [(d, int(q[d])) for d in np.flatnonzero(q)]
        out = [sum(w * int(row[d]) for d, w in terms) for row in self.x]
        return np.array([min(MOST, max(LEAST, s)) for s in out], np.int64)

    def search(self, q: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of all rows that score ``least`` or more (without it: of all)."""
        n, width = self.x.shape
        q = q[:width]
        q = np.concatenate([q, np.zeros(width - len(q))])
        if float(np.abs(q) @ np.maximum(self.high, -self.low)) >= EXACT:
            scores = self.exact(q)
            keep = np.arange(n) if least is None else np.flatnonzero(scores >= least)
            return keep, scores[keep]
        gain = np.maximum(q * self.high, q * self.low)  # what a term adds at most; 0 or more
        order = np.flatnonzero(q)
        order = order[np.argsort(gain[order], kind="stable")]
        if least is None or least <= 0:  # also a row in no list may score enough
            essential, others, dense = order, order[:0], True
        else:
            cut = int(np.searchsorted(np.cumsum(gain[order]), least, "left"))  # their sum stays below
            essential, others = order[cut:], order[:cut]
            dense = any(self.lists[d] is None for d in essential)
        score = np.zeros(n)
        seen = None if dense else np.zeros(n, bool)
        for d in essential:
            rows = self.lists[d]
            if rows is None:
                score += q[d] * self.x[:, d]
            else:
                score[rows] += q[d] * self.x[rows, d]
                if seen is not None:
                    seen[rows] = True
        rest = float(gain[others].sum())
        alive = np.arange(n) if seen is None else np.flatnonzero(seen)
        for d in others[::-1]:
            alive = alive[score[alive] + rest >= least]
            score[alive] += q[d] * self.x[alive, d]
            rest -= gain[d]
        if least is not None:
            alive = alive[score[alive] >= least]
        return alive, score[alive].astype(np.int64)


class Best:
    """The k best of a query so far in a task."""

    def __init__(self, k: int, least: int | None) -> None:
        self.k, self.least = k, least
        self.ids, self.rows, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.known = np.zeros(0, bool)

    def add(self, shard: Shard, at: np.ndarray, scores: np.ndarray) -> None:
        if not len(at):
            return
        ids, known = np.concatenate([self.ids, shard.ids[at]]), np.concatenate([self.known, shard.known[at]])
        rows, scores = np.concatenate([self.rows, shard.rows[at]]), np.concatenate([self.scores, scores])
        # ~score turns the order round without overflow.
        best = np.lexsort((rows, ids, ~known, ~scores))[: self.k]
        self.ids, self.known, self.rows, self.scores = ids[best], known[best], rows[best], scores[best]
        if len(best) == self.k:
            last = int(self.scores[-1])
            self.least = last if self.least is None else max(last, self.least)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Shard]:
    """Rows (row, vec_id, embedding), put together up to ``size`` components."""
    held: list[tuple] = []
    total = 0

    def make() -> Shard:
        rows, ids, known, flat, sizes = (np.concatenate(c) for c in zip(*held, strict=True))
        return Shard(rows, ids, known, flat, sizes)

    for b in batches:
        col = b.column(2)
        off = np.asarray(col.offsets).astype(np.int64)
        values = whole(np.asarray(col.values))
        rows, known = np.asarray(b.column(0)), np.asarray(b.column(1).is_valid())
        ids = np.asarray(b.column(1).fill_null(0))
        a = 0
        while a < b.num_rows:
            to = max(a + 1, int(np.searchsorted(off, off[a] + size - total, "right")) - 1)
            if held and off[to] - off[a] + total > size:
                yield make()
                held, total = [], 0
                continue
            held.append((rows[a:to], ids[a:to], known[a:to], values[off[a] : off[to]], np.diff(off[a : to + 1])))
            total += int(off[to] - off[a]) + (to - a)
            a = to
            if total >= size:
                yield make()
                held, total = [], 0
    if held:
        yield make()


def search_block(rows: DataFrame, block: Block, k: int, shard: int) -> DataFrame:
    """At most k rows of each task for each query of the block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, v) for v in block.least]
        for part in _shards(batches, shard):
            for i, b in enumerate(best):
                at, scores = part.search(block.flat[block.off[i] : block.off[i + 1]], b.least)
                other = part.rows[at] != block.rows[i]
                b.add(part, at[other], scores[other])
        sizes = np.array([len(b.rows) for b in best], np.int64)
        if sizes.sum():
            def joined(name: str) -> np.ndarray:
                return np.concatenate([getattr(b, name) for b in best])

            ids = pa.array(joined("ids"), mask=~joined("known"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(block.rows, sizes)), pa.array(np.repeat(block.ids, sizes)), ids, pa.array(joined("rows")), pa.array(joined("scores"))],
                names=["query_row", "query_id", "vec_id", "row", "score"])

    return rows.mapInArrow(search, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """query_row, query_id, rank, vec_id, row, score. Both frames are stored ones with row (unique), vec_id, embedding."""
    spark = rows.sparkSession
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    if not size.n:
        return _ranked(spark.createDataFrame([], FOUND), k)
    each = max(1, block // max(1, size.width))  # queries of a block
    blocks = -(-size.n // each)
    if blocks > 1:
        queries = stored(gapless_rank(queries, [], ["row"], "_rank", size.n).withColumn("_block", F.floor(F.col("_rank") / each)), "topk-queries")
    tasks = rows.rdd.getNumPartitions()
    seed = rows.filter(F.pmod(F.xxhash64("row"), F.lit(SEED)) == 0).coalesce(max(1, tasks // SEED))
    found = None
    for i in range(blocks):
        own = queries.filter(F.col("_block") == i) if blocks > 1 else queries
        got = own.select("row", "vec_id", "embedding").toArrow()  # at most ``block`` components
        col = got.column("embedding").combine_chunks()
        off = np.asarray(col.offsets).astype(np.int64) - col.offsets[0].as_py()
        flat = whole(np.asarray(col.flatten()))
        of = got.column("row").to_numpy()
        b = Block(of, got.column("vec_id").to_numpy(), flat, off, [None] * len(of))
        # The k-th best score among the seed's rows: one number per query of the block.
        first = _ranked(search_block(seed, b, k, shard), k).filter(F.col("rank") == k).select("query_row", "score").toArrow()
        least = dict(zip(first.column(0).to_pylist(), first.column(1).to_pylist(), strict=True))
        b.least = [least.get(r) for r in of.tolist()]
        part = search_block(rows, b, k, shard)
        part = stored(part, "topk-found") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    return _ranked(found, k)


def search_embeddings(embeddings: DataFrame, every: int = 100, k: int = K, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The k best other rows of each row whose vec_id is divisible by ``every``."""
    x = F.col("embedding")
    good = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * SCALE < float("inf")))
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x).filter(good)
    rows = stored(own.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "embedding"), "topk-rows")
    return top_k(rows, rows.filter(F.col("vec_id") % every == 0), k, block, shard)
