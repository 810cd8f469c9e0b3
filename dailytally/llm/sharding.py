"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard: at each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the row's key and the child's name,
and the least draw wins. A child is so chosen with a probability in proportion
to its weight, and when weights change, rows move only into the subtrees whose
weights grew. A shard added by ``grown`` is a region and rack of its own:
rows that move, move into that shard and nowhere else (law ``key``).

Null doc_id: all such rows share one key, hence one shard. Null or empty text:
16 bytes, CRC-32 of nothing (0). Repeated rows: each gets its own slot. Empty
table: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import gapless_rank, stored

#: Bytes that each row takes beside its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, per_rack: int = 4, per_region: int = 8) -> list[Leaf]:
    """Racks and regions filled in order of the shards' numbers."""
    return [Leaf(s // per_region, s // per_rack, s) for s in range(shards)]


def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a rack and a region of its own."""
    return [*leaves, Leaf(1 + max(x.region for x in leaves), 1 + max(x.rack for x in leaves), 1 + max(x.shard for x in leaves), weight)]


def _least(key: Column, level: str, weights: dict[int, float]) -> Column:
    """The child with the least draw (ties: the smallest number)."""
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    def draw(child: int, w: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(child)), 11) + 1) / F.lit(float(2**53))
        return F.struct((-F.log(u) / F.lit(w)).alias("draw"), F.lit(child).alias("child"))
    return F.array_min(F.array(*[draw(c, w) for c, w in sorted(weights.items())]))["child"]


def place(rows: DataFrame, key: str, leaves: list[Leaf], prefix: str = "") -> DataFrame:
    """Adds region, rack and shard (with ``prefix``); the tree is a parameter of known size."""
    def weights(level: str, parent: str | None) -> dict[int | None, dict[int, float]]:
        found: dict[int | None, dict[int, float]] = {}
        for x in leaves:
            own = found.setdefault(getattr(x, parent) if parent else None, {})
            own[getattr(x, level)] = own.get(getattr(x, level), 0.0) + x.weight
        return found

    out = rows
    for level, parent in (("region", None), ("rack", "region"), ("shard", "rack")):
        choice = None
        for above, children in weights(level, parent).items():
            least = _least(F.col(key), level, children)
            if parent is None:
                choice = least
            else:
                here = F.col(prefix + parent) == F.lit(above)
                choice = F.when(here, least) if choice is None else choice.when(here, least)
        out = out.withColumn(prefix + level, choice.cast("int"))
    return out


def shard_documents(docs: DataFrame, leaves: list[Leaf]) -> DataFrame:
    """doc_id, size, text_crc32, law, region, rack, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = place(place(rows, "doc_id", leaves), "doc_id", grown(leaves), "grown_")
    table = stored(placed.drop("grown_region", "grown_rack").withColumn("law", F.lit("key")), "shards")
    return gapless_rank(table, ["shard"], ["doc_id", "size", "text_crc32"], "slot", table.count())
