"""A Bloom filter of group keys, probed in the scan stage.

The wide recompute aggregates before it meets the keys, so without a filter it would
aggregate every group of the days in range. The filter drops nearly all rows of
untouched groups ahead of that aggregate; the exact join behind it drops the rest.

Built by one aggregate: each key sets ``HASHES`` bits, bits are merged by words of 64,
and the words become one array. Its size follows the number of keys, ``BITS_PER_KEY`` each,
up to ``MAX_BITS`` (4 MB): beyond that it only lets more rows pass. It reaches the
rows as a scalar subquery, so its size is bounded whatever the keys are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
BITS_PER_KEY = 12
MIN_BITS, MAX_BITS = 1 << 12, 1 << 25


def filter_bits(n_keys: int) -> int:
    """Bits of a filter of ``n_keys`` keys: a power of two within the bounds."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (max(1, n_keys * BITS_PER_KEY) - 1).bit_length()))


def _positions(cols: Sequence[str], bits: int) -> list[Column]:
    """The bits of a key, by double hashing (``bits`` is a power of two)."""
    h = F.xxhash64(*cols)
    first, step = h.bitwiseAND(F.lit(bits - 1)), F.shiftright(h, 32).bitwiseAND(F.lit(bits - 1)).bitwiseOR(F.lit(1))
    return [(first + step * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def key_words(keys: DataFrame, cols: Sequence[str], bits: int) -> DataFrame:
    """The filter: one row, ``words``, an array of ``bits / 64`` longs."""
    n = bits // 64
    # Equal bits are set once: as many rows as bits at most are merged into words.
    at = keys.select(F.explode(F.array(*_positions(cols, bits))).alias("_bit"))
    word = F.shiftright("_bit", 6).alias("_word")
    one = F.expr("shiftleft(1L, cast(_bit & 63 as int))").alias("_bits")
    none = keys.sparkSession.range(n).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    words = at.select(word, one).unionByName(none).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return words.agg(F.array_sort(F.collect_list(F.struct("_word", "_bits"))).alias("_all")).select(F.col("_all._bits").alias("words"))


def may_hold(words: DataFrame, cols: Sequence[str], bits: int) -> Column:
    """Whether a row's key may be in the filter; false only where it isn't."""
    held = words.scalar()
    hit = None
    for pos in _positions(cols, bits):
        word = F.get(held, F.shiftright(pos, 6).cast("int"))
        bit = F.getbit(word, pos.bitwiseAND(F.lit(63)).cast("int")) == 1
        hit = bit if hit is None else hit & bit
    return hit


def prefilter(rows: DataFrame, keys: DataFrame, n_keys: int, cols: Sequence[str]) -> DataFrame:
    """Rows whose key may be among the ``n_keys`` keys: all that are, and few others."""
    bits = filter_bits(n_keys)
    return rows.where(may_hold(key_words(keys, cols, bits), cols, bits))
