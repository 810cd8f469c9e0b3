"""The key filter never drops a touched row, drops most others, and does so in the scan stage."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from conftest import SF001
from pyspark.sql import functions as F

from dailytally.config import KEY_COLS
from dailytally.operators import keyfilter as KF
from dailytally.operators import transform as TR
from dailytally.sources.orders import materialized_orders


def test_size_is_bounded():
    assert KF.filter_bits(0) == KF.filter_bits(1) == KF.MIN_BITS
    assert KF.filter_bits(10**12) == KF.MAX_BITS
    for n in (1000, 10**5, 10**6):
        assert KF.BITS_PER_KEY * n <= KF.filter_bits(n) < 2 * KF.BITS_PER_KEY * n + KF.MIN_BITS


def test_no_key_is_lost_and_few_others_pass(spark):
    rows = spark.range(200_000).select((F.col("id") * 7).alias("a"), F.col("id").cast("string").alias("b"))
    keys = rows.where("a % 20 = 0")
    n = keys.count()
    kept = KF.prefilter(rows, keys, n, ["a", "b"])
    assert kept.join(keys, ["a", "b"], "left_semi").count() == n
    assert kept.count() < n + 0.03 * 200_000


def test_full_filter_passes_all_and_empty_none(spark, monkeypatch):
    monkeypatch.setattr(KF, "MAX_BITS", KF.MIN_BITS)
    rows = spark.range(20_000).select("id")
    assert KF.prefilter(rows, rows, 20_000, ["id"]).count() == 20_000
    assert KF.prefilter(rows, rows.where("false"), 0, ["id"]).count() == 0


def test_null_keys_are_compared_like_others(spark):
    rows = spark.createDataFrame([(None, 1), ("x", None), ("x", 1)], "a string, b int")
    assert {tuple(r) for r in KF.prefilter(rows, rows.where("a IS NULL"), 1, ["a", "b"]).collect()} >= {(None, 1)}


def test_wide_recompute_drops_rows_before_its_aggregate(spark):
    orders = materialized_orders(spark, SF001)
    keyed = TR.with_group_key(orders)
    keys = TR.affected_groups(orders.where(F.col("order_id").cast("long") % 50 == 0))
    n = keys.count()
    touched = keyed.join(keys, list(KEY_COLS), "left_semi").count()
    kept = KF.prefilter(keyed, keys, n, KEY_COLS).count()
    assert touched <= kept <= touched + 0.03 * keyed.count() < keyed.count() / 2
    wide = TR.recompute_affected(orders, orders.where(F.col("order_id").cast("long") % 50 == 0), broadcast_key_limit=0)
    narrow = TR.recompute_affected(orders, orders.where(F.col("order_id").cast("long") % 50 == 0))
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, narrow.collect()))
    out = io.StringIO()
    with redirect_stdout(out):
        wide.explain("formatted")
    text = out.getvalue()
    # The filter lies below the partial aggregate, above the scan, in one stage.
    plan = text.split("== Subqueries")[0] if "== Subqueries" in text else text
    plan = plan.split("\n\n")[0]
    agg, scan = plan.index("HashAggregate"), plan.index("Scan parquet")
    assert "Filter" in plan[agg:scan] and "xxhash64" in text and "getbit" in text.lower().replace("bit_get", "getbit")
