import datetime as dt

from conftest import order

from dailytally.config import EPOCH
from dailytally.operators import extract as X
from dailytally.operators.ledger import extract_page_bounded, page_bounds
from dailytally.operators.load import apply_changes

D = dt.datetime


def test_mark_filter_is_strict(orders_df):
    df = orders_df(
        [
            order("rest_001", updated_at=D(2024, 1, 10), created_at=D(2024, 1, 10)),
            order("rest_002", updated_at=D(2024, 1, 15), created_at=D(2024, 1, 15)),
            order("rest_003", updated_at=D(2024, 1, 20), created_at=D(2024, 1, 20)),
        ]
    )
    got = sorted(r.restaurant_id for r in X.extract_incremental(df, D(2024, 1, 12)).collect())
    assert got == ["rest_002", "rest_003"]
    # a row stamped exactly at the mark is not taken again
    assert X.extract_incremental(df, D(2024, 1, 15)).count() == 1


def test_batch_limit(orders_df):
    df = orders_df([order(created_at=D(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(10)])
    page = X.extract_page(df, EPOCH, 3).collect()
    assert len(page) == 3
    assert [r.updated_at for r in page] == sorted(r.updated_at for r in page)
    assert page[0].updated_at == D(2024, 1, 1)


def test_nothing_new(orders_df):
    df = orders_df([order(created_at=D(2024, 1, 15))])
    changed = X.extract_incremental(df, D(2024, 2, 1))
    assert changed.count() == 0
    stats = X.batch_stats(changed).first()
    assert stats.max_updated_at is None and stats.row_count == 0


def test_max_tracking(orders_df):
    df = orders_df(
        [
            order(created_at=D(2024, 1, 15, 10), updated_at=D(2024, 1, 15, 10)),
            order(created_at=D(2024, 1, 14), updated_at=D(2024, 1, 20, 8)),
        ]
    )
    stats = X.batch_stats(X.extract_incremental(df, EPOCH)).first()
    assert stats.max_updated_at == D(2024, 1, 20, 8) and stats.row_count == 2


def test_reextract_after_update(orders_df):
    o = order("rest_001", "placed", created_at=D(2024, 1, 15))
    df = orders_df([o])
    mark = X.batch_stats(X.extract_incremental(df, EPOCH)).first().max_updated_at
    changed = orders_df([o[:3] + ("completed",) + o[4:7] + (D(2024, 1, 20),)])
    current = apply_changes(df, changed)
    rows = X.extract_incremental(current, mark).collect()
    assert len(rows) == 1 and rows[0].status == "completed"


def test_backfill_range(orders_df):
    df = orders_df(
        [
            order("rest_001", created_at=D(2024, 1, 10)),
            order("rest_002", created_at=D(2024, 1, 15)),
            order("rest_003", created_at=D(2024, 1, 25)),
        ]
    )
    got = [r.restaurant_id for r in X.extract_backfill(df, dt.date(2024, 1, 12), dt.date(2024, 1, 20)).collect()]
    assert got == ["rest_002"]


def test_backfill_inclusive_ends(orders_df):
    df = orders_df(
        [
            order(created_at=D(2024, 1, 15, 0, 0, 1)),
            order(created_at=D(2024, 1, 15, 23, 59, 59)),
            order(created_at=D(2024, 1, 16, 0, 0, 0)),
            order(created_at=D(2024, 1, 14, 23, 59, 59, 999999)),
        ]
    )
    assert X.extract_backfill(df, dt.date(2024, 1, 15), dt.date(2024, 1, 15)).count() == 2


def test_plain_page_loses_ties_tie_safe_page_does_not(orders_df):
    t = D(2024, 1, 15, 12)
    df = orders_df([order(order_id=f"o{i}", created_at=D(2024, 1, 15), updated_at=t) for i in range(3)])
    page = X.extract_page(df, EPOCH, 2)
    mark = X.batch_stats(page).first().max_updated_at
    # the reference's next page (> mark) finds nothing: one row is skipped
    assert X.extract_incremental(df, mark).count() == 0
    assert X.extract_page_tie_safe(df, EPOCH, 2).count() == 3


def test_lookback_widens_window(orders_df):
    df = orders_df([order(created_at=D(2024, 1, 15), updated_at=D(2024, 1, 15))])
    assert X.changed_since(df, D(2024, 1, 15, 1)).count() == 0
    assert X.changed_since(df, D(2024, 1, 15, 1), lookback=dt.timedelta(hours=2)).count() == 1


def test_bounded_page_equals_tie_safe_page(orders_df):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(400):
        c = D(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 20000))
        u = D(2024, 2, 1, 12) if i % 5 == 0 else c + dt.timedelta(microseconds=rnd.randrange(0, 10**9))
        rows.append(order(order_id=f"{i:04d}", created_at=c, updated_at=u))
    df = orders_df(rows)
    for n in (1, 7, 50, 150, 399, 400, 1000):
        a = extract_page_bounded(df, EPOCH, n)
        b = X.extract_page_tie_safe(df, EPOCH, n)
        assert a.count() == b.count() >= min(n, 400)
        assert a.exceptAll(b).count() == 0


def test_page_bounds_of_one_pass(orders_df):
    t = D(2024, 1, 15)
    rows = [order(order_id=f"{i}", created_at=t, updated_at=t + dt.timedelta(hours=i // 4)) for i in range(10)]
    assert page_bounds(orders_df(rows), 3) == [t, t + dt.timedelta(hours=1), t + dt.timedelta(hours=2)]
    assert page_bounds(orders_df(rows).where("false"), 3) == []


def test_ordered_extract_is_oldest_first(orders_df):
    t = D(2024, 1, 15)
    rows = [order(order_id=f"{i:02d}", created_at=t, updated_at=t + dt.timedelta(minutes=(i * 7) % 20)) for i in range(40)]
    got = [(r.updated_at, r.order_id) for r in X.extract_incremental(orders_df(rows), EPOCH, ordered=True).collect()]
    assert got == sorted(got) and len(got) == 40
    got = [(r.created_at, r.order_id) for r in X.extract_backfill(orders_df(rows), t.date(), t.date(), ordered=True).collect()]
    assert got == sorted(got) and len(got) == 40


def test_ntz_micros(spark):
    from dailytally.functions.columns import ntz_micros

    ts = dt.datetime(2024, 3, 10, 2, 30, 5, 123456)  # inside a DST gap in many zones
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    expect = int((ts - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    assert df.select(ntz_micros("t").alias("m")).first().m == expect
