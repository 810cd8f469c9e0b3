"""Properties I1-I3 over random change sequences (hypothesis).

I1 incremental = full: after every run the table equals a full GROUP BY of
   the current source;
I2 idempotent: running again changes nothing;
I3 crash-safe: a failure between the write and the state save is repaired
   by the next run.
"""

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dailytally.operators.transform import daily_metrics_full
from dailytally.plans.jobs import JobConfig, MetricsJob
from dailytally.schemas import ORDERS

BASE = dt.datetime(2024, 1, 1)

change = st.tuples(
    st.integers(0, 11),  # order number
    st.sampled_from(["placed", "completed", "cancelled"]),
    st.integers(0, 4),  # created day offset (used only when the order is new)
    st.sampled_from(["rest_1", "rest_2"]),
    st.sampled_from(["IN", "US"]),
    st.integers(1, 9999),  # amount in cents
)
batches = st.lists(st.lists(change, min_size=1, max_size=6), min_size=1, max_size=3)
crashes = st.lists(st.booleans(), min_size=3, max_size=3)

_counter = itertools.count()


def _apply(source: dict, batch, clock: dt.datetime) -> dt.datetime:
    for i, (num, status, day, rest, country, cents) in enumerate(batch):
        clock = clock + dt.timedelta(minutes=1 + i)
        oid = f"o{num}"
        if oid in source:
            old = source[oid]
            source[oid] = old[:3] + (status,) + old[4:7] + (clock,)
        else:
            created = BASE + dt.timedelta(days=day, hours=num)
            source[oid] = (oid, rest, "u", status, Decimal(cents) / 100, country, created, max(created, clock))
    return clock


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seq=batches, crash=crashes)
def test_incremental_equals_full_idempotent_crash_safe(spark, workdir, seq, crash):
    root = f"{workdir}/{next(_counter)}"
    cfg = JobConfig(metrics_path=f"{root}/m", state_path=f"{root}/s")
    source: dict = {}
    clock = BASE + dt.timedelta(days=10)
    for batch, fail in zip(seq, crash):
        clock = _apply(source, batch, clock)
        df = spark.createDataFrame(list(source.values()), ORDERS)
        job = MetricsJob(spark, df, cfg)
        if fail:
            def boom():
                raise RuntimeError("lost")

            job.after_write = boom
            with pytest.raises(RuntimeError):
                job.run_incremental()
            job.after_write = None
        job.run_incremental()
        exp = daily_metrics_full(df)
        got = job.read_metrics()
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0  # I1 (and I3)
        again = job.run_incremental()
        assert again["total_rows"] == 0  # I2: nothing left to do
        assert job.read_metrics().exceptAll(exp).count() == 0
