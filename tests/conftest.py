from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
import uuid
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dailytally.schemas import ORDERS  # noqa: E402
from dailytally.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="dailytally-tests")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="dailytally-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def order(
    restaurant_id="rest_001",
    status="placed",
    amount="500.00",
    country="IN",
    created_at=dt.datetime(2024, 1, 15, 10, 30),
    updated_at=None,
    order_id=None,
    user_id=None,
):
    """Row helper with the reference test defaults."""
    return (
        order_id or str(uuid.uuid4()),
        restaurant_id,
        user_id or str(uuid.uuid4()),
        status,
        Decimal(amount),
        country,
        created_at,
        updated_at or created_at,
    )


@pytest.fixture()
def orders_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, ORDERS)

    return make
