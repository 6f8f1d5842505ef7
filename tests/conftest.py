from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from basketlens.params import Params  # noqa: E402
from basketlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def p():
    return Params(as_of=dt.date(2024, 6, 15))


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def money(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.01"))


def rows(df, *columns):
    """Rows as tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


ORDERS = "order_id BIGINT, customer_id BIGINT, order_date TIMESTAMP, total_price DECIMAL(18,2), status STRING"
ITEMS = "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, price DECIMAL(18,2)"
