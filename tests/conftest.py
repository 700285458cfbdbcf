from __future__ import annotations

import datetime as dtm
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from barline.session import local_session  # noqa: E402

DAY0 = dtm.date(2020, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def day(i: int) -> dtm.date:
    return DAY0 + dtm.timedelta(days=int(i))


@pytest.fixture(scope="session")
def make_bars(spark):
    """Bars from (ticker, day number, open, high, low, close, volume) rows."""

    def build(rows):
        return spark.createDataFrame(
            [
                (t, day(i), *[None if p is None else float(p) for p in (o, h, lo, c, c)], v)
                for t, i, o, h, lo, c, v in rows
            ],
            "ticker string, dt date, open double, high double, low double, close double, "
            "adj_close double, volume bigint",
        )

    return build


@pytest.fixture(scope="session")
def make_fx(spark):
    """Rates from {day number: rate}."""

    def build(rates):
        return spark.createDataFrame(
            [(day(i), None if v is None else float(v)) for i, v in rates.items()],
            "fx_dt date, fx_close double",
        )

    return build
