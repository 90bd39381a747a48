import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def month(i, start=2020):
    return date(start + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_ledger(spark):
    """A ledger from {series: [sales or (sales, opex, fx)]}, one row per month from 2020 on."""

    def make(series, start=2020):
        rows = []
        for name, values in series.items():
            for i, v in enumerate(values):
                s, o, f = v if isinstance(v, tuple) else (v, None if v is None else v * 0.25, 30.0)
                rows.append((name, month(i, start), s, o, f))
        return spark.createDataFrame(
            rows, "series_id string, date date, sales_total_try double, opex_try double, usdtry double"
        )

    return make


@pytest.fixture(scope="session")
def make_series(spark):
    def make(series, start=2020):
        rows = [(n, month(i, start), v) for n, vs in series.items() for i, v in enumerate(vs)]
        return spark.createDataFrame(rows, "series_id string, date date, value double")

    return make
