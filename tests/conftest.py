from __future__ import annotations

import datetime as dt

import pytest
from matchmill.session import build_session, clear_scratch
from matchmill.sources.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"
NOW = dt.datetime(2026, 1, 2, 3, 4, 5)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"), f"t_{tmp_path.name.replace('-', '_')}_", buckets=4)


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(df, *order):
    """The rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
