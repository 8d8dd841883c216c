from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from vendaflow.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", "4", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog"))}
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def house(spark, tmp_path_factory):
    """The sf0.001 tables loaded as a warehouse."""
    from vendaflow.plans.warehouse import Warehouse
    from vendaflow.sources.tables import flat_sales

    built = Warehouse(spark, str(tmp_path_factory.mktemp("house")))
    built.load(flat_sales(spark, SF))
    return built
