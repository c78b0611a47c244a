import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from churnmart.session import build_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "churnmart-tests", master="local[4]", shuffle_partitions=4,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="churnmart-tables-"),
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="churnmart-tests-"),
           "spark.sql.maxMetadataStringLength": "10000", "spark.sql.debug.maxToStringFields": "500"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip(f"no tables at {FOLDER}")
    return FOLDER


@pytest.fixture(scope="session")
def bank(spark, folder):
    from churnmart.plans.catalog import bank

    return bank(spark, folder)
