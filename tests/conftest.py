import os

import pytest

from acctcube.session import build_session

SF = os.environ.get("ACCTCUBE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": os.environ.get("ACCTCUBE_MASTER", "local[8]"),
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def frame(spark):
    """Small table from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def plan():
    def text(df):
        return df._jdf.queryExecution().toString()

    return text
