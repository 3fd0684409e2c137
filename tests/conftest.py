import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import local_session

    session = local_session(
        app="tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """DataFrame from a DDL schema and rows."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture(scope="session")
def tables(spark):
    from ledgerloom.plans.fixtures import Tables

    return Tables(spark, SMALL)


def got(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def one(df):
    return df.first().asDict()
