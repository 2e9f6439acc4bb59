import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskspark.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "riskspark-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


RAW_DDL = ("step long, type string, amount double, nameOrig string, oldbalanceOrg double, "
           "newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double, "
           "isFraud int, isFlaggedFraud int")
RAW_ROWS = [
    (1, "PAYMENT", 100.0, "C123", 1000.0, 900.0, "M789", 0.0, 100.0, 0, 0),
    (2, "TRANSFER", 500.0, "C456", 500.0, 0.0, "C999", 100.0, 600.0, 1, 0),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW_ROWS, RAW_DDL)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
