import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kilnwatt.schemas import RAW_DDL  # noqa: E402
from kilnwatt.session import build_session, drop_materialised  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "kilnwatt-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_materialised(session)
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def raw(spark):
    """Raw readings from (time text, usage) pairs or dicts of raw columns."""

    def build(*rows):
        full = [row if isinstance(row, dict) else {"time": row[0], "usage_kwh": row[1]} for row in rows]
        names = [field.split()[0] for field in RAW_DDL.split(",")]
        text = RAW_DDL.replace("time timestamp", "time string", 1)
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], text)
        return df.withColumn("time", df.time.cast("timestamp"))

    return build


def column(df, name, order=None):
    rows = (df.orderBy(order) if order else df).select(name).collect()
    return [r[0] for r in rows]
