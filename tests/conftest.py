import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillsight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tillsight-tests", master="local[4]", shuffle_partitions=4,
                      **{"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    return s


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def by(df, key="customer_id"):
    return {r[key]: r for r in rows(df)}
