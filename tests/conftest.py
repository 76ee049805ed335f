import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ravelin.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", 8, **{"spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
