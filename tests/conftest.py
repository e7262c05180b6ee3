import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from grantflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, ordered by the given columns or by their text."""
    found = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(found, key=lambda r: tuple(r[i] for i in at))
    return sorted(found, key=repr)
