import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallywatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark_master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="6g",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Rows as dicts, ordered."""
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[c]) for c in order)) if order else out


def column(df, name, by="txn_id"):
    """Values of a column in the order of ``by``."""
    return [r[name] for r in df.select(by, name).orderBy(by).collect()]
