import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from longhouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # only where the cluster names no folder of its own
    shared = tmp_path_factory.mktemp("shared")
    conf = {"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"}
    session = build_session("tests", "4", **conf)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(shared))
    return session


def rows(df, *columns):
    """Rows as a sorted list of tuples; nulls sort first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
