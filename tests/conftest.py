import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from trendstrata.session import local_session

    session = local_session(8, app="tests", memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA / f"sf{os.environ.get('ORACLE_SF', '0.001')}")


@pytest.fixture
def rows():
    """Collected rows as plain tuples, NULL-safe sorted."""

    def collected(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collected
