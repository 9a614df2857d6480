import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpusloom.session import build_session, ship_package  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture(scope="session")
def rows():
    """Rows of a test table as dicts."""
    import pyarrow.dataset as ds

    return lambda name, columns=None: ds.dataset(f"{SF}/{name}.parquet").to_table(columns=columns).to_pylist()
