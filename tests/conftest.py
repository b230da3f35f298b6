from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from loadgrain.session import local_session

    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)


@pytest.fixture(scope="session")
def con(sf_dir):
    from compare import duck

    return duck(sf_dir)
