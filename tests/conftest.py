from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.oracle import duck, session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def duckdb_con():
    return duck(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
