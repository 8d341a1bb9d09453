import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from tradepanel.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 8, "tradepanel-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from tradepanel.catalog.adapter import Tables

    return Tables(spark, sf_dir)


@pytest.fixture(scope="session")
def panel(tables):
    return tables.stored_panel()


@pytest.fixture(scope="session")
def exports(tables):
    from tradepanel.sources.tables import stored

    return stored(tables.clean(), "exports")
