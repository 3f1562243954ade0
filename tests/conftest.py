from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("QUERN_DRIVER_MEMORY", "3g")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from quern.session import local_session

    s = local_session(4, 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import glob

    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c
