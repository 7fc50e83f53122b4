import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from maskweave.session import get_spark

    s = get_spark("local[4]", 8)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def make(sf):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
        return con

    return make
