import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from voltcube.session import get_spark, shared_dir
    s = get_spark("local[4]", shuffle_partitions=8)
    shared_dir(s)   # sets a checkpoint folder only where the session has none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from voltcube.sources.tables import TABLES

    def open_dir(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return open_dir
