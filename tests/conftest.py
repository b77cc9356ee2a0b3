import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ragloom.session import build_session, set_checkpoint_dir_if_unset

    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    set_checkpoint_dir_if_unset(s, str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from ragloom.sources.tables import TABLES, table_path

    def connect(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            p = table_path(sf_dir, t)
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        return con
    return connect
