import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corate.session import build_session

    session = build_session(master="local[4]", shuffle_partitions=8, app_name="corate-tests")
    yield session
    session.stop()


@pytest.fixture
def ratings_df(spark):
    def make(rows, user_type="string"):
        schema = f"user_id {user_type}, item_id string, rating double"
        return spark.createDataFrame(rows, schema)

    return make
