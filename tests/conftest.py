import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from batchlens.session import local_session

    s = local_session(cores=8, shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_store(spark, tmp_path):
    from batchlens.sources.store import Store

    return Store(spark, str(tmp_path / "store"))
