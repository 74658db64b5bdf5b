import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from snapflow.session import get_spark
    s = get_spark("local[4]", 4, extra={"spark.sql.adaptive.coalescePartitions.enabled": "true"})
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
