import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from courtside.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="courtside-test-ckpt-")
    s = get_spark("local[4]", app="courtside-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": tempfile.mkdtemp()})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL
