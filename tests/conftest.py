import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
SF_BENCH = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from tests.session import local_session

    warehouse = tempfile.mkdtemp(prefix="sparecast-wh-")
    s = local_session("*", shuffle_partitions=8, app="sparecast-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
