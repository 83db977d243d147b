import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from spikeloom.session import get_session
    wh = tempfile.mkdtemp(prefix="spikeloom-wh-", dir="/tmp")
    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra_conf={"spark.sql.warehouse.dir": wh})
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
