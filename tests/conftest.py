import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyrisk.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tallyrisk-warehouse-")})
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)
    yield s


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"
