import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="pricelens-wh-")
    s = build_session("local[4]", shuffle_partitions=8, app="pricelens-tests", extra={
        "spark.sql.warehouse.dir": warehouse,
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="pricelens-test-")
