import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session

    # local mode: when spark.checkpoint.dir is unset, get_session gives the
    # session a fresh temporary scratch folder
    warehouse = tempfile.mkdtemp(prefix="tessera-test-warehouse-", dir="/tmp")
    session = get_session("local[4]", app_name="tessera-tests", shuffle_partitions=8,
                          extra={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="tessera-test-out-", dir="/tmp")
