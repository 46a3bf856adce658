import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagweave.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))  # catalog tables never land in the repo
    session = get_session("local[4]", app_name="tagweave-tests", shuffle_partitions=8,
                          extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
