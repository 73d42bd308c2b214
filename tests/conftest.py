import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomstar.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # a private warehouse for the table-sink tests; the checkpoint folder comes
    # from the configuration, or get_session creates one when it is unset
    extra = {"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="loomstar-wh-")}
    s = get_session("local[4]", app="loomstar-tests", shuffle_partitions=8, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="loomstar-test-")
