import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from helpers import SF_SMALL  # noqa: E402

from larder.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="larder-tests", **{"spark.sql.shuffle.partitions": "8"})
    if not s.conf.get("spark.checkpoint.dir", None):  # only where the platform left it unset
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="larder-tests-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lineage(spark):
    from larder.plans.lineage import Lineage
    return Lineage(spark, SF_SMALL)
