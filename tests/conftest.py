import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from firstbasket.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, driver_memory="4g", app="firstbasket-tests",
                      extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="fb-test-ckpt-"),
                                  "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="fb-test-wh-")})
    yield s
    s.stop()


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)
