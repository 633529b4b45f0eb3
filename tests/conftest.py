import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from candlewick.config import build_session
    s = build_session("candlewick-tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.sql.session.timeZone": "UTC", "spark.default.parallelism": "4",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="candlewick-test-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
