import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidemark-tests-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="tidemark-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.local.dir": os.path.join(scratch, "local")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidemark-t-")


@pytest.fixture()
def sliced_scans(spark):
    """Run a test with its ordered scans cut into many small slices."""
    spark.conf.set("tidemark.scan.sliceRows", "500")
    yield
    spark.conf.unset("tidemark.scan.sliceRows")
