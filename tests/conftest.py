import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="seasonflow-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    from seasonflow.session import local_session

    derby_home = os.path.join(scratch, "derby")
    os.makedirs(derby_home, exist_ok=True)
    s = local_session(cores="*", shuffle_partitions=8, app="seasonflow-tests", extra={
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        "spark.driver.extraJavaOptions":
            f"-Dderby.system.home={derby_home} -Dderby.stream.error.file={derby_home}/derby.log",
    })
    yield s
    s.stop()
