import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablesmith.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tablesmith-test-")
    s = build_session("local[4]", "tablesmith-tests", {
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    })
    yield s


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="tablesmith-case-")
