import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from warband.session import checkpoint_dir, get_spark
    scratch = tempfile.mkdtemp(prefix="warband-test-")
    s = get_spark("local[8]", 8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
    })
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="warband-case-")
