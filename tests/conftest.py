import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sluice.session import local_session

    s = local_session("*", 8, extra={"spark.driver.memory": "4g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-test-ckpt-"))
    yield s


@pytest.fixture()
def layout(spark):
    from sluice.session import new_scratch_dir
    from sluice.sources.tables import Layout

    return Layout(new_scratch_dir(spark, "test"))
