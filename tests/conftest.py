import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("RIVULET_DRIVER_MEMORY", "6g")
    from rivulet.session import build_session

    s = build_session("local[*]", app_name="rivulet-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rivulet-tests-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from rivulet.session import scratch_path
    return scratch_path(spark, "t")
