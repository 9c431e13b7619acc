import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kassa.session import get_session
    scratch = tempfile.mkdtemp(prefix="kassa-tests-")
    s = get_session("local[4]", app="kassa-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "6g",
                           "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="kassa-t-")
