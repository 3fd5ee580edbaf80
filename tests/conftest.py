import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from locus.session import get_session

    conf = {"spark.driver.memory": "4g"}
    # tests only: a private checkpoint folder when the session names none
    spark = get_session("local[4]", app="locus-tests", shuffle_partitions=4, conf=conf)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="locus-test-ckpt-"))
    yield spark


@pytest.fixture
def tmp_dir(spark):
    from locus.session import scratch_path

    return scratch_path(spark, "test")
