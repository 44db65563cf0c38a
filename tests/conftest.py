import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vqaspark.session import get_spark
    scratch = tempfile.mkdtemp(prefix="vqaspark-tests-")
    s = get_spark("local[4]", app="vqaspark-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                         "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="vqaspark-t-")
