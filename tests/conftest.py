import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vidlens import get_spark
    ckpt = tempfile.mkdtemp(prefix="vidlens-test-ckpt-")
    s = get_spark("local[*]", shuffle_partitions=8,
                  conf={"spark.checkpoint.dir": ckpt, "spark.sql.adaptive.enabled": "true"})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="vidlens-t-")
