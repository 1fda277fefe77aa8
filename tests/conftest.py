import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = os.environ.get("TRIPMART_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import ensure_checkpoint_dir, get_spark

    s = get_spark("local[*]", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tripmart-test-", dir=os.environ.get("TMPDIR", "/tmp"))
