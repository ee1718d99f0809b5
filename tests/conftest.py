import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from rankfold.session import get_session

    scratch = tempfile.mkdtemp(prefix="rankfold-tests-")
    s = get_session("local[*]", app="rankfold-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": f"{scratch}/ckpt", "spark.local.dir": scratch,
                           # test_search counts executions; beyond this number the oldest are forgotten
                           "spark.sql.ui.retainedExecutions": "100000"})
    yield s
    s.stop()
