import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from segmint.session import local_session

    # catalog tables made by tests live in a temporary warehouse, not in the repository
    return local_session(4, shuffle_partitions=4, conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="segmint-wh-")})
