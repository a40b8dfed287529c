import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from voltaic.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="voltaic-tests", settings={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="voltaic-wh-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="voltaic-ckpt-")})
    yield s
    s.stop()


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path
