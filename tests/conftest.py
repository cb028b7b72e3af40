import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from forgeline.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, app="forgeline-tests")
    yield s
    s.stop()


@pytest.fixture()
def store(spark, tmp_path):
    from forgeline.sources.store import TableStore

    return TableStore(spark, str(tmp_path / "store"))


def write_files(folder, files: dict):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(text)
    return str(folder)
