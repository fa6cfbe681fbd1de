import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import builder, prepare

    s = builder("local[4]", app="strata-tests", shuffle_partitions=4).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="strata-test-")


def write_lines(folder: str, name: str, lines: list[str]) -> str:
    """Hand-written landing file: ``folder/object=<name>/part.json``."""
    d = os.path.join(folder, f"object={name}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return folder
