import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from lumisift.session import get_session

    return get_session("tests", cores=8, shuffle_partitions=4)


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest tables."""
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)


@pytest.fixture(scope="session")
def middle():
    folder = TESTDATA / "sf0.1"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)
