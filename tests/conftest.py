import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from brightlake.session import local_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="brightlake-tests")
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
