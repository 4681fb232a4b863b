import os

import pytest

os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hakari.session import build

    s = build("local[4]", 4, spark__driver__memory="3g", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    """The smallest folder of given tables; tests that need it are skipped where it is not there."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    return folder
