import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from duetto.session import local_session
    s = local_session("*", 8, app="duetto-tests")
    yield s
    s.stop()
