import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from palimpsest.policy import Policy  # noqa: E402
from palimpsest.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def policy():
    return Policy("canuser", "/home/canuser", private_terms=("canuserlab",), private_domains=("corp.test",))


@pytest.fixture(scope="session")
def sf():
    return SF
