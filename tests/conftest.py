import pytest

from tests.compare import session


@pytest.fixture(scope="session")
def spark():
    s = session()
    yield s
    s.stop()
