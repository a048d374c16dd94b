import pytest

from parcelmart.shared import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", memory="4g")
