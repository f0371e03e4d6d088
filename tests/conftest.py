import pytest

from quillstone.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("quillstone-tests", cores="4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session
