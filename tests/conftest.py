import pytest

from gondola.session import local_session, scratch


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(cores=8, partitions=4, folder=str(tmp_path_factory.mktemp("checkpoint")))


@pytest.fixture(autouse=True)
def own_scratch(request):
    """Intermediate tables go when a test ends."""
    if "spark" not in request.fixturenames:
        yield
        return
    with scratch(request.getfixturevalue("spark")):
        yield
