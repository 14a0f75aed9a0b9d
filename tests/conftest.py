import pytest

from gridmarts.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as a sorted list of tuples, NULLs last."""

    def collect(df, *columns):
        found = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in found), key=lambda r: [(v is None, str(v)) for v in r])

    return collect
