import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a small DataFrame from tuples and a DDL schema."""

    def build(data, schema):
        return spark.createDataFrame(list(data), schema)

    return build


@pytest.fixture
def values():
    """The rows of a DataFrame as sorted plain tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
