import pytest

from tidemark.session import ROWS_PER_CHUNK, local_session

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        4,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def chunked(spark):
    """Set how small chunks must be, and put it back afterwards."""

    def set_sizes(rows_per_chunk: int) -> None:
        spark.conf.set(ROWS_PER_CHUNK[0], rows_per_chunk)

    yield set_sizes
    spark.conf.unset(ROWS_PER_CHUNK[0])


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
