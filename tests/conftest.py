import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from shopgrain import schemas  # noqa: E402
from shopgrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A new folder name that does not exist yet."""
    return str(tmp_path / "work")


@pytest.fixture
def frame(spark):
    """A frame of a raw table from partial rows: missing columns are NULL."""

    def build(table: str, *rows: dict):
        schema = {**schemas.RAW, **schemas.SEEDS}[table]
        unknown = {c for row in rows for c in row} - set(schema.fieldNames())
        assert not unknown, unknown
        return spark.createDataFrame([tuple(row.get(c) for c in schema.fieldNames()) for row in rows], schema)

    return build


@pytest.fixture
def rates(spark):
    from shopgrain.sources.raw import exchange_rates

    return exchange_rates(spark)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    found = [tuple(row) for row in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda row: tuple((v is None, str(v)) for v in row))
