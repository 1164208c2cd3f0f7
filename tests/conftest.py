import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame("a int, b string", (1, "x"), …)"""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
