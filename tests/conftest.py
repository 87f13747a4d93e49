from __future__ import annotations

import pytest

from orderloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", shuffle_partitions=4, **{
        "spark.ui.enabled": "false", "spark.log.level": "ERROR", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
