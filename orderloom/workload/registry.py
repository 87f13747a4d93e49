"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import run_dir
from orderloom.workload.standins import Inputs, check_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None, uses: Sequence[str] = (), name: str | None = None):
    """Register a function of the inputs as a query; ``check`` is its DuckDB SQL."""
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if check is not None:
            CHECKS[key] = check_sql(check, *uses)
        return build
    return register


def as_doubles(df: DataFrame) -> DataFrame:
    """Exact decimals leave as doubles, which both engines print alike."""
    decimals = [c for c, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def new_folder(t: Inputs, name: str) -> str:
    """A folder of its own for one run, in the shared directory."""
    return f"{run_dir(t.spark)}/workload/{name}-{uuid.uuid4().hex}"
