"""Newest or first row per key, and values spread from groups back to rows.

A ``row_number() = 1`` filter is planned with a group limit on both sides of the
shuffle, so a key that holds most of the rows sends one row per map task. Where all
rows are kept, the group value is aggregated first and joined back: a window would
hold the whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.text import col
from orderloom.operators.joins import same_key

_RANK = "_rank"


def newest(*columns: Column | str) -> list[Column]:
    """Newest first, missing values last."""
    return [col(c).desc_nulls_last() for c in columns]


def oldest(*columns: Column | str) -> list[Column]:
    """Oldest first, missing values last."""
    return [col(c).asc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``. End the order in a unique column."""
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def one_row_per_status(df: DataFrame, keys: Sequence[str], status: Column | str,
                       order: Sequence[Column]) -> DataFrame:
    """One row per key and status reached."""
    return latest_per_key(df, [*keys, col(status)], order)


def first_values(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                 columns: Sequence[str], prefix: str = "first_") -> DataFrame:
    """One row per key: the columns as they stood in the first row of ``order``."""
    first = latest_per_key(df, keys, order)
    return first.select(*keys, *[F.col(c).alias(prefix + c) for c in columns])


def with_first_values(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                      columns: Sequence[str], prefix: str = "first_") -> DataFrame:
    """Every row, with the first values of its key alongside."""
    return spread(df, first_values(df, keys, order, columns, prefix), keys)


def spread(df: DataFrame, per_key: DataFrame, keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Join one row per key back to all rows of the key; null keys match null keys.

    Where no key can be null, ``null_keys=False`` gives a plain equi-join, which shares
    the partitioning of the aggregation and of neighbouring joins on the same keys.
    """
    if not null_keys:
        return df.join(per_key, list(keys), "left")
    right = per_key.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[c for c in per_key.columns if c not in keys])
    joined = df.join(right, same_key(df, right, {k: f"_k_{k}" for k in keys}), "left")
    return joined.drop(*[f"_k_{k}" for k in keys])


def with_range(df: DataFrame, keys: Sequence[str], columns: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Every row, with the lowest and highest value of its key for each column."""
    bounds = df.groupBy(*keys).agg(*[F.min(c).alias(f"min_{c}") for c in columns],
                                   *[F.max(c).alias(f"max_{c}") for c in columns])
    return spread(df, bounds, keys, null_keys)


def with_distinct_count(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Every row, with the number of distinct values its key has."""
    return spread(df, df.groupBy(*keys).agg(F.countDistinct(value).alias(name)), keys)
