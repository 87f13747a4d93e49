"""Join helpers: null-safe keys, size-checked broadcast, semi and anti joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 52_428_800


def same_key(left: DataFrame, right: DataFrame, keys: Mapping[str, str] | Sequence[str]) -> Column:
    """Null-safe equality on all keys; stays an equi-join for the planner."""
    pairs = keys.items() if isinstance(keys, Mapping) else [(k, k) for k in keys]
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; an upper bound for filters and projections of files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(df: DataFrame, table: DataFrame, on: Sequence[str] | Column, how: str = "left",
                limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Join a lookup table. It is broadcast only while its estimated size stays under
    ``limit``; beyond that the planner is free to shuffle both sides."""
    small = estimated_bytes(table) <= limit
    return df.join(F.broadcast(table) if small else table, on, how)


def keep_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """EXISTS on equal keys."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def drop_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NOT EXISTS on equal keys."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def drop_matching_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NOT EXISTS where null keys count as equal."""
    right = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return df.join(right, same_key(df, right, {k: f"_k_{k}" for k in keys}), "left_anti")


def keep_matching_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """EXISTS where null keys count as equal."""
    right = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return df.join(right, same_key(df, right, {k: f"_k_{k}" for k in keys}), "left_semi")


def prefixed(df: DataFrame, prefix: str, keys: Sequence[str] = (), only: Sequence[str] | None = None) -> DataFrame:
    """Rename all columns but the keys, so that a join cannot clash."""
    names = [c for c in df.columns if only is None or c in only or c in keys]
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(prefix + c) for c in names])
