"""Aggregations: conditional sums, conditional newest values, ordered arrays, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.text import col
from orderloom.operators.latest import with_distinct_count


def sum_if(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, col(value)))


def max_if(condition: Column, value: Column | str) -> Column:
    return F.max(F.when(condition, col(value)))


def newest_if(value: Column | str, order: Column | str, condition: Column | None = None) -> Column:
    """Value of the row with the highest order among those where the condition holds."""
    if condition is None:
        return F.max_by(col(value), col(order))
    return F.max_by(F.when(condition, col(value)), F.when(condition, col(order)))


def pack_ordered(df: DataFrame, keys: Sequence[str], order: Mapping[str, Column], item: Column,
                 name: str) -> DataFrame:
    """One row per key with one array of its items, in ascending order of the ``order`` values.

    A null item is left out. The array is one value, so the data model must bound it: the
    payments, charges, notes or lines of one order.
    """
    entry = F.struct(*[c.alias(n) for n, c in order.items()], item.alias("_item"))
    rows = df.select(*keys, entry.alias("_entry")).filter(F.col("_entry._item").isNotNull())
    packed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_entry")).alias("_entries"))
    return packed.select(*keys, F.transform("_entries", lambda e: e["_item"]).alias(name))


def distinct_text(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The distinct values of each key as one sorted JSON array text.

    Duplicates go before the values are collected.
    """
    distinct = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    packed = pack_ordered(distinct, keys, {"_v": F.col(value)}, F.col(value), "_values")
    return packed.select(*keys, F.to_json("_values").alias(name))


def pivot_notes(df: DataFrame, keys: Sequence[str], kind: Column, text: Column, name: str) -> DataFrame:
    """Notes per key as a JSON array holding one object: note kind to its highest text."""
    notes = (df.select(*keys, kind.alias("_kind"), text.alias("_text"))
             .filter(F.col("_kind").isNotNull() & F.col("_text").isNotNull())
             .groupBy(*keys, "_kind").agg(F.max("_text").alias("_text")))
    packed = pack_ordered(notes, keys, {"_kind": F.col("_kind")}, F.struct("_kind", "_text"), "_notes")
    return packed.select(*keys, F.to_json(F.array(F.map_from_entries("_notes"))).alias(name))


def union_arrays(df: DataFrame, keys: Sequence[str], array: str, name: str) -> DataFrame:
    """Multiset union of the arrays of each key: every value as often as in the array
    that holds it most often. Sorted by value.

    Every array is taken apart once; the counts of a row's values are added up before
    the shuffle, where all of them still are in one task.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    values = numbered.select(*keys, "_row", F.explode(array).alias("_v"))
    counted = values.groupBy(*keys, "_row", "_v").agg(F.count(F.lit(1)).alias("_n"))
    most = counted.groupBy(*keys, "_v").agg(F.max("_n").alias("_n"))
    packed = pack_ordered(most, keys, {"_v": F.col("_v")}, F.struct("_v", "_n"), "_runs")
    return packed.select(*keys, F.flatten(F.transform("_runs", lambda e: F.array_repeat(e["_v"], e["_n"].cast("int")))).alias(name))


def single_transaction_amount(df: DataFrame, keys: Sequence[str], transaction: Column, line_total: str,
                              amount: str, bounded: bool = False) -> DataFrame:
    """Amount per payment row: where a key has one distinct transaction the invoice
    line total stands for it, else each row keeps its own amount.

    Where the data model bounds the rows of a key, ``bounded`` counts in a window, which needs
    no exchange on rows that are dealt out by some of the keys.
    """
    if bounded:
        found = F.collect_set(transaction).over(Window.partitionBy(*keys))
        counted = df.withColumn("transaction_count", F.size(found).cast("bigint"))
    else:
        counted = with_distinct_count(df, keys, transaction, "transaction_count")
    own = F.coalesce(F.col(amount), F.lit(0))
    chosen = F.when(F.col("transaction_count") == 1, F.coalesce(F.col(line_total), own)).otherwise(own)
    return counted.withColumn(amount, chosen)
