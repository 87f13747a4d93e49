"""Batch sources and sinks: scans, increments, variant columns, partitioned appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.schemas import RecordedSink, fitted


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table by name, or parquet files by path."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df.select(*columns) if columns else df


def read_increment(df: DataFrame, ts_col: str, low_water: datetime, lookback: timedelta = timedelta(0),
                   inclusive: bool = True) -> DataFrame:
    """Rows loaded since the last run, less a lookback for late ones.

    The bound is a literal, so it reaches the file scan. It is inclusive by default:
    rows that share the watermark's timestamp are read again and upserted once more.
    """
    bound = F.lit(low_water - lookback).cast(df.schema[ts_col].dataType)
    stamp = F.col(ts_col)
    return df.filter(stamp >= bound if inclusive else stamp > bound)


def union_sources(*feeds: tuple[DataFrame, str, datetime, timedelta]) -> DataFrame:
    """Union of feeds, each cut to its own lookback: (rows, load column, low water, lookback)."""
    parts = [read_increment(df, ts_col, low, lookback) for df, ts_col, low, lookback in feeds]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def project_variant(df: DataFrame, column: str, spec: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Flatten a JSON column to typed columns; a value that does not fit its type is null.

    The text is parsed once for all columns. ``variant`` keeps a field as JSON text.
    """
    schema = ", ".join(f"`{name}` string" for name in spec)
    parsed = df.select(*keep, F.from_json(column, schema).alias("_v"))
    fields = [F.col(f"_v.`{name}`").alias(name) if kind in ("string", "variant")
              else F.col(f"_v.`{name}`").try_cast(kind).alias(name) for name, kind in spec.items()]
    return parsed.select(*keep, *fields)


def align_columns(df: DataFrame, standard: Sequence[str]) -> DataFrame:
    """Exactly the standard columns, in order; missing ones are null."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in standard])


def rename_and_cast(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Target name to (source name, type)."""
    return df.select(*[F.col(source).cast(kind).alias(name) for name, (source, kind) in spec.items()])


def append_partitioned(df: DataFrame, path: str, by: Mapping[str, Column] | Sequence[str],
                       evolve: bool = False) -> None:
    """Append history files below one folder per partition value. With ``evolve`` the sink's columns are recorded: new
    ones may come, and a type that does not fit fails before anything is written. Read such a sink by `read_evolved`."""
    names = list(by)
    if isinstance(by, Mapping):
        df = df.withColumns(dict(by))
    if evolve:
        df = fitted(df, RecordedSink(df.sparkSession, path).admit(df.schema))
    _clustered(df, names).write.mode("append").partitionBy(*names).parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a sink with recorded columns, those that came later null in older rows."""
    return RecordedSink(spark, path).read()


def _clustered(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of a partition side by side, so that each gets few files. A rebalance splits
    large partition values over several tasks, which a plain repartition would not."""
    return df.hint("rebalance", *names)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write partitions whole; the ones not named in ``df`` stay. Safe to run again."""
    (_clustered(df, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder of files is there."""
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def drop_partition(spark: SparkSession, path: str, column: str, value: object) -> None:
    """Remove one partition's folder; nothing happens where it is gone already."""
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(
        column, None if value is None else str(value))
    fs, target = _hadoop(spark, f"{path.rstrip('/')}/{named}")
    fs.delete(target, True)
