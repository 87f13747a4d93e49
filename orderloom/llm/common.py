"""Staged tables and joins that stay whole and even under hot groups."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import run_dir

# A group counts as hot from this share of all rows on; so there are at most HOT_SHARE hot groups.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other run uses, in the folder all executors share."""
    return f"{run_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: lineage ends here and survives lost executors."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, row_id: str) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has one row per ``key`` (a string) and a row count ``size``.

    Groups with at least 1/HOT_SHARE of all rows, of which there are at most HOT_SHARE, travel as a broadcast; the
    others meet in a shuffle. Rows of hot groups pass that shuffle spread out by ``row_id``. ``groups`` is read
    three times and should be staged. Rows without a group get nulls.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    columns = [c for c in groups.columns if c != key]
    is_hot = F.col(size) * HOT_SHARE >= F.lit(total)
    hot = groups.filter(is_hot).select(F.col(key), *[F.col(c).alias(f"_hot_{c}") for c in columns])
    cold = groups.filter(~is_hot).select(F.col(key).alias("_key"), *columns)
    spread = F.when(F.col(f"_hot_{size}").isNull(), F.col(key)).otherwise(
        F.concat(F.lit("~"), F.col(row_id).cast("string")))
    found = rows.join(F.broadcast(hot), key, "left").withColumn("_key", spread).join(cold, "_key", "left")
    return found.select(*rows.columns, *[F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in columns])


def uniform(seed: str, *columns: str) -> Column:
    """A hash of the columns as a number in [0, 1): 52 bits of MD5, the same in every engine."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))
