"""Exact duplicates: group by a 128-bit content hash, compare bytes inside the group, keep one stable id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import attach_groups, staged, text_or_empty


def exact_groups(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The groups are those of the MD5 of the UTF-8 bytes and then of the bytes themselves, so two texts that collide
    stay apart; copies are counted on the map side, and one row per task travels for each text. Back on the rows a
    group is named by MD5 and SHA-256 together. ``keep`` is "smallest" or "largest" id.

    Null text counts as empty. Rows that repeat under one id are copies of each other and get the same answer. A
    null id never wins against another id; a group of null ids alone keeps null, and its rows are not kept. An
    empty table gives no rows. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    winner = {"smallest": F.min, "largest": F.max}[keep]("doc_id").alias("keep_id")
    name = F.concat(F.md5("_text"), F.sha2("_text", 256)).alias("_name")
    groups = (rows.withColumn("_hash", F.md5("_text")).groupBy("_hash", "_text")
              .agg(winner, F.count(F.lit(1)).alias("group_size"))
              .select(name, "keep_id", "group_size"))
    named = rows.select("doc_id", name)
    found = attach_groups(named, staged(groups, "exact-groups"), "_name", "group_size", "doc_id")
    return found.select("doc_id", "keep_id", "group_size",
                        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
                        F.substring("_name", 33, 64).alias("text_sha256"))


def drop_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts those with the id that stays. Of a text that
    comes with null ids alone, one row stays: the one whose columns hash lowest."""
    found = exact_groups(docs, keep, id_col, text_col)
    kept = found.filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_text"))
    sha = F.sha2(F.coalesce(docs[text_col].cast("string"), F.lit("")), 256)
    named = docs.join(kept, (docs[id_col] == kept["_kept_id"]) & (sha == kept["_kept_text"]), "left_semi")
    nameless = docs.filter(F.col(id_col).isNull()).withColumn("_kept_text", F.sha2(text_or_empty(text_col), 256))
    with_id = found.filter("keep_id is not null and doc_id is null").select(F.col("text_sha256").alias("_kept_text"))
    alone = nameless.join(with_id.distinct(), "_kept_text", "left_anti")
    row = F.struct(*docs.columns)
    one = alone.groupBy("_kept_text").agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("_row")).select("_row.*")
    return named.unionByName(one)
