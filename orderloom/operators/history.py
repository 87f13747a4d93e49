"""Change journals, current state, status history and type-2 history."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions.keys import hash_key
from orderloom.functions.text import blank_to_null, col
from orderloom.operators.audit import AuditLog
from orderloom.operators.joins import drop_matching_null_safe, same_key
from orderloom.operators.latest import latest_per_key, newest, spread
from orderloom.operators.merge import upsert_newer, upsert_table
from orderloom.sources.buckets import BucketTable
from orderloom.sources.tables import append_partitioned, read_increment, read_table, table_exists

DELETE_EVENT = "incrementaldeleterows"
# Change order within a key: seen last, then journal position, then load time.
CHANGE_ORDER = ("seen_at", "most_significant_position", "least_significant_position", "etl_updt_ts")
HISTORY_COLUMNS = ("hash_sk", "hash_seq_num", "start_ts", "end_ts", "active_flg", "reporting_flg",
                   "batch_id", "etl_load_ts", "etl_updt_ts")


def not_deleted(df: DataFrame) -> DataFrame:
    return df.filter(F.lower("event_type") != DELETE_EVENT)


def deleted_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """Keys whose newest change is a delete."""
    last = latest_per_key(df, keys, newest(*order))
    return last.filter(F.lower("event_type") == DELETE_EVENT).select(*keys)


@dataclass(frozen=True)
class JournalSpec:
    """One journal to archive: where it is read, where it goes, and its load column."""
    source: str
    target: str
    loaded_at: str = "seen_at"
    keys: tuple[str, ...] = ("pk",)


def archive_changes(spark: SparkSession, specs: Sequence[JournalSpec], low_water: Mapping[str, datetime],
                    lookback: timedelta = timedelta(0)) -> None:
    """Append the new rows of every journal to its archive, by load date.

    Rows at the watermark itself are read again, as more of them may have come since; those that the archive
    already holds, with the same key and change order, are left out. So a repeated run adds nothing.
    """
    for spec in specs:
        low = low_water.get(spec.source, datetime(1900, 1, 1))
        rows = read_increment(read_table(spark, spec.source), spec.loaded_at, low, lookback, inclusive=True)
        rows = rows.withColumn("load_date", F.to_date(spec.loaded_at))
        same = [c for c in dict.fromkeys([*spec.keys, spec.loaded_at, *CHANGE_ORDER]) if c in rows.columns]
        if table_exists(spark, spec.target):
            # only the archive's dates from the watermark on are read
            known = spark.read.parquet(spec.target).filter(F.col("load_date") >= F.lit((low - lookback).date()))
            rows = drop_matching_null_safe(rows, known, same)
        append_partitioned(rows, spec.target, ["load_date"])


def archive_all(spark: SparkSession, specs: Sequence[JournalSpec], audit: AuditLog, load_type: str = "INCREMENTAL",
                lookback: timedelta = timedelta(0), workers: int = 4) -> dict[str, str | None]:
    """Archive many journals at once, each from its own watermark; source to error, None where it went well.

    Journals share nothing: one that fails keeps its watermark and leaves the others alone. The audit is written by one
    thread before and after, as appends of two at once would share their temporary folder.
    """
    low = {spec.source: audit.watermark(spec.source, load_type) for spec in specs}
    runs = {spec.source: f"{spec.source}/{uuid.uuid4().hex}" for spec in specs}
    audit.start(*[(spec.source, spec.target, runs[spec.source], load_type) for spec in specs])

    def archive(spec: JournalSpec) -> tuple[datetime | None, str | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "archive")
        try:
            rows = read_increment(read_table(spark, spec.source), spec.loaded_at, low[spec.source], lookback)
            reached = rows.agg(F.max(spec.loaded_at)).first()[0]
            archive_changes(spark, [spec], low, lookback)
            return reached or low[spec.source], None
        except Exception as error:
            return None, str(error)[:1000]

    with ThreadPoolExecutor(max(1, min(workers, len(specs)))) as pool:
        work = {spec.source: pool.submit(inheritable_thread_target(spark)(archive), spec) for spec in specs}
        found = {source: future.result() for source, future in work.items()}
    done = {runs[s]: reached for s, (reached, error) in found.items() if error is None}
    if done:
        audit.success(done)
    for source, (_, error) in found.items():
        if error is not None:
            audit.failure([runs[source]], error)
    return {source: error for source, (_, error) in found.items()}


def current_state(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                  order: Sequence[str] = CHANGE_ORDER, with_deleted: bool = False) -> DataFrame:
    """Upsert the newest change per key, in the order of changes and not of their arrival: a change that comes late
    does not replace a newer state. Keys whose newest change is a delete go.

    A late change can only be told from a return of its key while the delete is known: with ``with_deleted`` the
    deleting changes stay in the result, which is then the target of the next run, until they are too old to matter.
    """
    merged = upsert_newer(target, changes, keys, order[0], order[1:])
    return merged if with_deleted else not_deleted(merged)


def state_history(archive: DataFrame, keys: Sequence[str], states: Sequence[str],
                  order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """One row per key and state reached (a status, or a context id); deletes left out.
    A blank state counts as missing, and all missing states as one."""
    parts = [*[col(k) for k in keys], *[F.coalesce(blank_to_null(s), F.lit("")) for s in states]]
    return latest_per_key(not_deleted(archive), parts, newest(*order))


STATE, DELETED = "_state", "deleted"


def state_rows(changes: DataFrame, states: Sequence[str]) -> DataFrame:
    """Changes with the state they stand for in ``_state``; a delete is a state of its own."""
    parts = [F.coalesce(blank_to_null(s).cast("string"), F.lit("")) for s in states]
    reached = F.concat_ws("\u0001", F.lit("state"), *parts)
    return changes.withColumn(STATE, F.when(F.lower("event_type") == DELETE_EVENT, F.lit(DELETED)).otherwise(reached))


def merge_states(table: BucketTable, changes: DataFrame, keys: Sequence[str], states: Sequence[str],
                 order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """Add changes to a table of the newest change per key and state, and return what `state_history` and `drop_deleted`
    give for all changes so far. The archive is not read again.

    Changes may come late, twice or after a delete: every state keeps its newest change and every key its newest delete,
    so batches in any order leave the same rows. ``table`` is in buckets of ``keys``; only those touched are written.
    """
    upsert_table(table, state_rows(changes, states), [*keys, STATE], order[0], tie_break=order[1:])
    return visible_states(table.read(), keys, order)


def visible_states(held: DataFrame, keys: Sequence[str], order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """The states of keys whose newest change is no delete."""
    gone = deleted_keys(held, keys, order)
    return drop_matching_null_safe(not_deleted(held), gone, keys).drop(STATE)


def drop_deleted(history: DataFrame, archive: DataFrame, keys: Sequence[str],
                 order: Sequence[str] = CHANGE_ORDER) -> DataFrame:
    """Remove the rows of keys that were deleted at the source."""
    return drop_matching_null_safe(history, deleted_keys(archive, keys, order), keys)


# Type-2 history ---------------------------------------------------------------

def scd2_stage(df: DataFrame, key_cols: Sequence[str], context_cols: Sequence[str], start_ts: Column,
               batch_id: int, loaded_at: Column | None = None) -> DataFrame:
    """Add hash keys and the history columns of a new, active version."""
    now = F.current_timestamp() if loaded_at is None else loaded_at
    return df.withColumns({
        "hash_sk": hash_key(key_cols),
        "hash_seq_num": hash_key(context_cols),
        "start_ts": start_ts,
        "end_ts": F.lit(None).cast("timestamp_ntz"),
        "active_flg": F.lit("Y"),
        "reporting_flg": F.lit("Y"),
        "batch_id": F.lit(batch_id).cast("decimal(38,0)"),
        "etl_load_ts": now,
        "etl_updt_ts": now,
    })


def scd2_merge(target: DataFrame, staged: DataFrame,
               keep: Sequence[str] = ("start_ts", "end_ts", "active_flg", "reporting_flg", "etl_load_ts")
               ) -> DataFrame:
    """Merge staged versions and close the ones they replace.

    A key may have several staged versions. One with the context of the version before it, or one that is there
    already (same key, context and start), only refreshes that version. Any other context opens a version, also
    one the key had before, and one that a delete has ended. Of staged versions that start together the last
    counts. Versions may come late or twice; the result is the same. Keys without staged versions are passed
    through and not computed anew.
    """
    columns, key = target.columns, "hash_sk"
    order = ["start_ts", "batch_id", "hash_seq_num"]
    same = ["hash_sk", "hash_seq_num", "start_ts"]
    fixed = {*keep, "hash_sk", "hash_seq_num"}
    kept, moving = [c for c in keep if c not in order], [c for c in columns if c not in (*same, "batch_id")]

    # one exchange by key serves all that follows
    both = target.withColumn("_new", F.lit(0)).unionByName(staged.select(*columns).withColumn("_new", F.lit(1))).repartition(key)
    counts = Window.partitionBy(key, "_new", "start_ts").orderBy(*newest("batch_id", "hash_seq_num"))
    both = both.withColumn("_rank", F.row_number().over(counts)).filter("_new = 0 OR _rank = 1").drop("_rank")
    # a version that is staged again is one row from here on
    met = both.groupBy(*same).agg(
        F.min(F.struct("_new", *kept)).alias("_held"), F.max(F.struct("batch_id", "_new", *moving)).alias("_told"),
        F.max("_new").alias("_staged"))
    rows = met.select(*same, F.col("_told.batch_id").alias("batch_id"), F.col("_held._new").alias("_new"), "_staged",
                      *[F.col(f"{'_held' if c in kept else '_told'}.{c}").alias(c) for c in moving])

    # in order, a staged row opens a version unless the one before it has its context and is not ended
    by_key = Window.partitionBy(key).orderBy("start_ts", "_new", "batch_id", "hash_seq_num")
    before = F.lag("hash_seq_num").over(by_key)
    ended = F.lag(F.when(F.col("_new") == 0, F.col("end_ts"))).over(by_key)
    refreshes = (F.col("_new") == 1) & before.eqNullSafe(F.col("hash_seq_num")) & (
        ended.isNull() | (ended > F.col("start_ts")))
    rows = rows.withColumn("_opens", F.when(F.coalesce(refreshes, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("_version", F.sum("_opens").over(by_key))
    last = F.struct("start_ts", "_new", "batch_id", "hash_seq_num", *[c for c in columns if c not in (*order, key)])
    merged = rows.groupBy(key, "_version").agg(
        F.min(F.struct("_new", "start_ts", "batch_id", "hash_seq_num", *kept)).alias("_first"),
        F.max(last).alias("_last"), F.max("_staged").alias("_staged"))
    versions = merged.select(*[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) if c in fixed
                               else F.col(f"_last.{c}").alias(c) for c in columns], "_staged")
    return scd2_close(versions.withColumn("_touched", F.max("_staged").over(Window.partitionBy(key))),
                      F.col("_touched") == 1).select(*columns)


def scd2_close(df: DataFrame, only: Column | None = None) -> DataFrame:
    """End every version where the next one of its key starts; the last stays active,
    unless a delete has ended it. With ``only`` other rows stay as they are. The window
    spills beyond a task's memory; for a key that holds much of a table see `scd2_close_spread`."""
    order = Window.partitionBy("hash_sk").orderBy("start_ts", "batch_id", "hash_seq_num")
    return _ended(df.withColumn("_next", F.lead("start_ts").over(order)), only)


def _ended(nexts: DataFrame, only: Column | None = None) -> DataFrame:
    # a version that a delete has ended keeps its earlier end
    end = F.least(F.when(F.col("active_flg") == "N", F.col("end_ts")), "_next")
    active = F.when(end.isNull(), "Y").otherwise("N")
    if only is not None:
        end, active = (F.when(only, new).otherwise(F.col(old)) for new, old in ((end, "end_ts"), (active, "active_flg")))
    return nexts.withColumns({"end_ts": end, "active_flg": active}).drop("_next")


def scd2_close_spread(df: DataFrame, stage: Callable[[DataFrame], DataFrame], parts: int | None = None) -> DataFrame:
    """As `scd2_close`, also where one key has much of the table.

    Rows are dealt by ranges of (key, start), so a large key lies in many ranges. Within a range the next start is at
    hand; the last version of a key in its range takes the first start of the key's next range, found among one row per
    key and range. ``stage`` writes rows and reads them back, so that ranges stay as they are.
    """
    order = ["start_ts", "batch_id", "hash_seq_num"]
    count = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df.repartitionByRange(count, "hash_sk", *order).withColumn("_range", F.spark_partition_id()))
    firsts = ranged.groupBy("hash_sk", "_range").agg(F.min("start_ts").alias("_first"))
    by_range = Window.partitionBy("hash_sk").orderBy("_range")
    following = firsts.select("hash_sk", "_range", F.lead("_first").over(by_range).alias("_following"))
    within = Window.partitionBy("hash_sk", "_range").orderBy(*order)
    nexts = ranged.withColumn("_next", F.lead("start_ts").over(within))
    # the join shares the window's exchange; what it brings counts for the last version of a key in its range
    whole = nexts.join(following, ["hash_sk", "_range"], "left")
    return _ended(whole.withColumn("_next", F.coalesce("_next", "_following"))).select(*df.columns)


def scd2_delete(target: DataFrame, live: DataFrame, keys: Sequence[str], ended_at: Column) -> DataFrame:
    """End the active versions whose key is gone from the source."""
    live_keys = live.select(*[F.col(k).alias(f"_l_{k}") for k in keys]).distinct().withColumn("_live", F.lit(True))
    joined = target.join(live_keys, same_key(target, live_keys, {k: f"_l_{k}" for k in keys}), "left")
    gone = F.col("_live").isNull() & (F.col("active_flg") == "Y")
    return joined.withColumns({
        "end_ts": F.when(gone, ended_at).otherwise(F.col("end_ts")),
        "active_flg": F.when(gone, F.lit("N")).otherwise(F.col("active_flg")),
    }).drop("_live", *[f"_l_{k}" for k in keys])


def scd1_delete(target: DataFrame, live: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove the rows whose key is gone from the source."""
    right = live.select(*[F.col(k).alias(f"_l_{k}") for k in keys])
    return target.join(right, same_key(target, right, {k: f"_l_{k}" for k in keys}), "left_semi")


def mark_status_history(target: DataFrame, status: str, order: Sequence[str] = ("start_ts", "batch_id", "hash_seq_num"),
                        dealt_by_key: bool = False) -> DataFrame:
    """Flag, per key, the newest version of each status. For rows that a merge has just dealt out by key a window
    does so in place; others are aggregated first and joined."""
    last = F.max(F.struct(*order))
    if dealt_by_key:
        joined = target.withColumn("_last", last.over(Window.partitionBy("hash_sk", status)))
    else:
        joined = spread(target, target.groupBy("hash_sk", status).agg(last.alias("_last")), ["hash_sk", status])
    flag = F.when(F.struct(*order).eqNullSafe(F.col("_last")), "Y").otherwise("N")
    return joined.withColumn("status_hist_flg", flag).drop("_last")


def current_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("active_flg") == "Y")
