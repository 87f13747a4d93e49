"""Load audit: one row per event of a run, and watermarks read from it.

Events are only appended, so concurrent runs never overwrite one another. The state
of a run is its newest event.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from orderloom.operators.latest import latest_per_key, newest

FIRST_WATERMARK = datetime(1900, 1, 1)
RUNNING, SUCCESS, FAILED = "running", "success", "failed"

AUDIT_SCHEMA = StructType([
    StructField("job_name", StringType()),
    StructField("target_table", StringType()),
    StructField("last_processed_ts", TimestampNTZType()),
    StructField("status", StringType()),
    StructField("error_message", StringType()),
    StructField("run_id", StringType()),
    StructField("load_type", StringType()),
    StructField("started_at", TimestampNTZType()),
    StructField("completed_at", TimestampNTZType()),
])


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class AuditLog:
    """Audit events below one folder; every call appends in a single write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _append(self, rows: Sequence[tuple]) -> None:
        # one small file per event; the folder holds runs, not data
        self.spark.createDataFrame(list(rows), AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, *runs: tuple[str, str, str, str]) -> None:
        """Runs as (job, target table, run id, load type)."""
        now = _now()
        self._append([(job, target, None, RUNNING, None, run, load, now, None) for job, target, run, load in runs])

    def success(self, processed: dict[str, datetime]) -> None:
        """Run id to the newest timestamp it processed."""
        self._finish(SUCCESS, processed, None)

    def failure(self, run_ids: Sequence[str], message: str) -> None:
        self._finish(FAILED, dict.fromkeys(run_ids), message)

    def _finish(self, status: str, processed: dict[str, datetime | None], message: str | None) -> None:
        now = _now()
        begun = (self.events().filter(F.col("run_id").isin(list(processed)) & (F.col("status") == RUNNING))
                 .collect())
        self._append([(r.job_name, r.target_table, processed[r.run_id], status, message, r.run_id, r.load_type,
                       r.started_at, now) for r in begun])

    def events(self) -> DataFrame:
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path)

    def runs(self) -> DataFrame:
        """One row per run, as it stands."""
        return current_runs(self.events())

    def watermark(self, job: str, load_type: str) -> datetime:
        """Where the next load of a job starts; one value, read to the driver."""
        try:
            events = self.events()
            events.schema
        except Exception as error:  # no audit folder yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return FIRST_WATERMARK
        return effective_watermark(events, job, load_type).first()["watermark"]


def current_runs(events: DataFrame) -> DataFrame:
    order = [F.col("completed_at").desc_nulls_last(), *newest("started_at")]
    return latest_per_key(events, ["run_id"], order)


def effective_watermark(events: DataFrame, job: str, load_type: str) -> DataFrame:
    """FULL starts at the first watermark, INCREMENTAL after the newest success."""
    if load_type not in ("FULL", "INCREMENTAL"):
        raise ValueError(f"unknown load type {load_type}")
    first = F.lit(FIRST_WATERMARK).cast("timestamp_ntz")
    done = events.filter((F.col("job_name") == job) & (F.col("status") == SUCCESS))
    newest_ts = done.agg(F.max("last_processed_ts").alias("newest"))
    value = first if load_type == "FULL" else F.coalesce(F.col("newest"), first)
    return newest_ts.select(value.alias("watermark"))
