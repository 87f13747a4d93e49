"""Queries over upserts, change history, audit, data quality and the message stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators import history as H
from orderloom.operators import quality as Q
from orderloom.operators.audit import AuditLog, effective_watermark
from orderloom.operators.latest import latest_per_key, newest
from orderloom.operators.merge import load_counts, upsert, upsert_newer, upsert_pruned, upsert_table
from orderloom.sources.messages import read_message_stream
from orderloom.sources.buckets import BucketTable
from orderloom.sources.snapshots import SnapshotTable
from orderloom.sources.tables import append_partitioned, read_evolved
from orderloom.streaming.handlers import chargeback_rows, consignment_rows, exchange_rows, order_rows, refund_rows, \
    return_rows, tender_rows
from orderloom.streaming.ingest import MessageSink, start_ingest
from orderloom.workload.registry import as_doubles, new_folder, query
from orderloom.workload.standins import Inputs

FIRST_DAY, SECOND_DAY, THIRD_DAY = (datetime(2024, 1, d) for d in (1, 2, 3))


def at(day: datetime) -> Column:
    return F.lit(day).cast("timestamp_ntz")


# Upserts -------------------------------------------------------------------------

def _orders(t: Inputs) -> DataFrame:
    return t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")


_TARGET = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
_SOURCE = """SELECT * REPLACE ('X' AS o_orderstatus, 'changed' AS o_orderpriority) FROM orders WHERE o_orderkey % 3 = 0"""


def _halves(t: Inputs) -> tuple[DataFrame, DataFrame]:
    target = _orders(t).filter(F.col("o_orderdate") < at(datetime(1999, 1, 1)))
    source = _orders(t).filter("o_orderkey % 3 = 0").withColumns({
        "o_orderstatus": F.lit("X"), "o_orderpriority": F.lit("changed")})
    return target, source


@query(f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM (
  SELECT * FROM ({_TARGET}) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_SOURCE}))
  UNION ALL SELECT * FROM ({_SOURCE}))""")
def upsert_orders(t: Inputs) -> DataFrame:
    target, source = _halves(t)
    return upsert(target, source, ["o_orderkey"])


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN s.o_orderkey IS NOT NULL THEN 'X' ELSE t.o_orderstatus END
    AS o_orderstatus, t.o_orderpriority, t.o_orderdate FROM ({_TARGET}) t LEFT JOIN (SELECT o_orderkey FROM
    ({_SOURCE})) s USING (o_orderkey)
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM ({_SOURCE})
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_TARGET}))""")
def upsert_some_columns(t: Inputs) -> DataFrame:
    """Only the status of matched orders changes; their priority is kept."""
    target, source = _halves(t)
    return upsert(target, source, ["o_orderkey"], update_cols=["o_orderstatus", "o_orderpriority"],
                  exclude=["o_orderpriority"])


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events
  GROUP BY 1, 2""")
def upsert_newer_events(t: Inputs) -> DataFrame:
    """The later half is loaded first, then the earlier half: older rows must not win."""
    events = t["events"].select("user_id", "event_type", "event_id", "ts")
    middle = at(datetime(2024, 1, 15))
    keys = ["user_id", "event_type"]
    late = latest_per_key(events.filter(F.col("ts") >= middle), keys, newest("ts", "event_id"))
    return upsert_newer(late, events.filter(F.col("ts") < middle), keys, "ts", ["event_id"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND o_orderdate >= TIMESTAMP '2000-01-01' THEN 'Z' ELSE
    o_orderstatus END AS o_orderstatus, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders
  UNION ALL SELECT o_orderkey + 100000000, 'N', strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderkey % 10 = 0
    AND o_orderdate >= TIMESTAMP '2000-01-01'""")
def upsert_recent_partitions(t: Inputs) -> DataFrame:
    """Monthly partitions; only those from 2000 on that change are read and rewritten."""
    path = new_folder(t, "orders-by-month")
    rows = t["orders"].select("o_orderkey", "o_orderstatus",
                              F.date_format("o_orderdate", "yyyy-MM").alias("order_month"))
    append_partitioned(rows, path, ["order_month"])
    recent = rows.filter("order_month >= '2000-01'")
    changed = recent.filter("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("Z"))
    added = recent.filter("o_orderkey % 10 = 0").withColumns({
        "o_orderkey": F.col("o_orderkey") + 100_000_000, "o_orderstatus": F.lit("N")})
    return upsert_pruned(t.spark, path, changed.unionByName(added), ["o_orderkey"], "order_month", "2000-01")


@query(f"""SELECT count(*) FILTER (o_orderkey NOT IN (SELECT o_orderkey FROM ({_TARGET}))) AS inserted_rows,
  count(*) FILTER (o_orderkey IN (SELECT o_orderkey FROM ({_TARGET}))) AS updated_rows FROM ({_SOURCE})""")
def count_load(t: Inputs) -> DataFrame:
    target, source = _halves(t)
    return load_counts(target, source, ["o_orderkey"])


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events
  GROUP BY 1, 2""")
def upsert_snapshots(t: Inputs) -> DataFrame:
    """Three loads into a snapshot table, the second one twice."""
    table = SnapshotTable(t.spark, new_folder(t, "latest"))
    events = t["events"].select("user_id", "event_type", "event_id", "ts")
    for part in (0, 1, 1, 2):
        upsert_table(table, events.filter(F.col("event_id") % 3 == part), ["user_id", "event_type"], "ts",
                     tie_break=["event_id"])
    return table.read()


# Change journals -------------------------------------------------------------------

@query("""SELECT CAST(seen_at AS DATE) AS load_date, count(*) AS n, CAST(sum(pk) AS BIGINT) AS keys FROM journal
  GROUP BY 1""", uses=["journal"])
def archive_journal(t: Inputs) -> DataFrame:
    """Two incremental runs of one journal; the second starts where the first ended."""
    source, target = new_folder(t, "journal"), new_folder(t, "archive")
    t["journal"].write.parquet(source)
    specs = [H.JournalSpec(source, target)]
    first_end = t["journal"].filter(F.col("seen_at") < at(datetime(2024, 1, 10))).agg(F.max("seen_at")).first()[0]
    t["journal"].filter(F.col("seen_at") <= at(first_end)).write.parquet(f"{source}-early")
    H.archive_changes(t.spark, [H.JournalSpec(f"{source}-early", target)], {})
    H.archive_changes(t.spark, specs, {source: first_end})
    archive = t.spark.read.parquet(target)
    return archive.groupBy("load_date").agg(F.count(F.lit(1)).alias("n"), F.sum("pk").alias("keys"))


_LAST = """SELECT * FROM journal QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seen_at DESC,
  most_significant_position DESC, least_significant_position DESC) = 1"""


@query(f"""SELECT pk, least_significant_position, seen_at, status_id, CAST(quantity AS DOUBLE) AS quantity
  FROM ({_LAST}) WHERE event_type <> 'IncrementalDeleteRows'""", uses=["journal"])
def current_state(t: Inputs) -> DataFrame:
    """State after two batches of changes; deleted keys are gone."""
    middle = at(datetime(2024, 1, 15))
    first = t["journal"].filter(F.col("seen_at") < middle)
    empty = t["journal"].filter(F.lit(False))
    state = H.current_state(empty, first, ["pk"])
    state = H.current_state(state, t["journal"].filter(F.col("seen_at") >= middle), ["pk"])
    return as_doubles(state.select("pk", "least_significant_position", "seen_at", "status_id", "quantity"))


_STATES = """SELECT * FROM journal WHERE lower(event_type) <> 'incrementaldeleterows' QUALIFY row_number() OVER (
  PARTITION BY pk, CASE WHEN trim(status_id) <> '' THEN status_id ELSE '' END ORDER BY seen_at DESC,
  most_significant_position DESC, least_significant_position DESC) = 1"""


@query(f"SELECT pk, status_id, least_significant_position, seen_at FROM ({_STATES})", uses=["journal"])
def state_history(t: Inputs) -> DataFrame:
    return H.state_history(t["journal"], ["pk"], ["status_id"]).select(
        "pk", "status_id", "least_significant_position", "seen_at")


@query(f"""SELECT pk, status_id, least_significant_position FROM ({_STATES}) WHERE pk NOT IN (SELECT pk FROM ({_LAST})
  WHERE event_type = 'IncrementalDeleteRows')""", uses=["journal"])
def state_history_without_deleted(t: Inputs) -> DataFrame:
    states = H.state_history(t["journal"], ["pk"], ["status_id"])
    return H.drop_deleted(states, t["journal"], ["pk"]).select("pk", "status_id", "least_significant_position")


@query(f"""SELECT pk, status_id, least_significant_position FROM ({_STATES}) WHERE pk NOT IN (SELECT pk FROM ({_LAST})
  WHERE event_type = 'IncrementalDeleteRows')""", uses=["journal"])
def merge_state_batches(t: Inputs) -> DataFrame:
    """Three batches in the wrong order, one of them twice: the rows of one pass over the whole archive."""
    table = BucketTable(t.spark, new_folder(t, "states"), ["pk"], buckets=8)
    part = F.col("least_significant_position") % 3
    for n in (2, 0, 1, 0):
        states = H.merge_states(table, t["journal"].filter(part == n), ["pk"], ["status_id"])
    return states.select("pk", "status_id", "least_significant_position")


@query("""SELECT 'journal' || CAST(user_id % 4 AS VARCHAR) AS journal, 'success' AS status, count(*) AS archived,
    max(ts) AS watermark FROM events GROUP BY 1
  UNION ALL SELECT 'lost', 'failed', 0, NULL""")
def archive_journals(t: Inputs) -> DataFrame:
    """Five journals at once, in two runs; one has no source, the others are archived all the same."""
    root = new_folder(t, "journals")
    log = AuditLog(t.spark, f"{root}/audit")
    journal, middle = t["journal"], at(datetime(2024, 1, 15))
    names = [f"journal{n}" for n in range(4)]
    for run, rows in ((1, journal.filter(F.col("seen_at") < middle)), (2, journal.filter(F.col("seen_at") >= middle))):
        for n, name in enumerate(names):
            rows.filter(F.col("pk") % 4 == n).write.mode("append").parquet(f"{root}/{name}")
        specs = [H.JournalSpec(f"{root}/{name}", f"{root}/archive/{name}", keys=("pk", "least_significant_position"))
                 for name in (*names, "lost")]
        H.archive_all(t.spark, specs, log)
    source = F.element_at(F.split("job_name", "/"), -1)
    runs = log.runs().withColumn("journal", source)
    state = runs.groupBy("journal").agg(F.max("status").alias("status"), F.max("last_processed_ts").alias("watermark"))
    counts = [t.spark.read.parquet(f"{root}/archive/{n}").agg(F.count(F.lit(1)).alias("archived")).select(
        F.lit(n).alias("journal"), "archived") for n in names]
    archived = counts[0]
    for more in counts[1:]:
        archived = archived.unionByName(more)
    return state.join(archived, "journal", "left").select(
        "journal", "status", F.coalesce("archived", F.lit(0)).cast("bigint").alias("archived"), "watermark")


@query("""SELECT CAST(ts AS DATE) AS load_date, event_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS kind, user_id
  FROM events""")
def append_growing_history(t: Inputs) -> DataFrame:
    """The second batch adds a column and brings a wider type; both are read back as one table."""
    path = new_folder(t, "growing")
    events = t["events"].select("event_id", "user_id", "ts", F.col("event_type").alias("kind"))
    by = {"load_date": F.to_date("ts")}
    first = events.filter("event_id % 2 = 0").withColumn("user_id", F.col("user_id").cast("int"))
    append_partitioned(first.drop("kind"), path, by, evolve=True)
    append_partitioned(events.filter("event_id % 2 = 1"), path, by, evolve=True)
    return read_evolved(t.spark, path).select("load_date", "event_id", "kind", "user_id")


# Type-2 history ----------------------------------------------------------------------

def _batch(t: Inputs, day: datetime, number: int, status: Column, where: str) -> DataFrame:
    rows = t["orders"].filter(where).select("o_orderkey", "o_custkey", status.alias("status"))
    return H.scd2_stage(rows, ["o_orderkey"], ["status"], at(day), number, loaded_at=at(day))


def _three_batches(t: Inputs) -> DataFrame:
    """Orders over three days: a third change on day two, a half of these change back on
    day three, when some orders are new. Every other order is loaded unchanged."""
    old = F.col("o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 3 == 0, F.lit("Q")).otherwise(old)
    back = F.when(F.col("o_orderkey") % 6 == 0, old).otherwise(changed)
    table = SnapshotTable(t.spark, new_folder(t, "versions"))
    table.write(_batch(t, FIRST_DAY, 1, old, "o_orderkey % 10 <> 0"))
    table.write(H.scd2_merge(table.read(), _batch(t, SECOND_DAY, 2, changed, "o_orderkey % 10 <> 0")))
    return table.write(H.scd2_merge(table.read(), _batch(t, THIRD_DAY, 3, back, "TRUE")))


# versions as (order, status, first day, end day)
_VERSIONS = """SELECT o_orderkey, s1 AS status, 1 AS d, CASE WHEN s2 <> s1 THEN 2 WHEN s3 <> s1 THEN 3 END AS e
    FROM o WHERE o_orderkey % 10 <> 0
  UNION ALL SELECT o_orderkey, s2, 2, CASE WHEN s3 <> s2 THEN 3 END FROM o WHERE o_orderkey % 10 <> 0 AND s2 <> s1
  UNION ALL SELECT o_orderkey, s3, 3, NULL FROM o WHERE o_orderkey % 10 = 0 OR s3 <> s2"""
_O = """o AS (SELECT o_orderkey, o_orderstatus AS s1, CASE WHEN o_orderkey % 3 = 0 THEN 'Q' ELSE o_orderstatus END
  AS s2, CASE WHEN o_orderkey % 6 = 0 THEN o_orderstatus WHEN o_orderkey % 3 = 0 THEN 'Q' ELSE o_orderstatus END
  AS s3 FROM orders)"""
_DAY = "TIMESTAMP '2024-01-01' + to_days(CAST({d} - 1 AS INTEGER))"


def _versions(more: str = "", end: str = "e", flag: str = "CASE WHEN e IS NULL THEN 'Y' ELSE 'N' END") -> str:
    return f"""WITH {_O}, v AS ({_VERSIONS}) SELECT o_orderkey, status, {_DAY.format(d='d')} AS start_ts,
      {_DAY.format(d=end)} AS end_ts, {flag} AS active_flg {more} FROM v"""


@query(_versions())
def type2_merge(t: Inputs) -> DataFrame:
    """A context that comes back opens a new version; unchanged ones open none."""
    return _three_batches(t).select("o_orderkey", "status", "start_ts", "end_ts", "active_flg")


@query(_versions(end="CASE WHEN e IS NULL AND o_orderkey % 7 = 1 THEN 9 ELSE e END",
                 flag="CASE WHEN e IS NULL AND o_orderkey % 7 <> 1 THEN 'Y' ELSE 'N' END"))
def type2_delete(t: Inputs) -> DataFrame:
    """Orders missing at the source are ended; a later close keeps them so."""
    live = t["orders"].filter("o_orderkey % 7 <> 1").select("o_orderkey")
    ended = H.scd2_delete(_three_batches(t), live, ["o_orderkey"], at(datetime(2024, 1, 9)))
    return H.scd2_close(ended).select("o_orderkey", "status", "start_ts", "end_ts", "active_flg")


@query(f"WITH {_O}, v AS ({_VERSIONS}) SELECT o_orderkey, status FROM v WHERE o_orderkey % 7 <> 1")
def type1_delete(t: Inputs) -> DataFrame:
    live = t["orders"].filter("o_orderkey % 7 <> 1").select("o_orderkey")
    return H.scd1_delete(_three_batches(t), live, ["o_orderkey"]).select("o_orderkey", "status")


@query(f"""WITH {_O}, v AS ({_VERSIONS}) SELECT o_orderkey, status, {_DAY.format(d='d')} AS start_ts,
  CASE WHEN d = max(d) OVER (PARTITION BY o_orderkey, status) THEN 'Y' ELSE 'N' END AS status_hist_flg FROM v""")
def mark_status_history(t: Inputs) -> DataFrame:
    return H.mark_status_history(_three_batches(t), "status").select(
        "o_orderkey", "status", "start_ts", "status_hist_flg")


@query("""SELECT user_id, event_id, ts AS start_ts, lead(ts) OVER w AS end_ts, CASE WHEN lead(ts) OVER w IS NULL
  THEN 'Y' ELSE 'N' END AS active_flg FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def type2_close_versions(t: Inputs) -> DataFrame:
    """Many versions of every key, closed by their starts."""
    rows = t["events"].select("user_id", "event_id", "ts", "event_type")
    staged = H.scd2_stage(rows, ["user_id"], ["event_type"], F.col("ts"), 0, loaded_at=F.col("ts"))
    staged = staged.withColumn("batch_id", F.col("event_id").cast("decimal(38,0)"))
    return H.scd2_close(staged).select("user_id", "event_id", "start_ts", "end_ts", "active_flg")


@query("""SELECT k AS user_id, event_id, ts AS start_ts, lead(ts) OVER w AS end_ts, CASE WHEN lead(ts) OVER w IS NULL
  THEN 'Y' ELSE 'N' END AS active_flg FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS k FROM events)
  WINDOW w AS (PARTITION BY k ORDER BY ts, event_id)""")
def type2_close_hot_key(t: Inputs) -> DataFrame:
    """One key has a third of all versions; they are closed in ranges, over many tasks."""
    key = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).cast("bigint")
    rows = t["events"].select(key.alias("user_id"), "event_id", "ts", "event_type")
    staged = H.scd2_stage(rows, ["user_id"], ["event_type"], F.col("ts"), 0, loaded_at=F.col("ts"))
    staged = staged.withColumn("batch_id", F.col("event_id").cast("decimal(38,0)"))

    def stage(df: DataFrame) -> DataFrame:
        folder = new_folder(t, "ranges")
        df.write.parquet(folder)
        return t.spark.read.parquet(folder)

    return H.scd2_close_spread(staged, stage, parts=16).select("user_id", "event_id", "start_ts", "end_ts", "active_flg")


# Audit -----------------------------------------------------------------------------

_RUNS = """SELECT 'run' || event_id AS run_id, event_type AS job, CASE WHEN event_id % 5 = 0 THEN 'failed'
  WHEN event_id % 7 = 0 THEN 'running' ELSE 'success' END AS status, ts FROM events"""


@query(f"""SELECT job, CASE load WHEN 'FULL' THEN TIMESTAMP '1900-01-01' ELSE max(ts) FILTER (status = 'success') END
  AS watermark, load FROM ({_RUNS}), (VALUES ('FULL'), ('INCREMENTAL')) l(load) GROUP BY job, load""")
def load_watermarks(t: Inputs) -> DataFrame:
    """Events read as audit events of five jobs: the watermark is the newest success."""
    status = F.when(F.col("event_id") % 5 == 0, "failed").when(F.col("event_id") % 7 == 0, "running").otherwise(
        "success")
    runs = t["events"].select(F.col("event_type").alias("job_name"), F.col("ts").alias("last_processed_ts"),
                              status.alias("status"))
    parts = []
    for job in ("click", "error", "purchase", "signup", "view"):
        for load in ("FULL", "INCREMENTAL"):
            parts.append(effective_watermark(runs, job, load).select(
                F.lit(job).alias("job"), "watermark", F.lit(load).alias("load")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("""SELECT 'orders' AS job_name, CASE k WHEN 1 THEN 'failed' ELSE 'success' END AS status, count(*) AS runs,
  max(CASE WHEN k <> 1 THEN o_orderdate END) AS last_processed_ts FROM (SELECT o_orderkey % 3 AS k, max(o_orderdate)
  AS o_orderdate FROM orders GROUP BY 1) GROUP BY 2""")
def audit_of_runs(t: Inputs) -> DataFrame:
    """Three runs over parts of the orders, one of which fails."""
    log = AuditLog(t.spark, new_folder(t, "audit"))
    log.start(*[("orders", "orders_refined", f"run{k}", "INCREMENTAL") for k in range(3)])
    newest_ts = {r["k"]: r["m"] for r in t["orders"].groupBy((F.col("o_orderkey") % 3).alias("k")).agg(
        F.max("o_orderdate").alias("m")).collect()}
    log.success({"run0": newest_ts[0], "run2": newest_ts[2]})
    log.failure(["run1"], "it failed")
    return log.runs().groupBy("job_name", "status").agg(F.count(F.lit(1)).alias("runs"),
                                                        F.max("last_processed_ts").alias("last_processed_ts"))


# Data quality ------------------------------------------------------------------------

def _quality_tables(t: Inputs) -> dict[str, DataFrame]:
    """The star tables with some faults: null prices, orders of unknown customers, and
    line numbers that repeat within an order."""
    orders = t["orders"].withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")),
        "order_text": F.col("o_orderkey").cast("string")})
    customers = t["customer"].filter("c_custkey % 20 <> 0")
    return {"orders": orders, "customer": customers, "lineitem": t["lineitem"]}


_RULES = [
    Q.NotNull("R1", "orders", ("o_totalprice",), ("o_orderkey",), "POST"),
    Q.FixedLength("R2", "orders", ("order_text",), ("o_orderkey",), "POST", length=4),
    Q.InRange("R3", "orders", ("o_totalprice",), ("o_orderkey",), "POST", low="1000", high="400000"),
    Q.InRange("R4", "lineitem", ("l_quantity",), ("l_orderkey",), "POST", "LOW", low="1", high="40"),
    Q.NeededWith("R5", "orders", ("o_totalprice",), ("o_orderkey",), "POST", other="o_orderstatus"),
    Q.References("R6", "orders", ("o_custkey",), ("o_orderkey",), "POST", parent="customer",
                 parent_columns=("c_custkey",)),
    Q.UniqueKey("R7", "lineitem", ("l_orderkey", "l_linenumber"), group_id="POST", active_flag=None),
]
_PRICE = "CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END"


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 50 = 0")
def quality_not_null(t: Inputs) -> DataFrame:
    return _RULES[0].failing(_quality_tables(t))


@query("SELECT o_orderkey FROM orders WHERE length(CAST(o_orderkey AS VARCHAR)) <> 4")
def quality_fixed_length(t: Inputs) -> DataFrame:
    return _RULES[1].failing(_quality_tables(t))


@query(f"SELECT o_orderkey FROM orders WHERE {_PRICE} NOT BETWEEN 1000 AND 400000")
def quality_in_range(t: Inputs) -> DataFrame:
    return _RULES[2].failing(_quality_tables(t))


@query(f"SELECT o_orderkey FROM orders WHERE {_PRICE} IS NULL AND o_orderstatus IS NOT NULL")
def quality_needed_with(t: Inputs) -> DataFrame:
    return _RULES[4].failing(_quality_tables(t))


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 20 <> 0)")
def quality_references(t: Inputs) -> DataFrame:
    return _RULES[5].failing(_quality_tables(t))


@query("SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def quality_unique_key(t: Inputs) -> DataFrame:
    return _RULES[6].failing(_quality_tables(t))


@query(f"""SELECT 'R1' AS rule_id, 'Not Null' AS rule_type, 'POST' AS group_id, 'orders' AS table_name,
    'o_totalprice' AS column_name, 'HIGH' AS severity, count(*) FILTER ({_PRICE} IS NULL) AS failing_rows FROM orders
  UNION ALL SELECT 'R2', 'Attribute length Check', 'POST', 'orders', 'order_text', 'HIGH',
    count(*) FILTER (length(CAST(o_orderkey AS VARCHAR)) <> 4) FROM orders
  UNION ALL SELECT 'R3', 'Attribute With in Range Check', 'POST', 'orders', 'o_totalprice', 'HIGH',
    count(*) FILTER ({_PRICE} NOT BETWEEN 1000 AND 400000) FROM orders
  UNION ALL SELECT 'R4', 'Attribute With in Range Check', 'POST', 'lineitem', 'l_quantity', 'LOW',
    count(*) FILTER (l_quantity NOT BETWEEN 1 AND 40) FROM lineitem
  UNION ALL SELECT 'R5', 'Conditional Null Check', 'POST', 'orders', 'o_totalprice', 'HIGH',
    count(*) FILTER ({_PRICE} IS NULL) FROM orders
  UNION ALL SELECT 'R6', 'Referential Integrity Check', 'POST', 'orders', 'o_custkey', 'HIGH', count(*) FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 20 <> 0)
  UNION ALL SELECT 'R7', 'Unique Key', 'POST', 'lineitem', 'l_orderkey,l_linenumber', 'HIGH', count(*) FROM (
    SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def quality_results(t: Inputs) -> DataFrame:
    return Q.run_rules(_quality_tables(t), _RULES)


_RULE_ROWS = [
    ("K1", "Not Null", "G1", "versions", ["status"], ["o_orderkey"], "HIGH", None, "Y"),
    ("K2", "Attribute length Check", "G1", "versions", ["status"], ["o_orderkey"], "LOW", {"length": "2"}, "Y"),
    ("K3", "Attribute With in Range Check", "G1", "versions", ["o_custkey"], ["o_orderkey"], "LOW",
     {"low": "10", "high": "100"}, "Y"),
    ("K4", "Conditional Null Check", "G2", "versions", ["end_ts"], ["o_orderkey"], "LOW", {"other": "active_flg"}, "Y"),
    ("K5", "Referential Integrity Check", "G2", "versions", ["o_custkey"], ["o_orderkey"], "LOW",
     {"parent": "customer", "parent_columns": "c_custkey"}, "Y"),
    ("K6", "Unique Key", "G2", "versions", ["o_orderkey"], [], "HIGH", None, "Y"),
    ("K7", "Not Null", "G2", "versions", ["no such column"], [], "HIGH", None, "N"),
]


@query(f"""WITH {_O}, v AS ({_VERSIONS}), x AS (SELECT v.*, o_custkey FROM v JOIN orders USING (o_orderkey))
  SELECT 'K1' AS rule_id, 'Not Null' AS rule_type, 'G1' AS group_id, 'versions' AS table_name, 'status' AS column_name,
    'HIGH' AS severity, count(*) FILTER (status IS NULL) AS failing_rows FROM x
  UNION ALL SELECT 'K2', 'Attribute length Check', 'G1', 'versions', 'status', 'LOW', count(*) FILTER (length(status) <> 2) FROM x
  UNION ALL SELECT 'K3', 'Attribute With in Range Check', 'G1', 'versions', 'o_custkey', 'LOW',
    count(*) FILTER (o_custkey NOT BETWEEN 10 AND 100) FROM x
  UNION ALL SELECT 'K4', 'Conditional Null Check', 'G2', 'versions', 'end_ts', 'LOW', count(*) FILTER (e IS NULL) FROM x
  UNION ALL SELECT 'K5', 'Referential Integrity Check', 'G2', 'versions', 'o_custkey', 'LOW',
    count(*) FILTER (o_custkey % 20 = 0) FROM x
  UNION ALL SELECT 'K6', 'Unique Key', 'G2', 'versions', 'o_orderkey', 'HIGH', 0""")
def quality_rules_as_rows(t: Inputs) -> DataFrame:
    """All kinds of rules from rows, over a type-2 table; the gate lets it pass, as no HIGH rule fails."""
    tables = {"versions": _three_batches(t), "customer": t["customer"].filter("c_custkey % 20 <> 0")}
    rules = Q.rules_from_rows(t.spark.createDataFrame(_RULE_ROWS, Q.RULE_ROWS))
    return Q.gate(Q.run_rules(tables, rules))


_SEARCHED = {"customer": ("c_name", "c_mktsegment"), "part": ("p_name", "p_brand", "p_type"),
             "documents": ("text", "lang", "source"), "pages": ("url", "html"),
             "conversations": ("role", "text"), "benchmark": ("text",)}


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT 'the' AS search_value, '{table}' AS table_name, '{c}' AS column_name, "
    f"count(*) FILTER ({c} ILIKE '%the%') AS matching_rows FROM {table}"
    for table, columns in _SEARCHED.items() for c in columns) + ") WHERE matching_rows > 0")
def search_all_texts(t: Inputs) -> DataFrame:
    """Whole texts of six tables; one scan each."""
    return Q.search_values({name: t[name] for name in _SEARCHED}, "THE").withColumn(
        "search_value", F.lower("search_value"))


# Message stream ------------------------------------------------------------------------

# One order message per order: a group per fulfilment type, and a payment.
_ORDER_MESSAGE = """SELECT o_orderkey, to_json(named_struct('messageType', 'ORDER', 'orderId', concat(order_id, ' '),
  'companyNumber', org_id, 'orderStatus', lower(max(o_orderstatus)), 'postedAt', date_format(max(o_orderdate),
  "yyyy-MM-dd'T'HH:mm:ss"), 'postedBy', 'svc', 'order', named_struct('orderHeader', named_struct('orderDateTime',
  date_format(max(o_orderdate), 'yyyy-MM-dd HH:mm:ss'), 'userAgent', CASE o_custkey % 2 WHEN 0 THEN 'X Windows NT'
  ELSE 'iPhone' END, 'phoneNumber', '555'), 'user', named_struct('id', concat('U', CAST(o_custkey AS STRING)),
  'email', concat(' User', CAST(o_custkey AS STRING), '@Example.com')), 'fullfillmentGrouping', array(named_struct(
  'fullfillmentType', 'SHIP', 'orderLines', sort_array(collect_list(named_struct('lineNumber', order_line_id,
  'quantity', CAST(quantity AS STRING), 'product', named_struct('productNumber', concat('N', CAST(l_partkey AS
  STRING)), 'sku', concat('US', CAST(l_partkey AS STRING))))))))), 'payment', named_struct('currencyIso', 'USD',
  'authorizations', array(named_struct('paymentType', 'CARD', 'authAmount', CAST(max(total) AS STRING), 'attributes',
  named_struct('email', 'a@b.c '))), 'paymentTransactions', array(named_struct('consignmentId', 'C1', 'transaction',
  named_struct('amount', '1')), named_struct('consignmentId', 'C2', 'transaction',
  CAST(NULL AS STRUCT<amount: STRING>)))))) AS json
  FROM {line_base} GROUP BY o_orderkey, order_id, org_id, o_custkey"""


def _order_messages(t: Inputs) -> DataFrame:
    return t.sql(_ORDER_MESSAGE)


def _enveloped(messages: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return messages.select("json", now.alias("load_time_source"), now.alias("load_time"))


@query("""SELECT order_id, order_line_id AS line_number, org_id AS company_number, 'SHIP' AS fulfilment_type,
  CASE o_custkey % 2 WHEN 0 THEN 'PC' ELSE 'MOBILE' END AS device_class, CAST(quantity AS VARCHAR) AS line_quantity,
  md5('USER' || CAST(o_custkey AS VARCHAR) || '@EXAMPLE.COM') AS user_email, CAST(o_orderdate AS DATE) AS order_date,
  CAST(CAST(p_retailprice AS DECIMAL(18,4)) * quantity AS DOUBLE) AS cost FROM line_base JOIN part
  ON p_partkey = l_partkey""", uses=["line_base"])
def stream_order_messages(t: Inputs) -> DataFrame:
    """JSON files drained as a stream: raw landing, fan-out, cost, identity split, upsert.

    The stream is run to its end, then started again; the second run finds nothing new.
    """
    root = new_folder(t, "stream")
    _order_messages(t).select("json").write.text(f"{root}/in")
    costs = t["part"].select(F.concat(F.lit("N"), F.col("p_partkey").cast("string")).alias("product_number"),
                             F.concat(F.lit("US"), F.col("p_partkey").cast("string")).alias("sku"),
                             F.col("p_retailprice").alias("unit_cost"))
    sink = MessageSink(f"{root}/out", product_costs=costs)
    for _ in range(2):
        stream = read_message_stream(t.spark, "text", {"path": f"{root}/in", "maxFilesPerTrigger": "4"})
        start_ingest(stream, sink, f"{root}/checkpoint", drain=True).awaitTermination()
    refined = sink.table(t.spark, "ORDER").read()
    if "phone_number" in refined.columns:
        raise AssertionError("identity columns reached the refined table")
    return as_doubles(refined.select(
        "order_id", "line_number", "company_number", "fulfilment_type", "device_class", "line_quantity",
        "user_email", "order_date", F.col("cost_of_goods").alias("cost")))


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2""")
def stream_latest_events(t: Inputs) -> DataFrame:
    """Micro-batches of events, deduplicated and upserted; equals the batch result."""
    root = new_folder(t, "events-stream")
    events = t["events"].select("user_id", "event_type", "event_id", "ts")
    events.select(F.to_json(F.struct("*")).alias("value")).repartition(6).write.text(f"{root}/in")
    table = BucketTable(t.spark, f"{root}/latest", ["user_id", "event_type"], buckets=8)

    def load(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.select(F.from_json("value", events.schema).alias("e")).select("e.*")
        upsert_table(table, parsed, ["user_id", "event_type"], "ts", tie_break=["event_id"])

    stream = t.spark.readStream.format("text").option("maxFilesPerTrigger", "2").load(f"{root}/in")
    start_ingest(stream, load, f"{root}/checkpoint", drain=True).awaitTermination()
    return table.read().select("user_id", "event_type", "event_id")


@query("""SELECT kind, count(*) AS messages FROM (SELECT CASE event_type WHEN 'click' THEN 'ORDER' WHEN 'view' THEN
  'REFUND' WHEN 'signup' THEN 'RETURN' WHEN 'purchase' THEN 'EXCHANGE' END AS kind FROM events) WHERE kind IS NOT NULL
  GROUP BY 1""")
def route_messages(t: Inputs) -> DataFrame:
    """Events as messages of four known types and an unknown one; each reaches its handler."""
    root = new_folder(t, "routing")
    kinds = {"click": "ORDER", "view": "REFUND", "signup": "RETURN", "purchase": "EXCHANGE", "error": "OTHER"}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
    rows = t["events"].select(F.to_json(F.struct(kind.alias("messageType"), F.col("event_id").cast("string")
                                                 .alias("orderId"))).alias("json"))
    rows.write.text(f"{root}/in")
    wanted = tuple(k for k in kinds.values() if k != "OTHER")

    def keep(kind: str):
        def handle(batch: DataFrame, costs: DataFrame | None = None) -> DataFrame:
            return batch.select(F.get_json_object("json", "$.orderId").alias("order_id"), F.lit(kind).alias("kind"),
                                "load_time")
        return handle

    class Counting(MessageSink):
        def refine(self, kind: str, rows: DataFrame, batch_id: int) -> None:
            self.land(self.handlers[kind](rows), f"seen/{kind}", F.to_date("load_time"), batch_id)

    sink = Counting(f"{root}/out", kinds=wanted, handlers={k: keep(k) for k in wanted})
    stream = read_message_stream(t.spark, "text", {"path": f"{root}/in"})
    start_ingest(stream, sink, f"{root}/checkpoint", drain=True).awaitTermination()
    found = [t.spark.read.parquet(f"{root}/out/seen/{k}") for k in wanted]
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result.groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


@query("""SELECT order_id, order_line_id AS line_number, CAST(quantity AS VARCHAR) AS quantity,
  'N' || CAST(l_partkey AS VARCHAR) AS product FROM line_base""", uses=["line_base"])
def order_message_lines(t: Inputs) -> DataFrame:
    """The order handler as a batch."""
    return order_rows(_enveloped(_order_messages(t))).select(
        "order_id", "line_number", F.col("line_quantity").alias("quantity"),
        F.col("line_product_product_number").alias("product"))


@query("""SELECT DISTINCT order_id || ' ' AS order_id, 'C1' AS consignment_id, 'CARD' AS payment_type, '1' AS amount,
  md5('A@B.C') AS email FROM line_base""", uses=["line_base"])
def tender_message_rows(t: Inputs) -> DataFrame:
    """Authorizations zipped with transactions; a row without an amount is left out."""
    rows = tender_rows(_enveloped(_order_messages(t)))
    return rows.select("order_id", "consignment_id", F.col("authorization_payment_type").alias("payment_type"),
                       F.col("transaction_amount").alias("amount"),
                       F.col("authorization_attributes_email").alias("email"))


def _refund_like(kind: str, group: str, extra: str) -> str:
    return f"""SELECT to_json(named_struct('messageType', '{kind}', 'orderId', order_id, 'postedAt', 'now', {extra}
      'order', named_struct('orderHeader', named_struct('orderDateTime', '2024-01-05 10:00:00', 'companyNumber',
      org_id), '{group}', array(named_struct('status', 'OPEN', 'companyNumber', org_id, 'refundNum', 'N1',
      'returnNum', 'N1', 'exchangeNum', 'N1', LINES))))) AS json FROM {{line_base}} GROUP BY order_id, org_id"""


_LINES = """sort_array(collect_list(named_struct('lineNumber', order_line_id, 'quantity', CAST(quantity AS STRING),
  'product', named_struct('sku', item_id))))"""
_LINE_CHECK = """SELECT order_id, org_id AS company, order_line_id AS line_number, CAST(quantity AS VARCHAR) AS quantity,
  item_id AS sku FROM line_base"""


@query(_LINE_CHECK, uses=["line_base"])
def refund_message_lines(t: Inputs) -> DataFrame:
    text = _refund_like("REFUND", "refunds", "'refundId', 'R', ").replace("LINES", f"'lines', {_LINES}")
    return refund_rows(_enveloped(t.sql(text))).select(
        "order_id", F.col("refund_company_number").alias("company"), "line_number", "quantity",
        F.col("product_sku").alias("sku"))


@query(_LINE_CHECK, uses=["line_base"])
def return_message_lines(t: Inputs) -> DataFrame:
    text = _refund_like("RETURN", "returns", "'returnId', 'R', ").replace("LINES", f"'lines', {_LINES}")
    return return_rows(_enveloped(t.sql(text))).select(
        "order_id", F.col("return_company_number").alias("company"), "line_number", "quantity",
        F.col("product_sku").alias("sku"))


@query(_LINE_CHECK, uses=["line_base"])
def exchange_message_lines(t: Inputs) -> DataFrame:
    groups = f"'fullfillmentGrouping', array(named_struct('shipMethod', 'Z', 'orderLines', {_LINES}))"
    text = _refund_like("EXCHANGE", "exchanges", "'exchangeId', 'X', ").replace("LINES", groups)
    return exchange_rows(_enveloped(t.sql(text))).select(
        "order_id", F.col("company_number").alias("company"), "line_number", "quantity",
        F.col("product_sku").alias("sku"))


@query("""SELECT order_id, 'C' || order_id AS consignment_id, CASE WHEN is_gift_card = 1 THEN CAST(l_partkey AS
  VARCHAR) END AS gift_card_number, CASE WHEN is_gift_card = 1 THEN '50.5' END AS gift_card_amount FROM line_base""",
       uses=["line_base"])
def consignment_message_rows(t: Inputs) -> DataFrame:
    """Entries without gift-card metadata keep their consignment."""
    text = """SELECT to_json(named_struct('messageType', 'CONSIGNMENT', 'orderId', order_id, 'order', named_struct(
      'orderHeader', named_struct('companyNumber', org_id)), 'consignment', named_struct('consignmentId',
      concat('C', order_id), 'consignmentEntries', collect_list(named_struct('sku', item_id, 'metadata',
      CASE WHEN is_gift_card = 1 THEN concat('[{{"cardNumber":', CAST(l_partkey AS STRING),
      ',"transactionAmount":50.5}}]') END))))) AS json FROM {line_base} GROUP BY order_id, org_id"""
    rows = consignment_rows(_enveloped(t.sql(text)))
    return rows.select("order_id", "consignment_id", "gift_card_number", "gift_card_amount")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS order_id, 'REF' || CAST(o_orderkey AS VARCHAR) AS cegr_ref_id,
  CAST(o_orderdate AS DATE) AS chargeback_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount
  FROM orders""")
def chargeback_message_rows(t: Inputs) -> DataFrame:
    text = """SELECT to_json(named_struct('messageType', 'CHARGEBACK', 'OrderId', CAST(o_custkey AS STRING),
      'chargebacks', named_struct('totalDisputedAmount', '1', 'chargebackHistory', collect_list(named_struct(
      'cegrRefId', concat('REF', CAST(o_orderkey AS STRING)), 'amount', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS
      STRING), 'date', date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')))))) AS json FROM {orders} GROUP BY o_custkey"""
    return chargeback_rows(_enveloped(t.sql(text))).select("order_id", "cegr_ref_id", "chargeback_date", "amount")


@query("""SELECT CAST(o_custkey % 300 AS VARCHAR) AS order_id, 'REF' || CAST(o_custkey AS VARCHAR) AS cegr_ref_id,
  CAST(max(o_orderdate) AS DATE) AS chargeback_date FROM orders GROUP BY o_custkey""")
def upsert_chargebacks(t: Inputs) -> DataFrame:
    """Newest chargeback per order and reference, upserted in two loads."""
    rows = t["orders"].select(
        (F.col("o_custkey") % 300).cast("string").alias("order_id"),
        F.concat(F.lit("REF"), F.col("o_custkey").cast("string")).alias("cegr_ref_id"),
        F.to_date("o_orderdate").alias("chargeback_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("chargeback_ts"), "o_orderkey")
    table = BucketTable(t.spark, new_folder(t, "chargebacks"), ["order_id", "cegr_ref_id"], buckets=8)
    for part in (1, 0):
        upsert_table(table, rows.filter(F.col("o_orderkey") % 2 == part), ["order_id", "cegr_ref_id"],
                     "chargeback_ts", tie_break=["o_orderkey"])
    return table.read().select("order_id", "cegr_ref_id", "chargeback_date")


