from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.operators import history as H
from orderloom.operators import quality as Q
from orderloom.operators.audit import AuditLog
from orderloom.operators.merge import load_counts, require_unique, upsert, upsert_newer, upsert_pruned, upsert_table
from orderloom.session import cut_lineage, drop_run_dir, run_dir, shared_dir
from orderloom.sources.snapshots import SnapshotTable
from orderloom.sources.tables import append_partitioned


def stamp(day: int):
    return F.lit(datetime(2024, 1, day)).cast("timestamp_ntz")


def test_upsert_is_idempotent_also_with_null_keys(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (None, "N"), (3, "c")], "k int, v string")
    once = upsert(target, source, ["k"])
    assert rows(once) == [(None, "N"), (1, "a"), (2, "B"), (3, "c")]
    assert rows(upsert(once, source, ["k"])) == rows(once)


def test_upsert_keeps_excluded_columns_and_adds_new_ones(spark, rows):
    target = spark.createDataFrame([(1, "a", 10)], "k int, v string, loaded int")
    source = spark.createDataFrame([(1, "A", 20, "x"), (2, "B", 20, "y")], "k int, v string, loaded int, extra string")
    assert rows(upsert(target, source, ["k"], exclude=["loaded"])) == [(1, "A", 10), (2, "B", 20)]
    assert rows(upsert(target, source, ["k"], evolve=True)) == [(1, "A", 20, "x"), (2, "B", 20, "y")]


def test_late_rows_do_not_win(spark, rows):
    target = spark.createDataFrame([(1, 5, "new")], "k int, ts int, v string")
    source = spark.createDataFrame([(1, 4, "late"), (2, 1, "x"), (2, 3, "y")], "k int, ts int, v string")
    assert rows(upsert_newer(target, source, ["k"], "ts")) == [(1, 5, "new"), (2, 3, "y")]


def test_stamps_that_are_missing_or_equal(spark, rows):
    target = spark.createDataFrame([(1, 5, 2, "kept"), (2, None, 1, "old"), (3, 5, 7, "kept"), (4, 5, None, "old")],
                                   "k int, ts int, n int, v string")
    source = spark.createDataFrame([(1, None, 9, "no stamp"), (2, 1, 0, "new"), (3, 5, 6, "earlier"), (4, 5, 1, "new"),
                                    (5, None, None, "first")], "k int, ts int, n int, v string")
    once = upsert_newer(target, source, ["k"], "ts", ["n"])
    assert rows(once, "k", "v") == [(1, "kept"), (2, "new"), (3, "kept"), (4, "new"), (5, "first")]
    assert rows(upsert_newer(once, target, ["k"], "ts", ["n"])) == rows(once)
    assert rows(upsert_newer(once, source, ["k"], "ts", ["n"])) == rows(once)


def test_duplicate_source_keys_fail(spark):
    with pytest.raises(Exception, match="duplicate source keys"):
        require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_load_counts(spark):
    target = spark.createDataFrame([(1,), (None,)], "k int")
    source = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert tuple(load_counts(target, source, ["k"]).first()) == (1, 2)


def test_snapshots_ignore_unfinished_writes(spark, tmp_path, rows):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    for v in range(4):
        table.write(spark.createDataFrame([(v,)], "v int"))
    assert table.versions() == [3, 4]
    (tmp_path / "t" / "v0000000005").mkdir()  # a write that died before its marker
    assert rows(table.read()) == [(3,)]
    upsert_table(table, spark.createDataFrame([(3,), (9,)], "v int"), ["v"])
    assert rows(table.read()) == [(3,), (9,)]


def test_pruned_upsert_leaves_other_partitions_alone(spark, tmp_path, rows):
    path = tmp_path / "orders"
    data = spark.createDataFrame([(1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-03")],
                                 "k int, v string, month string")
    append_partitioned(data, str(path), ["month"])
    before = {m: sorted(p.name for p in (path / f"month={m}").glob("*.parquet"))
              for m in ("2024-01", "2024-02", "2024-03")}
    source = spark.createDataFrame([(3, "C", "2024-03"), (4, "d", "2024-03")], "k int, v string, month string")
    got = upsert_pruned(spark, str(path), source, ["k"], "month", "2024-02")
    assert rows(got, "k", "v") == [(1, "a"), (2, "b"), (3, "C"), (4, "d")]
    after = {m: sorted(p.name for p in (path / f"month={m}").glob("*.parquet")) for m in before}
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] == before["2024-02"]
    assert after["2024-03"] != before["2024-03"]


def test_pruned_upsert_takes_late_rows_and_moves_keys(spark, tmp_path, rows):
    path = tmp_path / "orders"
    data = spark.createDataFrame([(1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-03"), (None, "n", "2024-03")],
                                 "k int, v string, month string")
    append_partitioned(data, str(path), ["month"])
    source = spark.createDataFrame([(1, "late", "2024-01"), (9, "older", "2023-12"), (3, "moved", "2024-04"),
                                    (2, "gone back", "2024-03"), (None, "N", "2024-03")],
                                   "k int, v string, month string")
    for _ in range(2):
        got = upsert_pruned(spark, str(path), source, ["k"], "month", "2024-02")
        assert rows(got, "k", "v", "month") == [
            (None, "N", "2024-03"), (1, "late", "2024-01"), (2, "gone back", "2024-03"), (3, "moved", "2024-04"),
            (9, "older", "2023-12")]
    assert not (path / "month=2024-02").exists()
    with pytest.raises(Exception, match="duplicate source keys"):
        upsert_pruned(spark, str(path), source.union(source), ["k"], "month", "2024-02")


# Type-2 history ---------------------------------------------------------------------

def staged(spark, data, day, batch):
    df = spark.createDataFrame(data, "k int, v string")
    return H.scd2_stage(df, ["k"], ["v"], stamp(day), batch, loaded_at=stamp(day))


def versions(df):
    return sorted((r.k, r.v, r.start_ts.day, r.end_ts.day if r.end_ts else None, r.active_flg) for r in df.collect())


def invariants(df):
    data = [r for r in df.collect()]
    by_key = {}
    for r in data:
        by_key.setdefault(r.hash_sk, []).append(r)
    for group in by_key.values():
        assert sum(r.active_flg == "Y" for r in group) <= 1
        group.sort(key=lambda r: (r.start_ts, r.batch_id))
        for a, b in zip(group, group[1:]):
            assert a.end_ts is not None and a.end_ts <= b.start_ts


def test_type2_versions(spark):
    state = staged(spark, [(1, "a"), (2, "b")], 1, 1)
    state = H.scd2_merge(state, staged(spark, [(1, "x"), (2, "b"), (3, "c")], 2, 2))
    state = H.scd2_merge(state, staged(spark, [(1, "a")], 3, 3))
    invariants(state)
    assert versions(state) == [(1, "a", 1, 2, "N"), (1, "a", 3, None, "Y"), (1, "x", 2, 3, "N"),
                               (2, "b", 1, None, "Y"), (3, "c", 2, None, "Y")]
    assert versions(H.scd2_merge(state, staged(spark, [(1, "a")], 3, 3))) == versions(state)


def test_type2_refresh_keeps_the_start(spark):
    state = staged(spark, [(1, "a")], 1, 1)
    again = H.scd2_merge(state, staged(spark, [(1, "a")], 5, 2)).first()
    assert (again.start_ts.day, again.etl_load_ts.day, again.etl_updt_ts.day, int(again.batch_id)) == (1, 1, 5, 2)


def test_type2_delete_and_return(spark):
    state = staged(spark, [(1, "a"), (2, "b")], 1, 1)
    live = spark.createDataFrame([(2,)], "k int")
    state = H.scd2_delete(state, live, ["k"], stamp(4))
    assert versions(H.scd2_close(state)) == [(1, "a", 1, 4, "N"), (2, "b", 1, None, "Y")]
    back = H.scd2_merge(state, staged(spark, [(1, "a")], 6, 2))
    invariants(back)
    assert versions(back) == [(1, "a", 1, 4, "N"), (1, "a", 6, None, "Y"), (2, "b", 1, None, "Y")]
    assert versions(H.scd1_delete(state, live, ["k"])) == [(2, "b", 1, None, "Y")]


def test_type2_takes_all_versions_of_a_batch_late_ones_and_replays(spark):
    one = staged(spark, [(1, "a")], 1, 1)
    two = staged(spark, [(1, "b")], 4, 2).unionByName(staged(spark, [(1, "c"), (2, "x")], 6, 2))
    state = H.scd2_merge(one.limit(0), one)
    state = H.scd2_merge(state, two)
    want = [(1, "a", 1, 4, "N"), (1, "b", 4, 6, "N"), (1, "c", 6, None, "Y"), (2, "x", 6, None, "Y")]
    invariants(state)
    assert versions(state) == want
    for again in (one, two, one.unionByName(two), staged(spark, [(1, "a")], 2, 3)):
        assert versions(H.scd2_merge(state, again)) == want
    late = H.scd2_merge(state, staged(spark, [(1, "z")], 3, 4))
    invariants(late)
    assert versions(late) == [(1, "a", 1, 3, "N"), (1, "b", 4, 6, "N"), (1, "c", 6, None, "Y"), (1, "z", 3, 4, "N"),
                              (2, "x", 6, None, "Y")]
    together = H.scd2_merge(one.limit(0), two.unionByName(one))
    assert versions(together) == want


def test_type2_leaves_other_keys_alone(spark, tmp_path, rows):
    staged(spark, [(1, "a"), (2, "b")], 1, 1).write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    merged = H.scd2_merge(state, staged(spark, [(1, "x")], 2, 2))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1  # the target is read once
    assert rows(merged.filter("k = 2")) == rows(state.filter("k = 2"))
    got = H.scd2_merge(state.filter("k = 2").withColumn("end_ts", stamp(9)), staged(spark, [(1, "x")], 2, 2))
    assert versions(got) == [(1, "x", 2, None, "Y"), (2, "b", 1, 9, "Y")]  # as it was, though not closed


def test_status_flag_marks_one_version_per_status(spark, rows):
    state = staged(spark, [(1, "a")], 1, 1)
    for day, v in ((2, "b"), (3, "a")):
        state = H.scd2_merge(state, staged(spark, [(1, v)], day, day))
    got = H.mark_status_history(state, "v")
    assert rows(got.select("v", F.dayofmonth("start_ts"), "status_hist_flg")) == [
        ("a", 1, "N"), ("a", 3, "Y"), ("b", 2, "Y")]


def journal(spark, data):
    return spark.createDataFrame([(pk, s, e, n, 0, n, n, n) for pk, s, e, n in data],
                                 "pk int, status string, event_type string, seen_at int, "
                                 "most_significant_position int, least_significant_position int, etl_updt_ts int, "
                                 "n int")


def test_late_changes_do_not_replace_newer_states(spark, rows):
    newest = journal(spark, [(1, "B", "IncrementalUpdate", 9), (2, "x", "IncrementalDeleteRows", 9)])
    late = journal(spark, [(1, "A", "IncrementalUpdate", 2), (2, "A", "IncrementalUpdate", 2)])
    state = H.current_state(newest.limit(0), newest, ["pk"], with_deleted=True)
    assert rows(H.not_deleted(H.current_state(state, late, ["pk"], with_deleted=True)), "pk", "status") == [(1, "B")]


def test_archives_take_rows_at_the_watermark_once(spark, tmp_path):
    schema = "pk int, event_type string, seen_at timestamp_ntz, n int"
    at = datetime(2024, 1, 2, 12)
    source, target = str(tmp_path / "journal"), str(tmp_path / "archive")
    spec = [H.JournalSpec(source, target)]
    spark.createDataFrame([(1, "x", datetime(2024, 1, 1), 1), (2, "x", at, 2)], schema).write.parquet(source)
    H.archive_changes(spark, spec, {})
    spark.createDataFrame([(3, "x", at, 3), (4, "x", datetime(2024, 1, 3), 4)], schema).write.mode("append").parquet(source)
    for _ in range(2):
        H.archive_changes(spark, spec, {source: at})
        assert sorted(r.pk for r in spark.read.parquet(target).collect()) == [1, 2, 3, 4]


def test_current_state_and_deletes(spark, rows):
    changes = journal(spark, [(1, "a", "IncrementalInsertRows", 1), (1, "b", "IncrementalUpdateRows", 2),
                              (2, "a", "IncrementalInsertRows", 1), (2, None, "IncrementalDeleteRows", 3),
                              (3, None, "IncrementalDeleteRows", 1), (3, "z", "IncrementalInsertRows", 2)])
    state = H.current_state(changes.limit(0), changes, ["pk"])
    assert rows(state, "pk", "status") == [(1, "b"), (3, "z")]
    gone = H.current_state(state, journal(spark, [(1, None, "IncrementalDeleteRows", 9)]), ["pk"])
    assert rows(gone, "pk") == [(3,)]
    states = H.state_history(changes, ["pk"], ["status"])
    assert rows(states, "pk", "status") == [(1, "a"), (1, "b"), (2, "a"), (3, "z")]
    assert rows(H.drop_deleted(states, changes, ["pk"]), "pk", "status") == [(1, "a"), (1, "b"), (3, "z")]


def test_blank_state_is_missing_state(spark):
    changes = journal(spark, [(1, " ", "IncrementalInsertRows", 1), (1, None, "IncrementalInsertRows", 2)])
    assert [r.seen_at for r in H.state_history(changes, ["pk"], ["status"]).collect()] == [2]


# Audit and quality ---------------------------------------------------------------------

def test_audit_and_watermarks(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path / "audit"))
    first = datetime(1900, 1, 1)
    assert log.watermark("orders", "INCREMENTAL") == first
    log.start(("orders", "t", "r1", "FULL"), ("lines", "t", "r2", "FULL"))
    assert log.watermark("orders", "INCREMENTAL") == first
    log.success({"r1": datetime(2024, 1, 5), "r2": datetime(2024, 1, 6)})
    log.start(("orders", "t", "r3", "INCREMENTAL"))
    log.failure(["r3"], "it's broken")
    assert log.watermark("orders", "INCREMENTAL") == datetime(2024, 1, 5)
    assert log.watermark("orders", "FULL") == first
    assert {(r.run_id, r.status, r.error_message) for r in log.runs().collect()} == {
        ("r1", "success", None), ("r2", "success", None), ("r3", "failed", "it's broken")}
    with pytest.raises(ValueError):
        log.watermark("orders", "SOME")


def test_quality_counts_and_keys(spark, rows):
    orders = spark.createDataFrame([(1, "A1", "5", "Y", 1), (2, None, "x", "Y", 9), (2, "B22", None, "Y", None),
                                    (2, "B2", "50", "N", 1)],
                                   "id int, code string, n string, active_flg string, cust int")
    tables = {"orders": orders, "cust": spark.createDataFrame([(1,)], "cid int")}
    rules = [Q.NotNull("a", "orders", ("code",), ("id",)), Q.FixedLength("b", "orders", ("code",), ("id",), length=2),
             Q.InRange("c", "orders", ("n",), ("id",), low="1", high="10"),
             Q.NeededWith("d", "orders", ("code",), ("id",), other="n"),
             Q.References("e", "orders", ("cust",), ("id",), parent="cust", parent_columns=("cid",)),
             Q.UniqueKey("f", "orders", ("id",))]
    assert {r.rule_id: r.failing_rows for r in Q.run_rules(tables, rules).collect()} == {
        "a": 1, "b": 1, "c": 2, "d": 1, "e": 1, "f": 1}
    assert rows(rules[2].failing(tables)) == [(2,), (2,)]
    assert rows(rules[5].failing(tables)) == [(2,)]


def test_row_rules_share_one_scan(spark, tmp_path):
    from tests.conftest import plan_of
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "cast(id as string) s").write.parquet(path)
    rules = [Q.NotNull(str(i), "t", ("s",), ("id",)) for i in range(5)]
    plan = plan_of(Q.run_rules({"t": spark.read.parquet(path)}, rules))
    assert plan.count("FileScan") == 1


def test_search_reports_only_hits(spark):
    df = spark.createDataFrame([("Hello", "x"), ("shell", None)], "a string, b string")
    got = Q.search_values({"t": df}, "HELL").collect()
    assert [(r.table_name, r.column_name, r.matching_rows) for r in got] == [("t", "a", 2)]


# Shared folder ----------------------------------------------------------------------------

def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    cut = cut_lineage(spark.range(3).selectExpr("id * 2 AS x"))
    assert sorted(r.x for r in cut.collect()) == [0, 2, 4]
    assert any(Path(shared_dir(spark)).iterdir())


def test_staged_tables_go_with_the_run(spark):
    path = f"{run_dir(spark)}/something"
    spark.range(1).write.parquet(path)
    other = SnapshotTable(spark, f"{shared_dir(spark)}/kept")
    other.write(spark.range(1))
    drop_run_dir(spark)
    assert not Path(run_dir(spark)).exists() and other.read().count() == 1
