"""Bucketed commits, type-2 loads, batch mart loads, and what they stand on."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderloom.functions.device import device_class
from orderloom.operators import history as H
from orderloom.operators import quality as Q
from orderloom.operators.audit import AuditLog
from orderloom.operators.merge import upsert_pruned, upsert_table
from orderloom.plans import availability as V
from orderloom.plans import gold as G
from orderloom.plans.agents import add_device_class, agent_table, learn_agents
from orderloom.plans.mart_load import MartJob, MartLoad, without_addresses
from orderloom.sources.buckets import BUCKET, BucketTable, ConcurrentCommit
from orderloom.sources.schemas import SchemaConflict
from orderloom.sources.tables import append_partitioned, read_evolved
from orderloom.streaming.ingest import start_ingest

DAYS = [datetime(2024, 1, d) for d in range(1, 10)]


def files_of(path):
    """Bucket to the names of its newest data files."""
    found = {}
    for folder in sorted(path.glob(f"v*/{BUCKET}=*")):
        found[folder.name] = sorted(str(f.relative_to(path)) for f in folder.glob("*.parquet"))
    return found


# Buckets ----------------------------------------------------------------------------

def test_a_commit_leaves_other_buckets_alone(spark, tmp_path, rows):
    path = tmp_path / "t"
    table = BucketTable(spark, str(path), ["k"], buckets=8)
    start = spark.createDataFrame([(i, "a") for i in range(40)] + [(None, "n")], "k int, v string")
    upsert_table(table, start, ["k"], "v")
    before = files_of(path)
    change = spark.createDataFrame([(7, "b"), (100, "new")], "k int, v string")
    touched = {f"{BUCKET}={b}" for b in table.buckets_of(change)}
    reader = table.read()  # begun before the commit
    upsert_table(table, change, ["k"], "v")
    after = files_of(path)
    assert {b for b in before if after[b] != before[b]} <= touched and len(touched) < 8
    assert rows(table.read()) == sorted([(i, "b" if i == 7 else "a") for i in range(40)] + [(None, "n"), (100, "new")],
                                        key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert reader.filter("k = 7").first().v == "a" and reader.count() == 41
    assert upsert_table(table, change, ["k"], "v").count() == 42


def test_a_pinned_version_stays_as_it_was(spark, tmp_path, rows):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=2, keep=3)
    for v in (1, 2, 3):
        upsert_table(table, spark.createDataFrame([(1, v), (v + 10, v)], "k int, v int"), ["k"], "v")
    assert rows(table.read(version=2)) == [(1, 2), (11, 1), (12, 2)]
    assert rows(table.read(version=1)) == [(1, 1), (11, 1)]
    assert table.read().count() == 4


def test_of_two_writers_one_waits(spark, tmp_path, rows):
    first = BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    upsert_table(first, spark.createDataFrame([(1, 1)], "k int, v int"), ["k"], "v")
    second = BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    base = second.version()
    upsert_table(first, spark.createDataFrame([(1, 2)], "k int, v int"), ["k"], "v")
    late = spark.createDataFrame([(1, 3)], "k int, v int")
    with pytest.raises(ConcurrentCommit):
        second.commit(late, second.buckets_of(late), base)
    assert rows(second.read()) == [(1, 2)]
    upsert_table(second, late, ["k"], "v")  # reads again and wins
    assert rows(first.read()) == [(1, 3)]
    with pytest.raises(ValueError):
        BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=3).commit(late, [0], 3)


def test_a_bucket_may_lose_all_rows(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    data = spark.createDataFrame([(i,) for i in range(20)], "k int")
    table.commit(data, range(4), 0)
    table.commit(data.filter(table.bucket() != 2), range(4), 1)
    assert table.read([2]).count() == 0 and table.read().count() == data.filter(table.bucket() != 2).count()
    for n in range(2, 6):
        table.commit(data.filter(table.bucket() == 1), [1], n)
    assert [n for n in table.versions() if (tmp_path / "t" / f"v{n:010d}" / f"{BUCKET}=1").exists()] == [5, 6]  # the others are gone
    assert table.read().count() == data.filter(table.bucket() != 2).count()


def test_columns_grow_and_types_widen(spark, tmp_path, rows):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    upsert_table(table, spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"), ["k"], "v")
    upsert_table(table, spark.createDataFrame([(2, 3_000_000_000, "x")], "k int, v long, w string"), ["k"], "v")
    assert rows(table.read()) == [(1, 1, None), (2, 3_000_000_000, "x")]
    with pytest.raises(SchemaConflict):
        table.commit(spark.createDataFrame([(1, "text")], "k int, v string"), [0, 1, 2, 3], table.version())
    path = str(tmp_path / "sink")
    append_partitioned(spark.createDataFrame([(1, 1, "d")], "k int, v int, day string"), path, ["day"], evolve=True)
    append_partitioned(spark.createDataFrame([(2, 2, 0.5, "d")], "k int, v long, x double, day string"), path, ["day"], evolve=True)
    assert rows(read_evolved(spark, path), "k", "v", "x", "day") == [(1, 1, None, "d"), (2, 2, 0.5, "d")]
    before = len(list((tmp_path / "sink").rglob("*.parquet")))
    with pytest.raises(SchemaConflict):
        append_partitioned(spark.createDataFrame([(3, "v", "d")], "k int, v string, day string"), path, ["day"], evolve=True)
    assert len(list((tmp_path / "sink").rglob("*.parquet"))) == before


def test_stream_writes_only_touched_buckets(spark, tmp_path, rows):
    path = tmp_path / "latest"
    table = BucketTable(spark, str(path), ["k"], buckets=16)

    def load(batch, batch_id):
        upsert_table(table, batch.selectExpr("cast(value as int) % 100 as k", "cast(value as int) as v"), ["k"], "v")

    def feed(values, name):
        spark.createDataFrame([(str(v),) for v in values], "value string").coalesce(1).write.text(str(tmp_path / "in" / name))

    def drain():
        stream = spark.readStream.format("text").option("recursiveFileLookup", "true").load(str(tmp_path / "in"))
        start_ingest(stream, load, str(tmp_path / "checkpoint"), drain=True).awaitTermination()

    feed(range(100), "a")
    drain()
    before = files_of(path)
    feed([105, 207], "b")
    drain()
    after = files_of(path)
    assert 1 <= sum(after[b] != before[b] for b in before) <= 2
    assert rows(table.read().filter("k in (5, 6, 7)")) == [(5, 105), (6, 6), (7, 207)]


def test_pruned_upsert_finds_keys_older_than_the_bound(spark, tmp_path, rows):
    path = str(tmp_path / "orders")
    append_partitioned(spark.createDataFrame([(1, "old", "20240101"), (2, "b", "20240101")], "k int, v string, day string"),
                       path, ["day"])
    source = spark.createDataFrame([(1, "new", "20240301")], "k int, v string, day string")
    got = upsert_pruned(spark, path, source, ["k"], "day", "20240201")
    assert rows(got, "k", "v") == [(1, "new"), (2, "b")]


def test_publishing_again_leaves_the_history(spark, tmp_path):
    target = BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    batch = spark.createDataFrame([(1, "2024-01-01", DAYS[0])], "k int, update_time string, load_ts timestamp_ntz")
    for _ in range(2):
        V.load_published(batch, target, str(tmp_path / "history"), ["k"], batch=1)
    V.load_published(batch, target, str(tmp_path / "history"), ["k"], batch=2)
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2 and target.read().count() == 1


# Loads ------------------------------------------------------------------------------

def supply_tables(spark, supply, allocations):
    return {"supply": spark.createDataFrame(supply, "pk string, supply_type string, quantity int, location_id string, "
                                                    "src_load_ts timestamp_ntz"),
            "supply_allocations": spark.createDataFrame(allocations, "supply_pk string, pk int, allocated_quantity int, "
                                                                     "updated_timestamp timestamp_ntz, src_load_ts timestamp_ntz"),
            "locations": spark.createDataFrame([("l", "Store", "s", "Y")], "location_id string, location_type_id string, "
                                                                          "location_sub_type_id string, active_flg string")}


def test_a_late_detail_reloads_its_key_and_no_other(spark, tmp_path):
    model = G.inventory_supply()
    early = DAYS[0] - timedelta(hours=1)
    first = supply_tables(spark, [(str(i), "In Transit", i, "l", early if i else DAYS[0]) for i in range(6)],
                          [(str(i), i, 1, None, early) for i in range(6)])
    loader = G.GoldLoader(spark, str(tmp_path), first, buckets=16)
    loader.run(model, 1, DAYS[1])
    # one more allocated, one supply gone; the allocation's supply row itself has not changed
    second = supply_tables(spark, [(str(i), "In Transit", i, "l", early if i else DAYS[0]) for i in range(5)],
                           [(str(i), i, 1, None, early) for i in range(6) if i != 2] + [("2", 2, 9, DAYS[2], DAYS[2])])
    loader.tables = second
    new = G.increments(model, second, "src_load_ts", DAYS[0], timedelta(0))
    # the row at the watermark is read again, as more of its kind may have come since
    assert sorted(r.supply_pk for r in G.changed_keys(model, second, new).collect()) == ["0", "2"]
    result = loader.run(model, 2, DAYS[3])
    table = loader.table(model).read()
    assert sorted((r.supply_pk, r.allocated_quantity, r.active_flg, r.end_ts or DAYS[8]) for r in table.collect()) == [
        ("0", 1, "Y", DAYS[8]), ("1", 1, "Y", DAYS[8]), ("2", 1, "N", DAYS[3]), ("2", 9, "Y", DAYS[8]), ("3", 1, "Y", DAYS[8]),
        ("4", 1, "Y", DAYS[8]), ("5", 1, "N", DAYS[3])]
    assert len(result.buckets) <= 3
    untouched = table.filter("supply_pk in ('1', '3', '4')")
    assert {r.etl_updt_ts for r in untouched.collect()} == {DAYS[1]}
    again = loader.run(model, 3, DAYS[4])
    assert again.processed == DAYS[2] and loader.table(model).read().count() == table.count()
    assert [r.status for r in loader.audit.runs().collect()] == ["success"] * 3


def test_a_failed_load_keeps_its_watermark(spark, tmp_path):
    model = G.inventory_supply()
    good = supply_tables(spark, [("1", "Other", 1, "l", DAYS[0])], [("1", 1, 1, None, DAYS[0])])
    loader = G.GoldLoader(spark, str(tmp_path), good, buckets=2)
    loader.run(model, 1, DAYS[1])
    loader.tables = {**good, "locations": good["locations"].drop("location_sub_type_id")}
    with pytest.raises(Exception):
        loader.run(model, 2, DAYS[2])
    assert loader.audit.watermark(model.name, "INCREMENTAL") == DAYS[0]
    assert loader.table(model).version() == 1


def test_every_model_names_columns_that_are_linked(spark):
    for model in G.gold_models("initial"):
        tables = {i.table: i for i in model.inputs}
        for one in model.inputs:
            if one.via is not None:
                assert one.via in tables and len(one.on) == len(one.link)
            else:
                assert len(one.link) == len(model.scope)
    assert len({m.name for m in G.gold_models("initial")}) == 19


def test_state_batches_in_any_order(spark, tmp_path, rows):
    changes = spark.createDataFrame(
        [(1, "a", 1, "insert"), (1, "b", 2, "insert"), (2, "a", 1, "insert"), (2, None, 5, "IncrementalDeleteRows"),
         (2, "c", 3, "insert"), (3, "a", 1, "IncrementalDeleteRows"), (3, "b", 4, "insert"), (1, "a", 6, "insert"),
         (None, " ", 1, "insert")], "pk int, status string, seen int, event_type string")
    order = ["seen"]
    want = rows(H.drop_deleted(H.state_history(changes, ["pk"], ["status"], order), changes, ["pk"], order))
    for n, turn in enumerate(([0, 1, 2], [2, 1, 0, 1], [1, 2, 2, 0])):
        table = BucketTable(spark, str(tmp_path / str(n)), ["pk"], buckets=2)
        for part in turn:
            got = H.merge_states(table, changes.filter(F.col("seen") % 3 == part), ["pk"], ["status"], order)
        assert rows(got, *changes.columns) == want


def test_journals_fail_alone(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path / "audit"))
    specs = []
    for n in range(3):
        spark.createDataFrame([(n, DAYS[n])], "pk int, seen_at timestamp_ntz").write.parquet(str(tmp_path / f"j{n}"))
        specs.append(H.JournalSpec(str(tmp_path / f"j{n}"), str(tmp_path / f"a{n}")))
    specs.append(H.JournalSpec(str(tmp_path / "none"), str(tmp_path / "a3")))
    for _ in range(2):
        found = H.archive_all(spark, specs, log)
        assert [error is None for error in found.values()] == [True, True, True, False]
    assert [spark.read.parquet(str(tmp_path / f"a{n}")).count() for n in range(3)] == [1, 1, 1]
    assert [log.watermark(s.source, "INCREMENTAL") for s in specs[:3]] == DAYS[:3]


def test_a_hot_key_is_closed_in_ranges(spark, tmp_path, rows):
    data = [("hot" if i % 3 else f"k{i % 5}", str(i), DAYS[0] + timedelta(minutes=i * 7 % 1000), None, "Y", i % 4) for i in range(600)]
    df = spark.createDataFrame(data, "hash_sk string, hash_seq_num string, start_ts timestamp_ntz, end_ts timestamp_ntz, "
                                     "active_flg string, batch_id int")
    staged = []

    def stage(frame):
        frame.write.parquet(str(tmp_path / "ranges"))
        staged.append(spark.read.parquet(str(tmp_path / "ranges")))
        return staged[0]

    assert rows(H.scd2_close_spread(df, stage, parts=8), *df.columns) == rows(H.scd2_close(df), *df.columns)
    sizes = [r["count"] for r in staged[0].groupBy("_range").count().collect()]
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_gate_stops_at_severe_failures(spark):
    tables = {"t": spark.createDataFrame([(1, None)], "k int, v string")}
    rule = ("R1", "Not Null", "G", "t", ["v"], ["k"], "HIGH", None, "Y")
    rules = Q.rules_from_rows(spark.createDataFrame([rule], Q.RULE_ROWS))
    with pytest.raises(Q.QualityStop, match="R1 on t: 1"):
        Q.gate(Q.run_rules(tables, rules))
    assert Q.gate(Q.run_rules(tables, rules), stops=("FATAL",)).count() == 1
    with pytest.raises(ValueError):
        Q.rules_from_rows(spark.createDataFrame([("R2", "No such rule", *rule[2:])], Q.RULE_ROWS))


# Marts ------------------------------------------------------------------------------

def test_agents_are_classified_once(spark, tmp_path, rows):
    table = agent_table(spark, str(tmp_path / "agents"), buckets=2)
    orders = spark.createDataFrame([(1, "Mozilla (iPhone)"), (2, "Windows NT"), (3, None), (4, " ")], "o int, user_agent string")
    agents = learn_agents(table, orders)
    assert rows(add_device_class(orders, agents), "o", "device_class") == [(1, "MOBILE"), (2, "PC"), (3, None), (4, None)]
    version = table.version()
    learn_agents(table, orders)
    assert table.version() == version  # nothing new, nothing written


@pytest.mark.parametrize("agent,kind", [
    ("Shop/3.1 CFNetwork/1410.0.3 Darwin/22.6.0", "MOBILE"), ("Opera/9.80 (J2ME/MIDP; Opera Mini/7.1)", "MOBILE"),
    ("Mozilla/5.0 (Windows Phone 10.0; Android 6.0.1)", "MOBILE"), ("Mozilla/5.0 (Linux; Android 9; SM-T510)", "TABLET"),
    ("Mozilla/5.0 (PlayBook; U; RIM Tablet OS 2.1.0)", "TABLET"), ("Mozilla/5.0 (Linux; Android 9; KFMAWI Build/PS7)", "TABLET")])
def test_raw_agents_have_a_class(spark, agent, kind):
    assert spark.range(1).select(device_class(F.lit(agent))).first()[0] == kind


def test_mart_halves_fail_and_catch_up(spark, tmp_path, rows):
    data = spark.createDataFrame([(1, "a@b.C ", "2024-01", DAYS[0]), (2, "x", "2024-01", DAYS[2])],
                                 "k int, email string, order_month string, load_ts timestamp_ntz")
    broken, seen = [], []

    def build(since):
        seen.append(since)
        return data.filter(F.col("load_ts") >= F.lit(since).cast("timestamp_ntz")) if len(seen) > 1 else data.filter("k = 1")

    def landing(df):
        if broken:
            raise RuntimeError("out of reach")
        return df

    load = MartLoad(spark, str(tmp_path), ["k"], build, (MartJob("refined", without_addresses), MartJob("landing", landing)))
    assert {o.inserted for o in load.run("FULL").values()} == {1}
    broken.append(1)
    outcome = load.run()
    assert (outcome["refined"].status, outcome["landing"].status) == ("success", "failed")
    assert load.watermarks("INCREMENTAL") == {"refined": DAYS[2], "landing": DAYS[0]}
    broken.clear()
    outcome = load.run()
    assert seen[2] == DAYS[0]  # the earlier of the two
    assert (outcome["refined"].inserted, outcome["refined"].updated, outcome["landing"].inserted) == (0, 2, 1)
    refined, raw = (spark.read.parquet(load.path(j)) for j in load.jobs)
    assert rows(raw, "k", "email") == [(1, "a@b.C "), (2, "x")]
    assert refined.filter("email like '%@%'").count() == 0 and refined.count() == 2
    assert sorted(r.status for r in load.audit.runs().collect()) == ["failed"] + ["success"] * 5
