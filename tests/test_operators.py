from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import aggregate as G
from orderloom.operators import joins as J
from orderloom.operators import latest as W
from orderloom.operators import nested as N
from orderloom.sources import tables as S
from tests.conftest import plan_of


@pytest.fixture()
def skewed(spark):
    """One key holds a third of the rows; one key is null."""
    rng = random.Random(7)
    keys = [1] * 300 + [None] * 100 + [rng.randint(2, 60) for _ in range(500)]
    data = [(k, i, rng.choice("abc"), rng.randint(0, 9)) for i, k in enumerate(keys)]
    return spark.createDataFrame(data, "k int, id int, s string, n int").repartition(4)


def test_latest_limits_groups_before_the_shuffle(skewed, rows):
    latest = W.latest_per_key(skewed, ["k"], W.newest("n", "id"))
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    best = {}
    for k, i, _, n in rows(skewed):
        best[k] = max(best.get(k, (-1, -1)), (n, i))
    assert {(r.k, r.n, r.id) for r in latest.collect()} == {(k, *v) for k, v in best.items()}


def test_missing_values_come_last(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (2, None, 3)], "k int, v int, id int")
    assert rows(W.latest_per_key(df, ["k"], W.newest("v", "id")), "k", "id") == [(1, 2), (2, 3)]
    assert rows(W.latest_per_key(df, ["k"], [*W.oldest("v"), F.col("id")]), "k", "id") == [(1, 2), (2, 3)]


def test_spread_keeps_every_row_and_null_keys(skewed, rows):
    spread = W.with_distinct_count(skewed, ["k"], F.col("s"), "kinds")
    assert spread.count() == skewed.count()
    assert spread.filter("k IS NULL AND kinds IS NULL").count() == 0
    assert "Window" not in plan_of(spread)


def test_packed_arrays_hold_everything_in_order(skewed):
    """One row per key, also for a key with a third of all rows and for the null key."""
    packed = G.pack_ordered(skewed, ["k"], {"n": F.col("n"), "id": F.col("id")}, F.struct("n", "id"), "items")
    got = {r.k: [(i.n, i.id) for i in r["items"]] for r in packed.collect()}
    want = {}
    for r in skewed.collect():
        want.setdefault(r.k, []).append((r.n, r.id))
    assert got == {k: sorted(v) for k, v in want.items()}
    assert packed.count() == len(want)


def test_union_arrays_keeps_the_highest_multiplicity(spark, rows):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (1, ["a", "c"]), (2, []), (3, ["z", None, None])],
                               "k int, v array<string>")
    got = {r.k: list(r.all) for r in G.union_arrays(df, ["k"], "v", "all").collect()}
    assert got[1] == ["a", "a", "b", "c"]
    assert 2 not in got
    assert sorted(got[3], key=str) == [None, None, "z"]


def test_notes_become_one_object(spark):
    df = spark.createDataFrame([(1, "B", "x"), (1, "A", "y"), (1, "A", "z"), (2, None, "q")],
                               "k int, kind string, text string")
    got = G.pivot_notes(df, ["k"], F.lower("kind"), F.col("text"), "notes").collect()
    assert [(r.k, r.notes) for r in got] == [(1, '[{"a":"z","b":"x"}]')]


def test_payment_rule(spark, rows):
    df = spark.createDataFrame([("i1", "t1", 5, 9), ("i1", "t1", 6, 9), ("i2", "t1", 5, 9), ("i2", "t2", 6, None),
                                ("i3", "t1", 7, None)], "inv string, txn string, amt int, total int")
    got = G.single_transaction_amount(df, ["inv"], F.col("txn"), "total", "amt")
    assert rows(got, "inv", "txn", "amt") == [("i1", "t1", 9), ("i1", "t1", 9), ("i2", "t1", 5), ("i2", "t2", 6),
                                             ("i3", "t1", 7)]


def test_fan_out(spark):
    df = spark.createDataFrame([(1, [[1, 2], []]), (2, []), (3, None)], "id int, a array<array<int>>")
    kept = N.fan_out(df, [("a", "b"), ("b", "c")])
    assert sorted((r.id, r.c or 0) for r in kept.collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (3, 0)]
    dropped = N.fan_out(df, [("a", "b"), ("b", "c")], keep_empty=False)
    assert sorted((r.id, r.c) for r in dropped.collect()) == [(1, 1), (1, 2)]


def test_zip_rows_of_different_length(spark, rows):
    df = spark.createDataFrame([(1, ["a", "b"], [10])], "id int, x array<string>, y array<int>")
    assert rows(N.zip_rows(df, ["id"], x="x", y="y")) == [(1, "a", 10), (1, "b", None)]


def test_lookup_join_broadcasts_only_small_tables(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    table = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(J.lookup_join(big, table, ["k"]))
        assert "BroadcastHashJoin" not in plan_of(J.lookup_join(big, table, ["k"], limit=8))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_anti_join_with_null_keys(spark, rows):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    other = spark.createDataFrame([(None,)], "k int")
    assert rows(J.drop_matching_null_safe(left, other, ["k"])) == [(1,)]
    assert rows(J.drop_matching(left, other, ["k"])) == [(None,), (1,)]


def test_increment_filter_reaches_the_scan(spark, tmp_path):
    from datetime import datetime, timedelta
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id) AS ts, id, id AS unused "
              "FROM range(30)").write.parquet(path)
    df = S.read_increment(spark.read.parquet(path), "ts", datetime(2024, 1, 10), timedelta(days=2)).select("id", "ts")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in plan
    assert "unused" not in plan
    assert df.count() == 23


def test_align_and_union(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    assert S.align_columns(a, ["s", "missing", "id"]).columns == ["s", "missing", "id"]
    assert rows(S.align_columns(a, ["s", "missing", "id"])) == [("x", None, 1)]


def test_project_variant_types(spark, rows):
    df = spark.createDataFrame([('{"a":"1","b":[1,2],"c":"no"}',), ("broken",)], "value string")
    got = S.project_variant(df, "value", {"a": "int", "b": "variant", "c": "double"})
    assert rows(got) == [(None, None, None), (1, "[1,2]", None)]
