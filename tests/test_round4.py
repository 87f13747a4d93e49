"""Whole results and plans that scale, on rows made here."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderloom.operators import history as H
from orderloom.plans import amounts as A
from orderloom.plans import availability as V
from orderloom.plans import gold as G
from orderloom.plans import products as P
from orderloom.plans.consignments import line_versions
from orderloom.plans.payments import transaction_rows
from orderloom.workload import all_queries

ORDERS = ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string, "
          "o_totalprice double")
LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
DAY = datetime(2024, 1, 5)


@pytest.fixture()
def tables(spark, tmp_path):
    """A folder with two orders and four lines, two of which are one availability message key at one time."""
    spark.createDataFrame([(1, 7, "F", DAY, "1-URGENT", 10.5), (3, 8, "O", DAY, "2-HIGH", 4.0)], ORDERS).write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 11, 3, 1, 2.0, 30.0, 0.1, 0.05, "N", "O", DAY), (1, 11, 6, 1, 9.0, 30.0, 0.1, 0.05, "N", "O", DAY),
                           (1, 12, 4, 2, 5.0, 7.0, 0.1, 0.05, "N", "F", DAY), (3, 13, 7, 1, 1.0, 8.0, 0.0, 0.0, "R", "F", DAY)],
                          LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_the_network_load_returns_its_versions(spark, tables):
    """Every version with its key, not a count of them; of two amounts at once the higher one is the newest."""
    found = all_queries()["load_network_availability"](spark, tables)
    assert sorted(found.columns) == ["active_flg", "end_ts", "hash_sk", "start_ts"]
    assert found.count() == found.select("hash_sk").distinct().count() == 3


def test_a_tie_of_network_messages_goes_to_the_higher_amount(spark):
    raw = spark.createDataFrame([(V.NETWORK_FULL, "1", "web", DAY, DAY, DAY, a) for a in (2, 9, None, 5)],
                                "message_type string, item_id string, selling_channel string, updated_ts timestamp_ntz, "
                                "header_ts timestamp_ntz, load_ts timestamp_ntz, atp long")
    raw = raw.withColumns({p: F.lit(1) for p in V.PARTS})
    for part in (raw, raw.orderBy("atp"), raw.orderBy(F.desc("atp"))):
        assert [r.atp for r in V.network_feed(part, V.NETWORK_FULL).collect()] == [9]


def dealt(df) -> int:
    """How many exchanges by hash a plan has."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_merge_deals_out_by_key_once(spark):
    """Also where its rows are flagged by status and keys gone from the source are ended."""
    def staged(rows, day):
        df = spark.createDataFrame(rows, "k int, s string")
        at = F.lit(datetime(2024, 1, day)).cast("timestamp_ntz")
        return H.scd2_stage(df, ["k"], ["s"], at, day, at)

    first = H.scd2_merge(staged([], 1), staged([(1, "a"), (2, "b"), (None, "c")], 1)).localCheckpoint()
    merged = H.scd2_merge(first, staged([(1, "x"), (2, "b")], 2))
    flagged = H.mark_status_history(merged, "s", dealt_by_key=True)
    assert dealt(merged) == dealt(flagged) == 1
    want = H.mark_status_history(merged.localCheckpoint(), "s")
    assert sorted(map(str, flagged.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    gone = first.filter("k = 2").select("hash_sk", "k")
    ended = G._without_gone(merged, gone, G.Deletion("t", "k", "k"), datetime(2024, 1, 3))
    assert {(r.k, r.s): r.active_flg for r in ended.collect()} == {(1, "a"): "N", (1, "x"): "Y", (2, "b"): "N", (None, "c"): "Y"}
    removed = G._without_gone(merged, gone, G.Deletion("t", "k", "k", kind=1), datetime(2024, 1, 3))
    assert sorted(str(r.k) for r in removed.collect()) == ["1", "1", "None"]


def test_staged_rows_are_packed_and_the_setting_is_put_back(spark, tmp_path):
    from orderloom.session import FREE_SHUFFLES, freed_shuffles, write_staged
    before = spark.conf.get(FREE_SHUFFLES, None)
    with freed_shuffles(spark):
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    rows = write_staged(spark.range(1000).repartition(4, "id"), str(tmp_path / "rows"))
    assert rows.count() == 1000 and spark.conf.get(FREE_SHUFFLES, None) == before
    assert all(".zstd." in f.name for f in (tmp_path / "rows").glob("*.parquet"))


def test_large_product_tables_deal_the_lines_out_once(spark, monkeypatch):
    fields = dict.fromkeys((*P.PRODUCT_COLUMNS, "legacy_sku", "legacy_size_code", "legacy_sku_key"), "x")
    kinds = ", ".join(f"`{c}` string" for c in ("banner_id", "global_size_id", *fields))
    rows = [("81", " 1", "p"), ("81", "1 ", "q"), ("98", "1", "r"), ("03", "1", "s"), ("81", None, "t"), ("03", "2", "u")]
    products = spark.createDataFrame([(b, i, v, *list(fields.values())[1:]) for b, i, v in rows], kinds)
    items = spark.createDataFrame([("1", "red"), (" 1", "blue"), (None, "none")], "item_id string, color string")
    lines = spark.createDataFrame([(n, o, i, g) for n, (o, i, g) in enumerate([
        ("FL-US", "1", 0), ("FL-CA", "1", 0), ("FL-US", "1", 1), ("FL-US", "1", None), ("FL-US", None, 0), ("FL-US", "2", 0),
        (None, "1", 0)])], "n int, org_id string, item_id string, is_gift_card int")

    def found(limit):
        monkeypatch.setattr(P, "BROADCAST_LIMIT", limit)
        df = P.add_products(lines, products, items)
        return df, sorted(map(str, df.select(*sorted(df.columns)).collect()))

    _, small = found(10 ** 9)
    df, large = found(0)
    assert small == large and len(small) > 7
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_payments_of_a_line_are_dealt_out_once(spark):
    names = ["org_id", "order_id", "order_line_id", "transaction_id", "transaction_detail_id", "invoice_id", "invoice_line_id",
             "transaction_type", "invoice_line_updated_ts", "load_ts", "payment_line_pk"]
    rows = [("o", "1", "1", t, d, "i", "l", "Settlement", "1", "1", f"{n}", 7, 100) for n, (t, d) in enumerate(
        [("a", "1"), ("a", "1"), ("a", "2")])] + [("o", "1", "2", "b", None, None, None, "Settlement", "1", "1", "9", 7, 100)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names) + ", transaction_amount int, invoice_line_total int")
    got = transaction_rows(df)
    assert dealt(got) == 1
    assert sorted((r.order_line_id, r.transaction_amount, r.transaction_count) for r in got.collect()) == [
        ("1", 7, 2), ("1", 7, 2), ("2", 100, 1)]


def test_first_amounts_stay_with_the_order(spark):
    """A window gives the versions what the join of the first version gave them, without an exchange of its own."""
    amounts = [f"{p}{a}" for a in (*A.PLAIN_AMOUNTS, *A.CAPTURED_AMOUNTS) for p in ("", "cancelled_")]
    amounts += [f"{p}original_{a}" for a in A.CAPTURED_AMOUNTS for p in ("", "cancelled_")]
    df = spark.createDataFrame([("o", "1", "1", "v2", 3000, 2), ("o", "1", "1", "v1", 1000, 1), ("o", "1", "2", "v3", None, 3),
                                ("o", "1", "2", "v4", 2000, 5)],
                               "org_id string, order_id string, order_line_id string, line_version_id string, max_status int, x int")
    df = df.withColumn("updated_ts", F.lit(DAY)).withColumns({c: F.col("x") for c in (
        *amounts, "unit_price", "original_unit_price", "gift_card_value", "is_return")})
    got = A.with_first_amounts(df.repartition("org_id", "order_id"))
    want = df.select(*A.LINE_KEY, "line_version_id").join(A.line_amounts(A.first_line_rows(df)), list(A.LINE_KEY))
    assert dealt(got) == 1
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_line_versions_need_one_exchange(spark):
    df = spark.createDataFrame([("o", "1", "1", f"v{n}", s, None, 0) for n, s in enumerate((1000, 3000, 7000))],
                               "org_id string, order_id string, order_line_id string, line_version_id string, max_status int, "
                               "parent_order_id string, is_even_exchange int").withColumn("updated_ts", F.lit(DAY))
    got = line_versions(df)
    assert dealt(got) == 1
    assert sorted((r.line_version_id, r.is_newest, r.lowest_status) for r in got.collect()) == [
        ("v0", False, 1000), ("v1", False, 1000), ("v2", True, 1000)]
