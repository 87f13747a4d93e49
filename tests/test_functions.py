from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from orderloom.functions import codes
from orderloom.functions import consignment as K
from orderloom.functions.device import device_breakdown, device_class
from orderloom.functions.keys import check_digit, email_hash, hash_key, sellable_key, sku_with_check_digit
from orderloom.functions.text import iso_text, json_field, safe_number, safe_timestamp, status_or_null


def one(spark, column, **values):
    fields = ", ".join(f"{name} string" for name in values) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or (None,)], fields)
    return df.select(column.alias("v")).first()["v"]


def digit_by_hand(text: str) -> int:
    total = 0
    for place, ch in enumerate(text, start=1):
        n = int(ch) if place % 2 == 0 else int(ch) * 2
        total += n - 9 if n > 9 else n
    return (10 - total % 10) % 10


@pytest.mark.parametrize("sku", ["0", "7", "18", "905", "123456", "99999999999999999999999", "000", "4000000000"])
def test_check_digit(spark, sku):
    assert one(spark, check_digit("s"), s=sku) == digit_by_hand(sku)


@pytest.mark.parametrize("sku", ["", "12a", "1-2", None])
def test_check_digit_needs_digits(spark, sku):
    assert one(spark, check_digit("s"), s=sku) is None


def test_sellable_keys(spark):
    assert one(spark, sellable_key("k", "s"), k="12-34-00567-00890", s="12-34-00567") == (
        f"12-34-00567-{digit_by_hand('123400567')}-00-890")
    assert one(spark, sku_with_check_digit("s"), s="12-34-567-01090") == f"12-34-567-{digit_by_hand('123456701')}-01-090"
    assert one(spark, sku_with_check_digit("s"), s="12-34-567") == "12-34-567"
    assert one(spark, sku_with_check_digit("s"), s=" ") is None


def test_hash_tells_null_from_empty_and_shifts(spark):
    def key(a, b):
        return one(spark, hash_key(["a", "b"]), a=a, b=b)

    assert len({key(None, "x"), key("", "x"), key("x", None), key("x", ""), key("xx", "")}) == 5
    assert key("a", "b") == hashlib.sha256(b"a\x01b").hexdigest()


def test_email_hash_folds_case_and_blanks(spark):
    assert one(spark, email_hash("e"), e=" Ann@X.org ") == hashlib.md5(b"ANN@X.ORG").hexdigest()
    assert one(spark, email_hash("e"), e=None) is None


def test_conversions_never_fail(spark):
    assert one(spark, safe_number("v", "int"), v="x") is None
    assert one(spark, safe_timestamp("v"), v="no time") is None
    assert one(spark, status_or_null("v"), v="3000.000") == 3000
    assert one(spark, status_or_null("v"), v="") is None
    assert one(spark, json_field("v", "extend::FLX-ID"), v='{"extend::FLX-ID":"7"}') == "7"
    assert one(spark, iso_text(F.to_timestamp_ntz("v"), "000000Z"), v="2024-01-02 03:04:05.678") == (
        "2024-01-02T03:04:05.678000000Z")


def test_codes_fall_back(spark):
    assert one(spark, codes.company_number("o"), o=" FL-US ") == "21"
    assert one(spark, codes.company_number("o"), o="XX") is None
    assert one(spark, codes.order_status("s", "d"), s="4242", d="odd") == "ODD"
    assert one(spark, codes.mart_order_status("s", "d", F.lit(1)), s="1500", d="x") == "SUBMITTED"
    assert one(spark, codes.mart_order_status("s", "d", F.lit(1)), s="7000", d="x") == "FRAUD_CHECK_FAILED"
    assert one(spark, codes.published_channel("c", codes.NETWORK_CHANNELS), c="CH-US-BOPIS") == (
        "CHP_US_RETAIL")
    assert one(spark, codes.published_channel("c", codes.NETWORK_CHANNELS), c="CH-CA-BOPIS") == (
        "CH-CA-BOPIS")


@pytest.mark.parametrize("org, reason, code, number", [
    ("CH-US", "boss wrong item", "BW", 390), ("KFL-US", "WRONG ITEM ORDERED", "WO", 292),
    ("CH-CA", "Return", "IS", 553), ("FL-CA", "too wide", "TW", 350), ("FL-US", "wrong color", "PC", None),
    ("FL-US", "COLOR MISMATCH", "PC", 306), ("FL-US", "999-other", "999", 787), ("FL-US", "516-none", None, None),
    ("CH-US", "501-worn", None, None), ("FL-US", "XSTORE RETURN", "XX", 762), ("CH-US", "XSTORE RETURN", "XX", None),
    ("FL-US", "EB4KIDS FIT GUARNTEE", "FG", None), ("XX", "Return", None, None)])
def test_return_reasons(spark, org, reason, code, number):
    assert one(spark, codes.return_reason_code("o", "r"), o=org, r=reason) == code
    assert one(spark, codes.return_reason_number("o", "r"), o=org, r=reason) == number


def test_partial_steps(spark):
    def label(kind, status, lost):
        return one(spark, K.history_label(F.lit(kind), F.lit(status), F.lit("odd"), F.lit(lost)))

    assert label(K.WAREHOUSE, 3600, 0) == "PICKED"
    assert label(K.WAREHOUSE, 3600, 2) == "PARTIALLY_PICKED"
    assert label(K.STORE, 6000, 2) == "FULFILLED"
    assert label(K.STORE, 5000, 2) == "PARTIALLY_FULFILLED"
    assert label(K.REJECTED, 3500, 0) == "ODD"
    assert one(spark, K.history_code(F.lit(K.STORE), F.lit(4500), F.lit(0))) == "2050"
    assert one(spark, K.history_code(F.lit(K.STORE), F.lit(4242), F.lit(0))) == "4242"


@pytest.mark.parametrize("agent, kind", [
    ("Mozilla (iPhone; like Mac OS X)", "MOBILE"), ("Mozilla (iPad; like Mac OS X)", "TABLET"),
    ("Mozilla (Macintosh; Mac OS X) Silk", "TABLET"), ("Mozilla (Macintosh; Intel Mac OS X)", "PC"),
    ("X11; CrOS", "PC"), ("CrKey armv7", "OTHER"), ("Linux; Android 9; Mobile", "MOBILE"), ("bot", "OTHER"),
    (None, None), (" ", None)])
def test_device_class(spark, agent, kind):
    assert one(spark, device_class("a"), a=agent) == kind


def test_device_breakdown_keeps_all_rows(spark):
    df = spark.createDataFrame([("iPhone", 1), ("iPhone", 2), (None, 4), ("Windows", 8)], "agent string, n int")
    got = {r.device_class: r.total for r in device_breakdown(df, "agent", {"total": F.col("n")}).collect()}
    assert got == {"MOBILE": 3, "UNKNOWN": 4, "PC": 8}
