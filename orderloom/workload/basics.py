"""Queries over scans, expressions, nested values, joins, aggregations and windows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import codes
from orderloom.functions import consignment as K
from orderloom.functions import text as T
from orderloom.functions.device import device_breakdown
from orderloom.functions.keys import check_digit, email_hash, hash_key, sellable_key, sku_with_check_digit
from orderloom.operators import aggregate as G
from orderloom.operators import joins as J
from orderloom.operators import latest as W
from orderloom.operators import nested as N
from orderloom.plans.amounts import eligible_lines
from orderloom.plans.availability import zero_guarded
from orderloom.plans.fulfilment import supply_buckets
from orderloom.sources import messages as M
from orderloom.sources import tables as S
from orderloom.workload.registry import as_doubles, new_folder, query
from orderloom.workload.standins import Inputs

DAY = timedelta(days=1)


# Sources -------------------------------------------------------------------------

@query("""SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'""")
def scan_recent_lines(t: Inputs) -> DataFrame:
    """Batch scan: two pushed-down things, the filter and the three columns."""
    lines = S.read_table(t.spark, f"{t.sf_dir}/lineitem.parquet",
                         ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])
    return lines.filter(F.col("l_shipdate") >= F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")).drop("l_shipdate")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CAST(NULL AS VARCHAR) AS missing FROM events""")
def project_event_variant(t: Inputs) -> DataFrame:
    return S.project_variant(t["events"], "props", {"k": "int", "missing": "string"}, keep=["event_id"])


@query("""SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-19 00:00:00'""")
def read_event_increment(t: Inputs) -> DataFrame:
    rows = S.read_increment(t["events"], "ts", datetime(2024, 1, 20), DAY)
    return rows.select("event_id", "user_id", "ts")


@query("""SELECT CAST(ts AS DATE) AS load_date, event_type, count(*) AS n FROM events GROUP BY ALL""")
def append_event_history(t: Inputs) -> DataFrame:
    path = new_folder(t, "history")
    S.append_partitioned(t["events"], path, {"load_date": F.to_date("ts")})
    return t.spark.read.parquet(path).groupBy("load_date", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, user_id, ts AS seen_at, CAST(NULL AS VARCHAR) AS note FROM events""")
def align_event_columns(t: Inputs) -> DataFrame:
    return S.align_columns(t["events"].withColumnRenamed("ts", "seen_at"), ["event_id", "user_id", "seen_at", "note"])


@query("""SELECT event_id, event_type, ts FROM events WHERE
  (event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-24')
  OR (event_type NOT IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-23')""")
def union_event_feeds(t: Inputs) -> DataFrame:
    today = datetime(2024, 1, 25)
    delta = t["events"].filter(F.col("event_type").isin("click", "view"))
    full = t["events"].filter(~F.col("event_type").isin("click", "view"))
    return S.union_sources((delta, "ts", today, DAY), (full, "ts", today, 2 * DAY)).select(
        "event_id", "event_type", "ts")


@query("""SELECT event_id, user_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS kind,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
  FROM events""")
def parse_event_messages(t: Inputs) -> DataFrame:
    """JSON text to a typed struct; every tenth text is cut off and gives nulls."""
    text = F.to_json(F.struct(F.col("event_type").alias("kind"), F.struct(
        F.get_json_object("props", "$.k").cast("int").alias("k")).alias("props")))
    broken = F.when(F.col("event_id") % 10 == 0, F.substring(text, 1, 5)).otherwise(text)
    sent = t["events"].select("event_id", "user_id", broken.alias("json"))
    parsed = M.parse_messages(sent, "kind string, props struct<k: int>")
    return parsed.select("event_id", "user_id", F.col("message.kind").alias("kind"),
                         F.col("message.props.k").alias("k"))


# Projections and expressions -----------------------------------------------------

@query("""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS ordered_at,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total,
  coalesce(nullif(o_orderstatus, 'P'), 'open') AS status FROM orders""")
def rename_cast_orders(t: Inputs) -> DataFrame:
    rows = S.rename_and_cast(t["orders"], {
        "order_id": ("o_orderkey", "string"), "ordered_at": ("o_orderdate", "timestamp_ntz"),
        "total": ("o_totalprice", "decimal(18,2)"), "status": ("o_orderstatus", "string"),
        "unused": ("o_custkey", "string")})
    rows = rows.withColumn("status", F.coalesce(F.nullif("status", F.lit("P")), F.lit("open")))
    return as_doubles(rows.drop("unused"))


@query("""SELECT c_custkey, lower(trim(' ' || c_name || ' ')) AS name, upper(trim(' ' || lower(c_mktsegment)))
  AS segment, trim('  ' || c_name) AS label, CASE WHEN c_nationkey % 2 = 0 THEN c_name END AS noted FROM customer""")
def normalise_customers(t: Inputs) -> DataFrame:
    rows = t["customer"].select(
        "c_custkey", F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("segment"),
        F.concat(F.lit("  "), "c_name").alias("label"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).otherwise("  ").alias("noted"))
    cleaned = T.normalise(rows, lower=["name"], upper=["segment"], trim=["label"])
    return cleaned.withColumn("noted", T.blank_to_null("noted"))


@query("""SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 5, '0') AS store, concat_ws('-', p_type, p_brand) AS joined,
  substr(p_name, 1, 4) AS head, split_part(p_type || '-' || p_brand || '-x', '-', 1) || '-' || p_brand AS leading,
  replace(p_name, ' ', '') AS flat FROM part""")
def text_parts(t: Inputs) -> DataFrame:
    code = F.concat_ws("-", "p_type", "p_brand", F.lit("x"))
    return t["part"].select(
        "p_partkey", T.store_key(F.col("p_size").cast("string")).alias("store"),
        F.concat_ws("-", "p_type", "p_brand").alias("joined"), F.substring("p_name", 1, 4).alias("head"),
        T.leading_parts(code, 2).alias("leading"), F.replace("p_name", F.lit(" "), F.lit("")).alias("flat"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(marked, '_.+_') THEN regexp_extract(marked, '_(.+)_', 1) END
  AS inner_text, regexp_matches(p_brand, '^Brand#1[0-9]?$') AS first_brands, p_name LIKE 'red%' AS is_red,
  p_type ILIKE 'econ%' AS is_economy, p_name NOT ILIKE '%RING%' AS no_ring
  FROM (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'a_' || p_name || '_z' END AS marked FROM part)""")
def match_patterns(t: Inputs) -> DataFrame:
    marked = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(
        F.concat(F.lit("a_"), "p_name", F.lit("_z")))
    return t["part"].select(
        "p_partkey", T.between_marks(marked).alias("inner_text"),
        F.col("p_brand").rlike("^Brand#1[0-9]?$").alias("first_brands"),
        F.col("p_name").like("red%").alias("is_red"), F.col("p_type").ilike("econ%").alias("is_economy"),
        (~F.col("p_name").ilike("%RING%")).alias("no_ring"))


@query("""SELECT o_orderkey, TRY_CAST(num AS DOUBLE) AS number, TRY_CAST(stamp AS TIMESTAMP) AS stamp,
  CASE WHEN o_orderkey % 4 <> 0 THEN doc END AS doc FROM (SELECT o_orderkey,
    CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) || '.5' END AS num,
    CASE WHEN o_orderkey % 5 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS stamp,
    CASE WHEN o_orderkey % 4 = 0 THEN '{"a":' ELSE '{"a":1}' END AS doc FROM orders)""")
def convert_safely(t: Inputs) -> DataFrame:
    """Bad numbers, timestamps and JSON become null; nothing fails."""
    key = F.col("o_orderkey")
    number = F.when(key % 3 == 0, "n/a").otherwise(F.concat(key.cast("string"), F.lit(".5")))
    stamp = F.when(key % 5 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    doc = F.when(key % 4 == 0, '{"a":').otherwise('{"a":1}')
    return t["orders"].select(
        "o_orderkey", T.safe_number(number, "double").alias("number"),
        T.safe_timestamp(stamp).cast("timestamp_ntz").alias("stamp"), T.safe_json(doc).alias("doc"))


@query("""SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' ||
  lpad(CAST(CAST(floor(extract(microseconds FROM ts) / 1000) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || '000000Z'
  AS iso, CAST(ts + INTERVAL 2 DAY AS DATE) AS later, ts - INTERVAL 6 HOUR AS earlier FROM events""")
def date_parts(t: Inputs) -> DataFrame:
    return t["events"].select(
        "event_id", F.to_date("ts").alias("day"), T.iso_text("ts", "000000Z").alias("iso"),
        F.date_add(F.to_date("ts"), 2).alias("later"), (F.col("ts") - F.expr("interval 6 hours")).alias("earlier"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, abs(-l_quantity) AS size,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 0) AS DOUBLE) AS whole,
  CAST(l_partkey % 7 AS BIGINT) AS bucket, CAST(floor(l_quantity / 3) AS BIGINT) AS thirds FROM lineitem""")
def line_arithmetic(t: Inputs) -> DataFrame:
    rows = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.abs(-F.col("l_quantity")).alias("size"),
        F.round(F.col("l_extendedprice").cast("decimal(18,2)"), 0).alias("whole"),
        (F.col("l_partkey") % 7).alias("bucket"), F.floor(F.col("l_quantity") / 3).alias("thirds"))
    return as_doubles(rows)


@query("""SELECT order_id, org_id, CASE org_id WHEN 'FL-US' THEN '21' WHEN 'FL-CA' THEN '45' WHEN 'KFL-US' THEN '22'
  WHEN 'CH-CA' THEN '77' WHEN 'CH-US' THEN '20' END AS company,
  CASE WHEN org_id IN ('FL-CA', 'CH-CA') THEN '98' ELSE '81' END AS banner FROM order_base""", uses=["order_base"])
def map_company_numbers(t: Inputs) -> DataFrame:
    return t["order_base"].select("order_id", "org_id", codes.company_number("org_id").alias("company"),
                                  codes.product_banner("org_id").alias("banner"))


_STATUS = """CASE WHEN s = 1000 THEN 'SUBMITTED' WHEN s BETWEEN 1600 AND 3700 THEN 'FULFILMENT_PROCESSING'
  WHEN s IN (7000, 7500) THEN 'FULFILMENT_COMPLETE' WHEN s = 9000 THEN 'CANCELLED'
  WHEN s = 13000 THEN 'WAIT_FRAUD_SYSTEM_CHECK' ELSE upper(d) END"""


@query(f"""SELECT header_version_id, {_STATUS} AS status,
  CASE WHEN s IN (1000, 1500) THEN 'SUBMITTED' WHEN is_fraud_failed = 1 THEN 'FRAUD_CHECK_FAILED'
    WHEN s IN (8000, 8500) THEN 'FULFILMENT_COMPLETE' ELSE {_STATUS} END AS mart_status,
  CASE s WHEN 11000 THEN 'CREATED' WHEN 18000 THEN 'RETURN_COMPLETE' ELSE upper(d) END AS return_status
  FROM (SELECT *, max_status AS s, max_status_desc AS d FROM headers)""", uses=["headers"])
def map_order_status(t: Inputs) -> DataFrame:
    return t["headers"].select(
        "header_version_id", codes.order_status("max_status", "max_status_desc").alias("status"),
        codes.mart_order_status("max_status", "max_status_desc", "is_fraud_failed").alias("mart_status"),
        codes.return_status("max_status", "max_status_desc").alias("return_status"))


_KINDS = """SELECT line_version_id, max_status AS s, max_status_desc AS d, delivery_method AS m,
  CASE WHEN quantity % 3 = 0 THEN 1 ELSE 0 END AS c, k.kind FROM lines,
  (VALUES ('DCFulfillment'), ('StoreFulfillment'), ('Rejections')) k(kind)"""


@query(f"""SELECT line_version_id, kind,
  CASE kind WHEN 'DCFulfillment' THEN CASE WHEN s BETWEEN 1000 AND 2000 THEN 'CONSIGNMENT_PROCESSING_START'
      WHEN s = 3000 THEN 'CONSIGNMENT_SUBMITTED' WHEN s BETWEEN 3500 AND 3700 THEN 'CONSIGNMENT_PROCESSING'
      WHEN s = 7000 THEN 'CONSIGNMENT_PROCESSING_END' WHEN s = 9000 THEN 'CONSIGNMENT_CANCELLED' ELSE upper(d) END
    WHEN 'StoreFulfillment' THEN CASE WHEN s = 1000 THEN 'CONSIGNMENT_PROCESSING_START'
      WHEN s = 2000 THEN 'CONSIGNMENT_SUBMITTED' WHEN s BETWEEN 3000 AND 4000 THEN 'CONSIGNMENT_PROCESSING'
      WHEN s BETWEEN 4500 AND 6000 THEN 'CONSIGNMENT_PROCESSING_END' WHEN s = 9000 THEN 'CONSIGNMENT_CANCELLED'
      ELSE upper(d) END ELSE upper(d) END AS consignment_status,
  CASE kind WHEN 'DCFulfillment' THEN CASE WHEN s BETWEEN 1000 AND 2000 THEN 'CREATED'
      WHEN s IN (3000, 3500) THEN 'SUBMITTED' WHEN s = 3600 THEN 'PICKED' WHEN s = 3700 THEN 'PACKED'
      WHEN s = 7000 AND m = 'PickUpAtStore' THEN 'PICKED_BY_CUST' WHEN s = 7000 THEN 'SHIPPED'
      WHEN s = 9000 THEN 'CANCELLED' ELSE upper(d) END
    WHEN 'StoreFulfillment' THEN CASE WHEN s = 1000 THEN 'CREATED' WHEN s = 2000 THEN 'SUBMITTED'
      WHEN s = 3000 THEN 'PICKED' WHEN s BETWEEN 3500 AND 4000 THEN 'PACKED' WHEN s BETWEEN 4500 AND 5000 THEN 'SHIPPED'
      WHEN s = 6000 THEN 'PICKED_BY_CUST' WHEN s = 9000 THEN 'CANCELLED' ELSE upper(d) END
    ELSE upper(d) END AS entry_status,
  CASE WHEN kind = 'Rejections' THEN CASE WHEN s BETWEEN 1000 AND 3000 THEN '1000' ELSE CAST(s AS VARCHAR) END
    WHEN kind = 'DCFulfillment' THEN CASE WHEN s BETWEEN 1000 AND 3000 THEN '1000' WHEN s = 3500 THEN '1200'
      WHEN s = 3600 THEN CASE c WHEN 0 THEN '1300' ELSE '1350' END WHEN s = 3700 THEN '1500'
      WHEN s = 7000 THEN CASE c WHEN 0 THEN '2000' ELSE '2050' END WHEN s = 9000 THEN '2100'
      ELSE CAST(s AS VARCHAR) END
    ELSE CASE WHEN s = 1000 THEN '1000' WHEN s = 2000 THEN '1200'
      WHEN s = 3000 THEN CASE c WHEN 0 THEN '1300' ELSE '1350' END WHEN s BETWEEN 3500 AND 4000 THEN '1500'
      WHEN s = 4500 THEN '2050' WHEN s = 5000 THEN CASE c WHEN 0 THEN '2000' ELSE '2050' END WHEN s = 6000 THEN '2000'
      WHEN s = 9000 THEN '2100' ELSE CAST(s AS VARCHAR) END END AS history_code
  FROM ({_KINDS})""", uses=["lines"])
def map_consignment_status(t: Inputs) -> DataFrame:
    kinds = F.explode(F.array(*[F.lit(k) for k in (K.WAREHOUSE, K.STORE, K.REJECTED)]))
    rows = t["lines"].select("line_version_id", "max_status", "max_status_desc", "delivery_method",
                             F.when(F.col("quantity") % 3 == 0, 1).otherwise(0).alias("lost"), kinds.alias("kind"))
    return rows.select(
        "line_version_id", "kind",
        K.consignment_status("kind", "max_status", "max_status_desc").alias("consignment_status"),
        K.entry_status("kind", "max_status", "max_status_desc", "delivery_method").alias("entry_status"),
        K.history_code("kind", "max_status", "lost").alias("history_code"))


@query("""SELECT order_id, CASE WHEN order_type = 'Return' AND order_id LIKE '%-E_' THEN 'EXCHANGE'
  WHEN order_type = 'Return' AND order_id LIKE '%-R_' THEN 'RETURN'
  WHEN order_type <> 'Return' AND o_custkey % 2 = 0 THEN 'ORDER'
  WHEN order_type <> 'Return' THEN 'CONSIGNMENT' END AS message_type FROM order_base""", uses=["order_base"])
def classify_messages(t: Inputs) -> DataFrame:
    release = F.when(F.col("o_custkey") % 2 == 1, F.lit("REL"))
    return t["order_base"].select("order_id", codes.message_type("order_type", "order_id", release)
                                  .alias("message_type"))


@query("""SELECT payment_line_pk, CASE payment_type WHEN 'Credit Card' THEN 'CREDITCARD' WHEN 'Gift Card' THEN 'GIFTCARD'
  WHEN 'PayPal' THEN 'PAYPAL' WHEN 'Klarna Account' THEN 'KLARNA_ACCOUNT' END AS tender,
  CASE payment_type WHEN 'Credit Card' THEN 'CREDIT' WHEN 'Gift Card' THEN 'PREPAID' ELSE upper(payment_type) END
    AS funding,
  CASE upper(card_type) WHEN 'VISA' THEN '1' WHEN 'OTHER' THEN '7' WHEN 'PAYPAL' THEN '7' ELSE '9' END AS card,
  CASE transaction_type WHEN 'Refund' THEN 'REFUND' WHEN 'Authorization Reversal' THEN 'CANCEL' ELSE 'CAPTURE' END
    AS movement FROM payments""", uses=["payments"])
def normalise_payment_types(t: Inputs) -> DataFrame:
    return t["payments"].select(
        "payment_line_pk", codes.tender_type("payment_type").alias("tender"),
        codes.funding_source("payment_type").alias("funding"), codes.card_class("card_type").alias("card"),
        codes.tender_movement("transaction_type").alias("movement"))


@query("""SELECT l_partkey, sum_qty AS total, CASE WHEN sum_qty = 0 THEN 0 ELSE coalesce(open_qty, 0) END AS open_part
  FROM (SELECT l_partkey, CAST(sum(CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_quantity END) AS BIGINT) AS sum_qty,
    CAST(sum(l_quantity) FILTER (l_linestatus = 'O') AS BIGINT) AS open_qty FROM lineitem GROUP BY 1)""")
def guard_stock_parts(t: Inputs) -> DataFrame:
    quantity = F.col("l_quantity")
    rows = t["lineitem"].groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_partkey") % 5 == 0, 0).otherwise(quantity)).cast("bigint").alias("total"),
        G.sum_if(F.col("l_linestatus") == "O", quantity).cast("bigint").alias("open_part"))
    return rows.withColumn("open_part", zero_guarded("open_part", "total"))


_DIGIT = """(10 - list_sum(list_transform(string_split({s}, ''), lambda d, i: CASE WHEN i % 2 = 0 THEN CAST(d AS INT)
  WHEN CAST(d AS INT) > 4 THEN CAST(d AS INT) * 2 - 9 ELSE CAST(d AS INT) * 2 END)) % 10) % 10"""


@query(f"""SELECT legacy_sku_key, CAST({_DIGIT.format(s="replace(legacy_sku, '-', '')")} AS INTEGER) AS digit,
  legacy_sku || '-' || CAST(CAST({_DIGIT.format(s="replace(legacy_sku, '-', '')")} AS INTEGER) AS VARCHAR) || '-' ||
    substr(split_part(legacy_sku_key, '-', 4), 1, 2) || '-' || substr(split_part(legacy_sku_key, '-', 4), 3, 3)
    AS sellable,
  legacy_sku || '-' || CAST(CAST({_DIGIT.format(
      s="replace(legacy_sku, '-', '') || substr(split_part(legacy_sku_key, '-', 4), 1, 2)")} AS INTEGER) AS VARCHAR)
    || '-' || substr(split_part(legacy_sku_key, '-', 4), 1, 2) || '-' ||
    substr(split_part(legacy_sku_key, '-', 4), 3) AS with_digit
  FROM (SELECT DISTINCT legacy_sku_key, legacy_sku FROM products)""", uses=["products"])
def build_sellable_keys(t: Inputs) -> DataFrame:
    return t["products"].select("legacy_sku_key", "legacy_sku").distinct().select(
        "legacy_sku_key", check_digit(F.replace("legacy_sku", F.lit("-"), F.lit(""))).alias("digit"),
        sellable_key("legacy_sku_key", "legacy_sku").alias("sellable"),
        sku_with_check_digit("legacy_sku_key").alias("with_digit"))


_AGENTS = """SELECT o_orderkey, o_totalprice, CASE o_custkey % 9
  WHEN 0 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_' || CAST(o_custkey % 50 AS STRING) || ' like Mac OS X)'
  WHEN 1 THEN 'Mozilla/5.0 (iPad; CPU OS 16_' || CAST(o_custkey % 40 AS STRING) || ' like Mac OS X)'
  WHEN 2 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; rv:' || CAST(o_custkey % 90 AS STRING) || ')'
  WHEN 3 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_' || CAST(o_custkey % 15 AS STRING) || ')'
  WHEN 4 THEN 'Mozilla/5.0 (X11; CrOS x86_64 ' || CAST(o_custkey % 99 AS STRING) || ')'
  WHEN 5 THEN 'Mozilla/5.0 (X11; Ubuntu; Linux x86_64)'
  WHEN 6 THEN 'Mozilla/5.0 (Linux; Android 14; Pixel) Mobile Safari'
  WHEN 7 THEN 'curl/8.' || CAST(o_custkey % 9 AS STRING) END AS agent FROM {orders}"""


@query(f"""SELECT CASE n WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'TABLET' WHEN 6 THEN 'MOBILE' WHEN 7 THEN 'OTHER'
    WHEN 8 THEN 'UNKNOWN' ELSE 'PC' END AS device_class, count(*) AS orders, CAST(sum(total) AS DOUBLE) AS total
  FROM (SELECT o_custkey % 9 AS n, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders) GROUP BY 1""")
def device_class_breakdown(t: Inputs) -> DataFrame:
    rows = t.sql(_AGENTS)
    return as_doubles(device_breakdown(rows, "agent", {
        "orders": F.lit(1).cast("bigint"), "total": F.col("o_totalprice").cast("decimal(18,2)")}))


@query("""SELECT payment_line_pk, md5(upper(trim(billing_email))) AS email_hash FROM payments""", uses=["payments"])
def split_identity(t: Inputs) -> DataFrame:
    rows = t["payments"].select("payment_line_pk", "billing_email", "billing_first_name", "billing_last_name")
    return rows.withColumn("email_hash", email_hash("billing_email")).drop(
        "billing_email", "billing_first_name", "billing_last_name")


@query("""SELECT event_id, json_extract_string(doc, '$.Fields."extend::k"') AS k, json_extract_string(doc, '$.user')
  AS person FROM (SELECT event_id, '{"Fields":{"extend::k":"' || CAST(json_extract_string(props, '$.k') AS VARCHAR)
    || '"},"user":"' || CAST(user_id AS VARCHAR) || '"}' AS doc FROM events)""")
def read_json_paths(t: Inputs) -> DataFrame:
    doc = F.to_json(F.struct(
        F.struct(F.get_json_object("props", "$.k").alias("extend::k")).alias("Fields"),
        F.col("user_id").cast("string").alias("user")))
    rows = N.with_json_fields(t["events"].select("event_id", doc.alias("doc")), "doc", {"k": ("extend::k", "string")})
    return rows.select("event_id", "k", T.json_field("doc", "user").alias("person"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, sha256(CAST(l_orderkey AS VARCHAR) || chr(1) ||
  CAST(l_linenumber AS VARCHAR)) AS line_hash, sha256(l_returnflag || chr(1) || coalesce(
    CASE WHEN l_linestatus = 'O' THEN l_linestatus END, '@null')) AS state_hash FROM lineitem""")
def hash_line_keys(t: Inputs) -> DataFrame:
    """The null mark is replaced by a printable one, which DuckDB can hash as well."""
    state = F.coalesce(F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")), F.lit("@null"))
    return t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                hash_key(["l_orderkey", "l_linenumber"]).alias("line_hash"),
                                hash_key(["l_returnflag", state]).alias("state_hash"))


@query("""SELECT p_partkey, CASE p_size % 3 WHEN 1 THEN 'true' WHEN 0 THEN 'false' END AS flag,
  CASE WHEN p_size % 5 IN (0, 1) THEN p_size ELSE 0 END AS on_hand_available,
  CASE WHEN p_size % 5 = 2 THEN p_size ELSE 0 END AS on_hand_unavailable,
  CASE WHEN p_size % 5 = 3 THEN p_size ELSE 0 END AS on_order FROM part""")
def derive_flags(t: Inputs) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("On Hand Available", "On hand available soon", "On Hand Unavailable",
                                         "On Order", "other")])
    rows = t["part"].select("p_partkey", F.col("p_size").alias("quantity"),
                            F.get(kinds, F.col("p_size") % 5).alias("supply_type"),
                            T.flag_text(F.col("p_size") % 3).alias("flag"))
    return supply_buckets(rows).select("p_partkey", "flag", "on_hand_available", "on_hand_unavailable", "on_order")


@query("""SELECT line_version_id FROM lines WHERE max_status <= 9000
  AND (parent_order_id IS NULL OR is_even_exchange = 1)""", uses=["lines"])
def filter_eligible_lines(t: Inputs) -> DataFrame:
    return eligible_lines(t["lines"]).select("line_version_id")


@query("""SELECT event_id, event_type FROM events WHERE lower(event_type) IN ('click', 'view') AND user_id IS NOT NULL
  AND event_id % 5 <> 0""")
def filter_feed(t: Inputs) -> DataFrame:
    rows = t["events"].withColumn("change", F.when(F.col("event_id") % 5 == 0, "IncrementalDeleteRows")
                                  .otherwise("IncrementalInsertRows"))
    wanted = F.lower("event_type").isin("click", "view") & F.col("user_id").isNotNull()
    return rows.filter(wanted & (F.lower("change") != "incrementaldeleterows")).select("event_id", "event_type")


# Arrays, structs and JSON ----------------------------------------------------------

def _packed_lines(t: Inputs) -> DataFrame:
    """Lines of each order as an array of structs, in a fixed order."""
    order = {c: F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")}
    item = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"),
                    F.col("l_quantity").cast("bigint").alias("qty"))
    return G.pack_ordered(t["lineitem"], ["l_orderkey"], order, item, "lines")


_ORDERED = "l_linenumber, l_partkey, l_suppkey, l_quantity"


@query(f"""SELECT l_orderkey, '[' || string_agg('{{"n":' || l_linenumber || ',"part":' || l_partkey
  || ',"qty":' || CAST(l_quantity AS BIGINT) || '}}', ',' ORDER BY {_ORDERED}) || ']' AS lines
  FROM lineitem GROUP BY 1""")
def pack_lines_per_order(t: Inputs) -> DataFrame:
    return _packed_lines(t).withColumn("lines", F.to_json("lines"))


@query("""SELECT o_orderkey, l_linenumber AS n, l_partkey AS part, CAST(l_quantity AS BIGINT) AS qty
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def fan_out_keeping_parents(t: Inputs) -> DataFrame:
    """Orders with packed lines, fanned out again; orders without lines stay."""
    packed = _packed_lines(t).withColumnRenamed("l_orderkey", "o_orderkey")
    documents = t["orders"].select("o_orderkey").join(packed, "o_orderkey", "left").select(
        "o_orderkey", F.array(F.struct("lines")).alias("groups"))
    rows = N.fan_out(documents, [("groups", "group"), ("group.lines", "line")])
    return rows.select("o_orderkey", "line.n", "line.part", "line.qty")


@query("""SELECT l_orderkey, l_linenumber AS n, l_partkey AS part FROM lineitem WHERE l_orderkey % 2 = 0""")
def fan_out_dropping_empty(t: Inputs) -> DataFrame:
    packed = _packed_lines(t).withColumn("lines", F.when(F.col("l_orderkey") % 2 == 0, F.col("lines")))
    rows = N.fan_out(packed, [("lines", "line")], keep_empty=False)
    return rows.select("l_orderkey", "line.n", "line.part")


@query(f"""SELECT l_orderkey, part, qty FROM (SELECT l_orderkey, unnest(list(l_partkey ORDER BY {_ORDERED})) AS part,
  unnest(list(CAST(l_quantity AS BIGINT) ORDER BY {_ORDERED})) AS qty FROM lineitem GROUP BY 1)""")
def zip_and_inline(t: Inputs) -> DataFrame:
    packed = _packed_lines(t).select("l_orderkey", N.field_of_each("lines", "part").alias("parts"),
                                     N.field_of_each("lines", "qty").alias("qtys"))
    return N.zip_rows(packed, ["l_orderkey"], part="parts", qty="qtys")


@query(f"""SELECT l_orderkey, first(l_partkey ORDER BY {_ORDERED}) AS first_part,
  string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY {_ORDERED}) AS parts FROM lineitem GROUP BY 1""")
def array_elements(t: Inputs) -> DataFrame:
    parts = N.field_of_each("lines", "part")
    return _packed_lines(t).select("l_orderkey", F.get("lines", F.lit(0))["part"].alias("first_part"),
                                   F.array_join(parts.cast("array<string>"), ",").alias("parts"))


@query("""SELECT l_orderkey, '[' || coalesce(string_agg('{"code":"' || l_returnflag || '","amount":' ||
    CAST(l_quantity AS BIGINT) || '}', ',' ORDER BY l_quantity DESC, l_partkey, l_suppkey, l_linenumber), '') || ']'
    AS listed FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1""")
def compact_ordered_json(t: Inputs) -> DataFrame:
    """Ordered JSON array per order; rows without an item leave no null behind."""
    item = F.when(F.col("l_returnflag") != "N", F.struct(
        F.col("l_returnflag").alias("code"), F.col("l_quantity").cast("bigint").alias("amount")))
    order = {"_size": -F.col("l_quantity"), **{c: F.col(c) for c in ("l_partkey", "l_suppkey", "l_linenumber")}}
    packed = G.pack_ordered(t["lineitem"], ["l_orderkey"], order, item, "listed")
    return packed.withColumn("listed", F.to_json("listed"))


@query("""SELECT user_id, '[{' || string_agg('"' || kind || '":"' || note || '"', ',' ORDER BY kind) || '}]'
  AS notes FROM (SELECT user_id, replace(lower('My ' || event_type), ' ', '') AS kind,
    max(lpad(CAST(event_id AS VARCHAR), 9, '0')) AS note FROM events GROUP BY 1, 2) GROUP BY 1""")
def pivot_notes(t: Inputs) -> DataFrame:
    kind = F.replace(F.lower(F.concat(F.lit("My "), "event_type")), F.lit(" "), F.lit(""))
    return G.pivot_notes(t["events"], ["user_id"], kind, F.lpad(F.col("event_id").cast("string"), 9, "0"), "notes")


@query(f"""SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR) || '/FIXED/' || CAST(CAST(l_quantity AS BIGINT) * 2
  AS VARCHAR), ',' ORDER BY {_ORDERED}) AS doubled FROM lineitem GROUP BY 1""")
def transform_arrays(t: Inputs) -> DataFrame:
    changed = N.add_to_each("lines", kind=F.lit("FIXED"))
    text = F.transform(changed, lambda e: F.concat_ws("/", e["part"].cast("string"), e["kind"],
                                                      (e["qty"] * 2).cast("string")))
    return _packed_lines(t).select("l_orderkey", F.array_join(text, ",").alias("doubled"))


@query("""SELECT l_suppkey, string_agg(repeat(l_returnflag || ',', n), '' ORDER BY l_returnflag) AS flags
  FROM (SELECT l_suppkey, l_returnflag, CAST(max(n) AS BIGINT) AS n FROM (SELECT l_suppkey, l_orderkey, l_returnflag,
    count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1, 2) GROUP BY 1""")
def union_arrays(t: Inputs) -> DataFrame:
    """Arrays of flags per supplier and order, united per supplier as multisets."""
    arrays = t["lineitem"].groupBy("l_suppkey", "l_orderkey").agg(F.collect_list("l_returnflag").alias("flags"))
    united = G.union_arrays(arrays, ["l_suppkey"], "flags", "flags")
    return united.withColumn("flags", F.concat(F.array_join("flags", ","), F.lit(",")))


@query("""SELECT user_id, '["' || string_agg(DISTINCT event_type, '","' ORDER BY event_type) || '"]' AS types
  FROM events GROUP BY 1""")
def distinct_sorted_text(t: Inputs) -> DataFrame:
    return G.distinct_text(t["events"], ["user_id"], "event_type", "types")


@query("""SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem GROUP BY 1""")
def json_round_trip(t: Inputs) -> DataFrame:
    """Array to JSON text and back; a missing text would be an empty array."""
    text = _packed_lines(t).select("l_orderkey", F.to_json("lines").alias("text"))
    back = N.json_array("text", "array<struct<n:int,part:bigint,qty:bigint>>")
    return text.select("l_orderkey", F.size(back).cast("bigint").alias("n"),
                       F.aggregate(N.field_of_each(back, "qty"), F.lit(0).cast("bigint"), lambda a, x: a + x)
                       .alias("qty"))


# Joins ---------------------------------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey AND l_orderkey % 2 = o_custkey % 2""")
def join_orders_inner(t: Inputs) -> DataFrame:
    lines = t["lineitem"].withColumn("parity", F.col("l_orderkey") % 2)
    orders = t["orders"].withColumn("order_parity", F.col("o_custkey") % 2)
    joined = lines.join(orders, (F.col("l_orderkey") == F.col("o_orderkey"))
                        & (F.col("parity") == F.col("order_parity")))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_mktsegment, cn.n_name AS customer_nation,
  r_name, p_brand, s_name, sn.n_name AS supplier_nation FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN region ON cn.n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey AND p_size < 25
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""")
def star_join(t: Inputs) -> DataFrame:
    """Left joins to seven tables; the part join has a condition of its own."""
    nation = t["nation"]
    customers = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"),
                              F.col("n_regionkey").alias("r_regionkey"))
    suppliers = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return (lines.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(customers, "c_nationkey", "left").join(t["region"], "r_regionkey", "left")
            .join(t["part"], (F.col("l_partkey") == F.col("p_partkey")) & (F.col("p_size") < 25), "left")
            .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .join(suppliers, "s_nationkey", "left")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus", "c_mktsegment",
                    "customer_nation", "r_name", "p_brand", "s_name", "supplier_nation"))


@query("""SELECT d.order_id, d.order_line_id, l.max_status FROM details d JOIN (SELECT * FROM lines
  QUALIFY row_number() OVER (PARTITION BY org_id, order_id, order_line_id ORDER BY updated_ts DESC) = 1) l
  USING (org_id, order_id, order_line_id)""", uses=["details", "lines"])
def join_current_version(t: Inputs) -> DataFrame:
    """Only the current version of a line is joined."""
    keys = ["org_id", "order_id", "order_line_id"]
    current = W.latest_per_key(t["lines"], keys, W.newest("updated_ts"))
    return t["details"].join(current.select(*keys, "max_status"), keys).select(
        "order_id", "order_line_id", "max_status")


@query("""SELECT l.line_version_id, s.store_number FROM lines l LEFT JOIN (SELECT * FROM stores WHERE upper(banner_geo)
  = 'NA' QUALIFY row_number() OVER (PARTITION BY lpad(short_number, 5, '0') ORDER BY location_sk DESC,
  location_seq DESC) = 1) s ON lpad(s.short_number, 5, '0') = lpad(coalesce(l.ship_from_location,
  l.physical_origin), 5, '0')""", uses=["lines", "stores"])
def join_on_expressions(t: Inputs) -> DataFrame:
    """Padded and coalesced keys; both sides are computed before the equi-join."""
    from orderloom.plans.places import store_numbers
    keyed = t["lines"].select("line_version_id", T.store_key(F.coalesce("ship_from_location", "physical_origin"))
                              .alias("_store"))
    return keyed.join(store_numbers(t["stores"]), "_store", "left").select("line_version_id", "store_number")


@query("""SELECT l.line_version_id, p.internal_product_number AS number FROM lines l LEFT JOIN products p
  ON l.is_gift_card <> 1 AND trim(l.item_id) = trim(p.global_size_id)
  AND p.banner_id = CASE WHEN l.org_id IN ('FL-CA', 'CH-CA') THEN '98' ELSE '81' END""", uses=["lines", "products"])
def join_conditional_key(t: Inputs) -> DataFrame:
    """The banner depends on the organisation; gift cards have a null key and match nothing."""
    from orderloom.plans.products import banner_products
    table = banner_products(t["products"], ["internal_product_number"])
    keyed = t["lines"].select("line_version_id", codes.product_banner("org_id").alias("banner_id"),
                              F.when(F.col("is_gift_card") != 1, F.trim("item_id")).alias("global_size_id"))
    joined = keyed.join(table, ["banner_id", "global_size_id"], "left")
    return joined.select("line_version_id", F.col("internal_product_number").alias("number"))


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
  AND l_returnflag = 'R')""")
def keep_orders_with_returns(t: Inputs) -> DataFrame:
    returned = t["lineitem"].filter("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return J.keep_matching(t["orders"], returned, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey =
  o_orderkey AND l_returnflag = 'R') AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND
  l_quantity > 45)""")
def drop_orders_twice(t: Inputs) -> DataFrame:
    lines = t["lineitem"].withColumnRenamed("l_orderkey", "o_orderkey")
    rest = J.drop_matching(t["orders"], lines.filter("l_returnflag = 'R'"), ["o_orderkey"])
    return J.drop_matching(rest, lines.filter("l_quantity > 45"), ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("""SELECT c.order_id AS child, c.parent_order_id AS parent, p.channel AS parent_channel,
  coalesce(c.parent_order_id, c.order_id) AS origin FROM order_base c LEFT JOIN order_base p
  ON p.org_id = c.org_id AND p.order_id = c.parent_order_id""", uses=["order_base"])
def link_parent_orders(t: Inputs) -> DataFrame:
    orders = t["order_base"]
    parents = orders.select("org_id", F.col("order_id").alias("parent_order_id"), F.col("channel").alias(
        "parent_channel"))
    return orders.join(parents, ["org_id", "parent_order_id"], "left").select(
        F.col("order_id").alias("child"), F.col("parent_order_id").alias("parent"), "parent_channel",
        F.coalesce("parent_order_id", "order_id").alias("origin"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(p_retailprice AS DECIMAL(12,2)) *
  CAST(l_quantity AS DECIMAL(12,0)) AS DOUBLE) AS goods_cost FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def enrich_with_cost(t: Inputs) -> DataFrame:
    """Small product table: broadcast only while its estimated size allows it."""
    costs = t["part"].select("p_partkey", F.col("p_retailprice").cast("decimal(12,2)").alias("cost"))
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                 F.col("l_quantity").cast("decimal(12,0)").alias("qty"))
    joined = J.lookup_join(lines, costs, F.col("l_partkey") == F.col("p_partkey"))
    return as_doubles(joined.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                    (F.col("cost") * F.col("qty")).alias("goods_cost")))


# Aggregation -----------------------------------------------------------------------

@query("""SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL""")
def group_by_all(t: Inputs) -> DataFrame:
    return t["lineitem"].groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey, CAST(sum(price) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned,
  CAST(sum(price) FILTER (l_returnflag = 'A') AS DOUBLE) AS accepted,
  CAST(sum(price) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS DOUBLE) AS open_amount,
  max(l_tax) FILTER (l_returnflag = 'R') AS highest_tax
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem) GROUP BY 1""")
def conditional_sums(t: Inputs) -> DataFrame:
    price, flag = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_returnflag")
    return as_doubles(t["lineitem"].groupBy("l_orderkey").agg(
        G.sum_if(flag == "R", price).alias("returned"), G.sum_if(flag == "A", price).alias("accepted"),
        G.sum_if((flag == "N") & (F.col("l_linestatus") == "O"), price).alias("open_amount"),
        G.max_if(flag == "R", "l_tax").alias("highest_tax")))


@query("""SELECT user_id, arg_max(event_type, event_id) AS last_type,
  arg_max(value, event_id) FILTER (event_type = 'purchase') AS last_purchase FROM events GROUP BY 1""")
def newest_values(t: Inputs) -> DataFrame:
    return t["events"].groupBy("user_id").agg(
        G.newest_if("event_type", "event_id").alias("last_type"),
        G.newest_if("value", "event_id", F.col("event_type") == "purchase").alias("last_purchase"))


@query("""SELECT o_custkey, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at, count(*) AS n FROM orders
  GROUP BY 1""")
def extremes_per_customer(t: Inputs) -> DataFrame:
    return t["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_at"),
                                                F.max("o_orderdate").alias("last_at"),
                                                F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, suppliers FROM lineitem JOIN (SELECT l_orderkey,
  count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1) USING (l_orderkey)""")
def distinct_count_per_order(t: Inputs) -> DataFrame:
    """Distinct count of a group on every row of it, by aggregation and join."""
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return W.with_distinct_count(lines, ["l_orderkey"], F.col("l_suppkey"), "suppliers")


@query("""SELECT l_orderkey, count(*) AS returned_lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
  HAVING count(*) > 2""")
def groups_having(t: Inputs) -> DataFrame:
    grouped = t["lineitem"].filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("returned_lines"))
    return grouped.filter("returned_lines > 2")


@query("""SELECT DISTINCT l_partkey, l_returnflag FROM lineitem""")
def distinct_rows(t: Inputs) -> DataFrame:
    return t["lineitem"].select("l_partkey", "l_returnflag").distinct()


@query("""SELECT payment_line_pk, n AS transaction_count, CAST(CASE WHEN n = 1 THEN coalesce(invoice_line_total,
  transaction_amount, 0) ELSE coalesce(transaction_amount, 0) END AS DOUBLE) AS amount FROM payments JOIN (
  SELECT order_id, invoice_id, invoice_line_id, count(DISTINCT transaction_id || '~' || coalesce(
  transaction_detail_id, '')) AS n FROM payments WHERE transaction_type = 'Settlement' GROUP BY ALL)
  USING (order_id, invoice_id, invoice_line_id) WHERE transaction_type = 'Settlement'""", uses=["payments"])
def payment_amount_rule(t: Inputs) -> DataFrame:
    rows = t["payments"].filter("transaction_type = 'Settlement'")
    transaction = F.concat("transaction_id", F.lit("~"), F.coalesce("transaction_detail_id", F.lit("")))
    ruled = G.single_transaction_amount(rows, ["order_id", "invoice_id", "invoice_line_id"], transaction,
                                        "invoice_line_total", "transaction_amount")
    return as_doubles(ruled.select("payment_line_pk", "transaction_count",
                                   F.col("transaction_amount").alias("amount")))


@query("""SELECT order_id, CAST(sum(transaction_amount) FILTER (transaction_type = 'Refund' AND payment_type =
  'Credit Card') AS DOUBLE) AS card_refund, CAST(sum(transaction_amount) FILTER (transaction_type = 'Refund' AND
  payment_type = 'PayPal') AS DOUBLE) AS wallet_refund, CAST(sum(transaction_amount) FILTER (transaction_type =
  'Refund') AS DOUBLE) AS refund FROM payments GROUP BY 1""", uses=["payments"])
def refund_totals_by_type(t: Inputs) -> DataFrame:
    refund = F.col("transaction_type") == "Refund"
    return as_doubles(t["payments"].groupBy("order_id").agg(
        G.sum_if(refund & (F.col("payment_type") == "Credit Card"), "transaction_amount").alias("card_refund"),
        G.sum_if(refund & (F.col("payment_type") == "PayPal"), "transaction_amount").alias("wallet_refund"),
        G.sum_if(refund, "transaction_amount").alias("refund")))


_FIRST_LINES = """SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY org_id, order_id, order_line_id
  ORDER BY max_status ASC, updated_ts ASC, line_version_id ASC) = 1"""


@query(f"""SELECT order_id, order_line_id, CAST(abs(coalesce(cancelled_original_sales_tax, 0) +
  coalesce(original_sales_tax, 0)) AS DOUBLE) AS sales_tax_amount, CAST(abs(coalesce(
  cancelled_original_shipping_tax, 0) + coalesce(original_shipping_tax, 0)) AS DOUBLE) AS shipping_tax_amount
  FROM ({_FIRST_LINES})""", uses=["lines"])
def absolute_tax_totals(t: Inputs) -> DataFrame:
    from orderloom.plans.amounts import first_line_rows, line_amounts
    rows = line_amounts(first_line_rows(t["lines"]))
    return as_doubles(rows.select("order_id", "order_line_id", "sales_tax_amount", "shipping_tax_amount"))


# Windows and set operations ----------------------------------------------------------

@query("""SELECT user_id, event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event_per_key(t: Inputs) -> DataFrame:
    latest = W.latest_per_key(t["events"], ["user_id", "event_type"], W.newest("ts", "event_id"))
    return latest.select("user_id", "event_type", "event_id", "ts", "value")


@query("""SELECT l_partkey, l_orderkey, l_suppkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY
  l_partkey ORDER BY l_shipdate DESC NULLS LAST, l_quantity DESC NULLS LAST, l_orderkey DESC, l_suppkey DESC,
  l_linenumber DESC) = 1""")
def latest_with_ties(t: Inputs) -> DataFrame:
    order = W.newest("l_shipdate", "l_quantity", "l_orderkey", "l_suppkey", "l_linenumber")
    return W.latest_per_key(t["lineitem"], ["l_partkey"], order).select(
        "l_partkey", "l_orderkey", "l_suppkey", "l_linenumber")


@query("""SELECT line_version_id, CAST(first_value(line_total) OVER w AS DOUBLE) AS first_line_total,
  CAST(first_value(sub_total) OVER w AS DOUBLE) AS first_sub_total FROM lines WINDOW w AS (PARTITION BY org_id,
  order_id, order_line_id ORDER BY max_status ASC NULLS LAST, updated_ts ASC NULLS LAST, line_version_id)""",
       uses=["lines"])
def first_values_per_line(t: Inputs) -> DataFrame:
    """Amounts at the first status, on every version of the line."""
    order = [*W.oldest("max_status", "updated_ts"), F.col("line_version_id").asc()]
    rows = W.with_first_values(t["lines"], ["org_id", "order_id", "order_line_id"], order,
                               ["line_total", "sub_total"])
    return as_doubles(rows.select("line_version_id", "first_line_total", "first_sub_total"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, len(list_distinct(list(l_returnflag) OVER (
  PARTITION BY l_orderkey))) AS flags FROM lineitem""")
def distinct_over_partition(t: Inputs) -> DataFrame:
    rows = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return W.with_distinct_count(rows, ["l_orderkey"], F.col("l_returnflag"), "flags").drop("l_returnflag")


@query("""SELECT line_version_id, CAST(min(line_total) OVER w AS DOUBLE) AS min_line_total,
  CAST(max(line_total) OVER w AS DOUBLE) AS max_line_total, min(line_total) OVER w <> max(line_total) OVER w
  AS changed FROM lines WINDOW w AS (PARTITION BY org_id, order_id, order_line_id)""", uses=["lines"])
def range_over_partition(t: Inputs) -> DataFrame:
    rows = W.with_range(t["lines"], ["org_id", "order_id", "order_line_id"], ["line_total"])
    return as_doubles(rows.select("line_version_id", "min_line_total", "max_line_total",
                                  (F.col("min_line_total") != F.col("max_line_total")).alias("changed")))


@query("""SELECT org_id, order_id, order_line_id, max_status, line_version_id FROM lines QUALIFY row_number() OVER (
  PARTITION BY org_id, order_id, order_line_id, max_status ORDER BY updated_ts DESC, line_version_id DESC) = 1""",
       uses=["lines"])
def one_row_per_status(t: Inputs) -> DataFrame:
    rows = W.one_row_per_status(t["lines"], ["org_id", "order_id", "order_line_id"], "max_status",
                                W.newest("updated_ts", "line_version_id"))
    return rows.select("org_id", "order_id", "order_line_id", "max_status", "line_version_id")


@query("""SELECT 'warehouse' AS kind, order_id, order_line_id, release_id FROM details WHERE is_rejected = 0
  UNION ALL SELECT 'rejected', order_id, order_line_id, release_id FROM details WHERE is_rejected = 1
  UNION ALL SELECT 'store', order_id, order_line_id, release_id FROM store_lines""", uses=["details", "store_lines"])
def union_of_kinds(t: Inputs) -> DataFrame:
    columns = ["kind", "order_id", "order_line_id", "release_id"]
    kept = t["details"].withColumn("kind", F.when(F.col("is_rejected") == 1, "rejected").otherwise("warehouse"))
    stored = t["store_lines"].withColumn("kind", F.lit("store"))
    return kept.select(*columns).unionByName(stored.select(*columns))
