"""Stand-ins for the source tables that the facts and dimensions are made of."""

from __future__ import annotations

from orderloom.workload.standins import STANDINS

_OPK = "'O' || CAST(o_orderkey AS STRING)"
_LPK = "'L' || CAST(o_orderkey AS STRING) || '/' || order_line_id"

STANDINS["src_orders"] = f"""
SELECT org_id, order_id, {_OPK} AS pk, order_type AS order_type_id, total AS order_total,
  CAST(o_orderkey % 3 AS BIGINT) AS package_count, '1000.000' AS min_fulfillment_status_id,
  CASE o_orderstatus WHEN 'F' THEN '7000.000' WHEN 'P' THEN '3000.000' ELSE '9000.000' END AS max_fulfillment_status_id,
  CASE WHEN order_type = 'Return' THEN '11000.000' END AS max_return_status_id,
  CAST(payment_status AS STRING) || '.000' AS payment_status_id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'CR' || CAST(o_orderkey % 5 AS STRING) END AS cancel_reason_id,
  CASE WHEN o_custkey % 17 <> 0 THEN CAST(o_custkey AS STRING) END AS customer_id,
  'First' || CAST(o_custkey AS STRING) AS customer_first_name, 'last' AS customer_last_name, '0a5' AS customer_phone,
  '<<"Fields":<<"extend::OrderLocale":"en_' || substr(org_id, 1, 2) || '","extend::FLX-ID":"F' ||
    CAST(o_custkey AS STRING) || '","extend::source":"' || channel || '","CancelledTotalTaxes":"1.5"' ||
    CASE o_orderkey % 3 WHEN 0 THEN ',"extend::LaunchSKUFlag":"false"' WHEN 1 THEN ',"extend::LaunchSKUFlag":"true"'
    ELSE '' END || '>>>>' AS json_store,
  o_orderdate + INTERVAL '1' DAY AS updated_timestamp, o_orderdate + INTERVAL '2' DAY AS src_load_ts
FROM {{order_base}}""".replace("<<", "{{").replace(">>", "}}")

_SRC_LINE = f"""
SELECT org_id, order_id, order_line_id, {_LPK} AS pk, {_OPK} AS order_pk, parent_order_id, item_id, is_gift_card,
  is_return, is_even_exchange, {{status}} AS max_fulfillment_status_id, '1000.000' AS min_fulfillment_status_id,
  CASE WHEN l_suppkey % 4 = 0 THEN 'W' || CAST(l_suppkey % 3 AS STRING) ELSE CAST(l_suppkey AS STRING) END
    AS physical_origin_id,
  CAST(l_suppkey AS STRING) AS ship_to_location_id, 'AD' || CAST(o_custkey % 5 AS STRING) AS ship_to_address_id,
  CASE l_linenumber % 3 WHEN 0 THEN 'Express' WHEN 1 THEN 'Ground' END AS shipping_method_id,
  'ShipToAddress' AS delivery_method_id, CAST(quantity AS BIGINT) AS quantity, price AS unit_price,
  CASE WHEN l_partkey % 19 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE price END AS order_line_sub_total,
  CASE WHEN l_partkey % 19 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(price + tax AS DECIMAL(18,4)) END
    AS order_line_total,
  CAST(0 AS DECIMAL(18,4)) AS cancelled_order_line_sub_total, CAST(0 AS DECIMAL(18,4)) AS cancelled_total_discounts,
  off AS total_discounts, off AS total_charges, tax AS total_taxes,
  CASE WHEN is_gift_card = 1 THEN CAST(25 AS DECIMAL(18,4)) END AS gift_card_value,
  '<<"Fields":<<"extend::FLOriginalUnitPrice":"' || CAST(price AS STRING) || '","extend::OrigOrderedQty":"' ||
    CAST(quantity AS STRING) || '","extend::CartShipMethod":"Z","extend::LaunchSKUFlag":"' ||
    CASE l_suppkey % 2 WHEN 0 THEN 'false' ELSE 'true' END || '">>>>' AS json_store,
  l_shipdate + INTERVAL '{{days}}' DAY AS updated_timestamp, l_shipdate + INTERVAL '{{days}}' DAY AS src_load_ts
FROM {{{{line_base}}}} {{where}}"""

# Two versions per line; the first of some was on backorder.
STANDINS["src_lines"] = "\nUNION ALL\n".join((
    _SRC_LINE.format(status="CASE WHEN l_suppkey % 5 = 0 THEN '1500.000' ELSE '1000.000' END", days=1, where=""),
    _SRC_LINE.format(status="CASE l_returnflag WHEN 'R' THEN '9000.000' WHEN 'A' THEN '7000.000' ELSE '3000.000' END",
                     days=4, where=""))).replace("<<", "{{").replace(">>", "}}")

_CHARGE = f"""
SELECT org_id, {_OPK} AS order_pk, {_LPK} AS order_line_pk, {{kind}} AS charge_type_id,
  CAST({{total}} AS DECIMAL(18,4)) AS charge_total, CAST(off AS DECIMAL(18,4)) AS requested_amount,
  CAST({{total}} AS DECIMAL(18,4)) AS original_charge_amount, {{id}} AS charge_detail_id,
  {{reference}} AS charge_reference_detail_id, 'P' || CAST(l_partkey % 9 AS STRING) AS charge_reference_id,
  'show ' || CAST(l_partkey % 9 AS STRING) AS charge_display_name,
  CASE WHEN l_partkey % 3 = 0 THEN 'CSARefund' ELSE 'other' END AS reason_id, 'TC' AS tax_code,
  CASE WHEN l_partkey % 2 = 0 THEN 'parent' END AS parent_charge_detail_id, {{process}} AS process,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS lost, l_shipdate AS updated_timestamp
FROM {{{{line_base}}}} WHERE {{where}}"""


def _charge(kind: str, total: str, number: int, where: str, process: str = "'web'", reference: str =
            "CAST(NULL AS STRING)") -> str:
    return _CHARGE.format(kind=f"'{kind}'", total=total, id=f"'c_{number}' || CAST(l_partkey AS STRING) || '_x'",
                          reference=reference, process=process, where=where)


STANDINS["src_charges"] = "\nUNION ALL\n".join((
    _charge("Shipping", "tax", 1, "l_linenumber <= 4"),
    _charge("Shipping", "tax + 1", 2, "l_linenumber <= 2", "'INITIAL capture'"),
    _charge("Coupon", "-off", 3, "l_partkey % 3 = 0", reference="'REF' || CAST(l_partkey % 5 AS STRING)"),
    _charge("Coupon", "-off - 1", 4, "l_partkey % 6 = 0"),
    _charge("Promotion", "-off", 5, "l_partkey % 4 = 1"),
    _charge("Return Fee", "7", 6, "l_partkey % 10 = 1"),
    _charge("Appeasement", "-3", 7, "l_partkey % 8 < 3")))

_TAX = f"""
SELECT org_id, {_OPK} AS order_pk, {_LPK} AS order_line_pk, {{kind}} AS tax_type_id, {{detail}} AS header_tax_detail_id,
  {{detail}} AS tax_detail_id, CAST({{amount}} AS DECIMAL(18,4)) AS tax_amount,
  'T' || CAST(l_linenumber AS STRING) AS tax_code, {{process}} AS process,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS lost
FROM {{{{line_base}}}} WHERE {{where}}"""

STANDINS["src_taxes"] = "\nUNION ALL\n".join((
    _TAX.format(kind="'SALES'", detail="'Shipping_1'", amount="tax", process="'web'", where="l_linenumber <= 5"),
    _TAX.format(kind="'Sales'", detail="CAST(NULL AS STRING)", amount="tax * 2", process="'web'", where="TRUE"),
    _TAX.format(kind="'Sales'", detail="'Line_1'", amount="tax * 3", process="'Initial Load'",
                where="l_linenumber = 1"),
    _TAX.format(kind="'Vat'", detail="'Line_1'", amount="tax", process="'web'", where="TRUE")))

# Statuses, order types, reasons and locations, each with one profile that counts.
STANDINS["src_statuses"] = """
SELECT CAST(n_nationkey * 1000 AS STRING) || '.000' AS status, 'Order ' || n_name AS description,
  'ORDER_EXECUTION' AS process_type_id, 'main' AS profile_id FROM {nation}
UNION ALL
SELECT CAST(n_nationkey * 1000 AS STRING) || '.000', 'Return ' || n_name, 'RETURN_EXECUTION', 'MAIN' FROM {nation}
UNION ALL
SELECT CAST(n_nationkey * 1000 AS STRING) || '.000', 'Other ' || n_name, 'ORDER_EXECUTION', 'other' FROM {nation}
UNION ALL
SELECT CAST(n_nationkey * 1000 AS STRING) || '.000', 'Fulfil ' || n_name, 'FULFILLMENT_EXECUTION', 'main' FROM {nation}"""

STANDINS["src_reasons"] = """
SELECT 'CR' || CAST(r_regionkey AS STRING) AS reason_id, 'reason ' || r_name AS description, 'Main' AS profile_id
FROM {region}
UNION ALL SELECT 'CR' || CAST(r_regionkey AS STRING), 'wrong', 'other' FROM {region}"""

STANDINS["src_locations"] = """
SELECT CAST(s_suppkey AS STRING) AS location_id, CASE s_suppkey % 3 WHEN 0 THEN 'Store' WHEN 1 THEN 'DC' ELSE
  'Supplier' END AS location_type_id, 'sub' || CAST(s_suppkey % 2 AS STRING) AS location_sub_type_id,
  CASE WHEN s_suppkey % 8 = 5 THEN 'N' ELSE 'Y' END AS active_flg, 'Y' AS reporting_flg, s_name AS location_name
FROM {supplier}"""

STANDINS["src_warehouses"] = """
SELECT DISTINCT org_id, 'W' || CAST(o_custkey % 3 AS STRING) AS warehouse_id, CAST(o_custkey % 3 AS STRING)
  AS store_number FROM {order_base}"""

# Release lines, and what became of them; open lines of some parts have no release, fulfilment, tracking or package yet.
STANDINS["src_release_lines"] = f"""
SELECT org_id, 'R' || CAST(o_orderkey AS STRING) AS release_pk, 'RL' || order_line_id AS release_line_id,
  'RLPK' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk, order_line_id, {_LPK} AS order_line_pk,
  'AL' || order_line_id AS allocation_id, quantity, item_id,
  CASE WHEN l_suppkey % 3 = 0 THEN quantity ELSE 0 END AS cancelled_quantity, quantity AS fulfilled_quantity,
  l_shipdate AS updated_timestamp FROM {{line_base}} WHERE l_linestatus <> 'O' OR l_partkey % 9 <> 0"""

STANDINS["src_releases"] = """
SELECT org_id, 'R' || CAST(o_orderkey AS STRING) AS pk, 'REL' || CAST(o_orderkey AS STRING) AS release_id, order_id,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 8 AS STRING) END AS ship_from_location_id, 'UPS' AS ship_via_id,
  'carrier' AS carrier_code, o_orderdate AS updated_timestamp FROM {order_base}"""

STANDINS["src_allocations"] = f"""
SELECT org_id, {_LPK} AS order_line_pk, 'AL' || order_line_id AS allocation_id,
  'APK' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk,
  CASE l_partkey % 3 WHEN 0 THEN 'Open' WHEN 1 THEN 'Released' ELSE ' ' END AS status_id, quantity,
  'RQ' || CAST(l_partkey % 50 AS STRING) AS reservation_request_id,
  CASE WHEN l_suppkey % 2 = 0 THEN 'W' || CAST(l_suppkey % 4 AS STRING) ELSE CAST(l_suppkey AS STRING) END
    AS ship_from_location_id,
  'FEDEX' AS ship_via_id, 'EA' AS uom, 'c' AS carrier_code, l_shipdate AS created_timestamp,
  l_shipdate AS updated_timestamp FROM {{line_base}}"""

STANDINS["src_fulfilment_details"] = f"""
SELECT org_id, {_LPK} AS order_line_pk, 'FD' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk,
  'FDI' || order_line_id AS fulfillment_detail_id, 'REL' || CAST(o_orderkey AS STRING) AS release_id,
  'RL' || order_line_id AS release_line_id, CASE WHEN l_partkey % 2 = 0 THEN '7000.000' ELSE '3000.000' END AS status_id,
  'T' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS tracking_number, 'PK' || order_line_id AS package_id,
  CASE WHEN l_partkey % 3 = 0 THEN 'DHL' END AS ship_via_id, CAST(NULL AS STRING) AS carrier_code, 'S1' AS shipment_id,
  'eta' AS eta, 'g' AS gift_card_number, 'sg' AS sgtin, 'sn' AS serial_number, l_shipdate AS src_load_ts,
  l_shipdate AS updated_timestamp FROM {{line_base}} WHERE l_linestatus <> 'O' OR l_partkey % 4 <> 0"""

STANDINS["src_tracking"] = f"""
SELECT org_id, {_OPK} AS order_pk, 'TP' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk,
  'T' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS tracking_number, 'DELIVERED' AS package_status,
  l_shipdate AS original_est_delivery_date, l_shipdate AS scheduled_date, l_shipdate AS shipped_date,
  l_shipdate + INTERVAL '2' DAY AS delivered_date, l_shipdate AS estimated_delivery_date,
  l_shipdate AS updated_timestamp FROM {{line_base}} WHERE l_linestatus <> 'O' OR l_partkey % 2 <> 0"""

STANDINS["src_notes"] = f"""
SELECT org_id, {_OPK} AS order_pk, {_LPK} AS order_line_pk, 'Gift To' AS note_type_id,
  'to ' || CAST(l_partkey AS STRING) AS note_text, 'N1' || order_line_id AS pk, l_shipdate AS updated_timestamp
FROM {{line_base}} WHERE l_partkey % 5 = 0
UNION ALL
SELECT org_id, {_OPK}, {_LPK}, CASE WHEN l_partkey % 2 = 0 THEN 'CSAOrderNote' ELSE 'Gift From' END,
  'from ' || CAST(l_suppkey AS STRING), 'N2' || order_line_id, l_shipdate FROM {{line_base}} WHERE l_partkey % 10 < 6"""

# One payment header and method per order; some have two methods.
STANDINS["src_payment_headers"] = """
SELECT org_id, order_id, 'PH' || CAST(o_orderkey AS STRING) AS pk, 'PG' AS payment_group_id,
  CAST(payment_status AS STRING) || '.000' AS status, o_orderdate AS updated_timestamp FROM {order_base}"""

_METHOD = """
SELECT org_id, 'PH' || CAST(o_orderkey AS STRING) AS payment_header_pk, 'PM{n}' || CAST(o_orderkey AS STRING) AS pk,
  'M{n}' || CAST(o_orderkey AS STRING) AS payment_method_id, {kind} AS payment_type, 'USD' AS currency_code,
  'V' || CAST(o_orderkey % 3 AS STRING) AS vendor_id, 'card' AS card_type, 'gate' AS gateway_id,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE total * 0.25 END AS DECIMAL(18,4)) AS current_refund_amount
FROM {{order_base}} {where}"""

STANDINS["src_payment_methods"] = "\nUNION ALL\n".join((
    _METHOD.format(n=1, kind="CASE o_orderkey % 3 WHEN 0 THEN 'Gift Card' WHEN 1 THEN 'Credit Card' ELSE 'PayPal' END",
                   where=""),
    _METHOD.format(n=2, kind="'PayPal'", where="WHERE o_orderkey % 4 = 0")))

STANDINS["src_payment_summaries"] = """
SELECT org_id, order_id, 'PG' AS payment_group_id, CAST(total * 0.2 AS DECIMAL(18,4)) AS requested_refund_amount,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN total * 0.1 ELSE 0 END AS DECIMAL(18,4)) AS returned,
  CAST(total * 0.3 AS DECIMAL(18,4)) AS credit_amount,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Return Credit' ELSE 'Sale' END AS reference_type FROM {order_base}"""

# A settlement per line with an invoice, and refunds that follow it without one.
STANDINS["src_transactions"] = """
SELECT org_id, order_id, 'TX' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk,
  'PM1' || CAST(o_orderkey AS STRING) AS payment_method_pk, 'T1/' || order_line_id AS payment_transaction_id,
  'Settlement' AS transaction_type, 'RQ/' || order_line_id AS request_id, CAST(NULL AS STRING) AS follow_on_id,
  'Success' AS payment_response_status, price AS requested_amount, l_shipdate AS requested_date,
  l_shipdate AS transaction_date, l_shipdate AS created_timestamp, l_shipdate AS updated_timestamp,
  l_shipdate AS src_load_ts FROM {line_base}
UNION ALL
SELECT org_id, order_id, 'TF' || CAST(o_orderkey AS STRING) || '/' || order_line_id,
  'PM1' || CAST(o_orderkey AS STRING), 'T2/' || order_line_id, CASE WHEN l_partkey % 2 = 0 THEN 'Refund' ELSE
  'Authorization' END, 'RF/' || order_line_id, 'RQ/' || order_line_id, 'Success', price, l_shipdate, l_shipdate,
  l_shipdate, l_shipdate + INTERVAL '1' DAY, l_shipdate FROM {line_base} WHERE l_returnflag = 'R'"""

STANDINS["src_transaction_details"] = """
SELECT org_id, 'TX' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS payment_transaction_pk,
  'D1' AS payment_transaction_detail_id, price AS amount,
  'INV' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS reference_id FROM {line_base}"""

STANDINS["src_invoices"] = f"""
SELECT org_id, {_OPK} AS order_pk, 'IPK' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk,
  'INV' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS invoice_id, 'PK' || order_line_id AS package_id,
  'Shipment' AS invoice_type, price AS invoice_total, l_shipdate AS updated_timestamp FROM {{line_base}}"""

STANDINS["src_invoice_lines"] = """
SELECT org_id, 'IPK' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS invoice_pk,
  'ILP' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk, 'IL' || order_line_id AS invoice_line_id,
  order_line_id, item_id, 'PD' || order_line_id AS package_detail_id, price AS invoice_line_total,
  l_shipdate AS updated_timestamp FROM {line_base}"""

# Fulfilments: one per order, with a line per order line, packages and package details.
STANDINS["src_fulfilments"] = """
SELECT org_id, 'F' || CAST(o_orderkey AS STRING) AS pk, 'REL' || CAST(o_orderkey AS STRING) AS fulfillment_id, order_id,
  '1000.000' AS min_status_id, CAST(1000 * (o_orderkey % 9) AS STRING) || '.000' AS max_status_id,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(1000 * (o_orderkey % 5) AS STRING) || '.000' END AS cancel_reason_id,
  o_orderdate AS shipped_date, 'UPS' AS ship_via_id, 'gold' AS service_level_code, 'c' AS carrier_code, 1 AS priority,
  o_orderdate AS src_load_ts FROM {order_base}"""

STANDINS["src_fulfilment_lines"] = """
SELECT org_id, 'F' || CAST(o_orderkey AS STRING) AS fulfillment_pk,
  'FL' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk, 'RL' || order_line_id AS fulfillment_line_id,
  order_id, order_line_id, item_id, CASE l_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '3000.000' WHEN 2 THEN '4000.000'
    ELSE '5000.000' END AS fulfillment_line_status_id,
  CASE WHEN l_returnflag = 'R' THEN '2000.000' END AS cancel_reason_id, quantity AS ordered_qty,
  l_shipdate AS updated_timestamp FROM {line_base} WHERE l_suppkey % 2 = 0"""

STANDINS["src_fulfilment_reasons"] = """
SELECT CAST(r_regionkey * 1000 AS STRING) || '.000' AS fulfillment_reason_id, 'why ' || r_name AS fulfillment_reason_name,
  CASE WHEN r_regionkey % 2 = 0 THEN '2000.000' ELSE '1000.000' END AS fulfillment_reason_type_id, 'main' AS profile_id
FROM {region}"""

STANDINS["src_packages"] = """
SELECT org_id, order_id, 'PP' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk,
  'REL' || CAST(o_orderkey AS STRING) AS fulfillment_id, 'PK' || order_line_id AS package_id,
  'TASK' || CAST(l_suppkey % 10 AS STRING) AS task_id, CAST(l_suppkey AS STRING) AS ship_from_location_id,
  CASE l_partkey % 3 WHEN 0 THEN '' ELSE CAST(1000 * (l_partkey % 3) AS STRING) END AS package_status,
  l_shipdate AS src_load_ts FROM {line_base} WHERE l_linestatus <> 'O' OR l_partkey % 2 <> 0"""

STANDINS["src_package_details"] = """
SELECT org_id, 'PP' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS packages_pk,
  'PDP' || CAST(o_orderkey AS STRING) || '/' || order_line_id AS pk, 'PD' || order_line_id AS package_detail_id, item_id,
  quantity AS quantity_qty FROM {line_base} WHERE l_linestatus <> 'O' OR l_partkey % 4 <> 0"""

# Availability messages: parts as items, suppliers as locations, sums of quantities.
_FEED = """
SELECT {message} AS message_type, ' ' || lpad(CAST(l_partkey AS STRING), 7, '0') AS item_id, {place}
  CASE l_linenumber % 6 WHEN 0 THEN 'FL-US - ShipToHome' WHEN 1 THEN 'FL-US - BOPIS' WHEN 2 THEN 'FL-CA - ShipToHome'
    WHEN 3 THEN 'CH-CA - BOPIS' WHEN 4 THEN 'KFL-CA - ShipToHome' ELSE 'Other' END AS selling_channel,
  CAST(l_shipdate AS TIMESTAMP{ntz}) AS updated_ts, l_shipdate + INTERVAL '1' DAY AS header_ts,
  l_shipdate + INTERVAL '2' DAY AS load_ts, 'prod' AS environment, 'NA' AS region, 'EST' AS time_zone, 'US' AS country,
  CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS BIGINT) WHEN l_returnflag = 'A' THEN 0 ELSE CAST(l_quantity AS BIGINT)
    END AS atp,
  CAST(l_quantity AS BIGINT) AS warehouse_atp, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS store_atp,
  CAST(NULL AS BIGINT) AS dropship_atp, CAST(l_quantity AS BIGINT) AS on_hand_quantity, 'ok' AS on_hand_status,
  CASE WHEN l_linestatus = 'O' THEN 'AVAILABLE' ELSE 'OUT' END AS status, 'ok' AS atp_status,
  CAST(NULL AS BIGINT) AS future_quantity, CAST(NULL AS BIGINT) AS first_future_quantity,
  CAST(l_shipdate AS DATE) AS future_date, 'SyncDetail' AS transaction_type,
  l_orderkey * 100000000 + l_partkey * 1000 + l_suppkey AS row_id
FROM {{lineitem}}"""

STANDINS["src_network"] = _FEED.format(
    message="""CASE WHEN l_suppkey % 3 = 0 THEN 'networkFullAvailabilitySync' WHEN l_suppkey % 3 = 1 THEN
  'networkAvailabilityAlert' ELSE 'other' END""", place="", ntz="").replace(
      "CAST(l_shipdate AS TIMESTAMP) AS", "l_shipdate AS")
STANDINS["src_location_feed"] = _FEED.format(
    message="""CASE WHEN l_suppkey % 3 = 0 THEN 'locationAvailabilityFullSync' ELSE 'locationAvailabilityDeltaSync'
  END""", place="CASE WHEN l_partkey % 11 <> 0 THEN CAST(l_suppkey AS STRING) END AS location_id,", ntz="").replace(
      "CAST(l_shipdate AS TIMESTAMP) AS", "l_shipdate AS")

# Product master as one JSON document per row.
STANDINS["src_product_documents"] = """
SELECT '{{"global_size_id":"' || lpad(CAST(p_partkey AS STRING), 7, '0') || '","banner_id":"' ||
  CASE p_partkey % 3 WHEN 0 THEN '81' WHEN 1 THEN '98' ELSE '03' END || '","current_price":' ||
  CASE WHEN p_partkey % 7 = 0 THEN '"n/a"' ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END ||
  ',"is_discountable":' || CASE p_partkey % 2 WHEN 0 THEN 'true' ELSE 'false' END ||
  ',"all_upcs":["' || p_brand || '"]}}' AS value, p_partkey FROM {part}"""
