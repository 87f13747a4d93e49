"""Queries over the facts, dimensions and availability tables, on stand-in sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.history import scd2_close
from orderloom.plans import availability as V
from orderloom.plans import dimensions as D
from orderloom.plans import facts as X
from orderloom.plans import fulfilment as U
from orderloom.plans.mart_inputs import mart_lines
from orderloom.plans.products import banner_products, division_products, product_master
from orderloom.sources.buckets import BucketTable
from orderloom.workload import source_standins  # noqa: F401  (adds its stand-ins)
from orderloom.workload.registry import as_doubles, new_folder, query
from orderloom.workload.standins import Inputs

INITIAL = "initial"
PROFILE = "main"
LINK = "org_id, order_line_pk"


def _empty(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))


class Source(dict):
    """Source tables by name; stand-ins are read when they are first asked for."""

    def __init__(self, t: Inputs):
        super().__init__()
        self.t = t

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.build(name)
        return self[name]

    def build(self, name: str) -> DataFrame:
        t = self.t
        cut = {"line_charges": ("src_charges", "lost = 0"), "cancelled_line_charges": ("src_charges", "lost = 1"),
               "order_charges": ("src_charges", "lost = 0"), "cancelled_order_charges": ("src_charges", "lost = 1"),
               "line_taxes": ("src_taxes", "lost = 0"), "cancelled_line_taxes": ("src_taxes", "lost = 1"),
               "order_taxes": ("src_taxes", "lost = 0"), "cancelled_order_taxes": ("src_taxes", "lost = 1")}
        if name in cut:
            table, where = cut[name]
            return t[table].filter(where)
        same = {"orders": "src_orders", "order_line_history": "src_lines", "order_lines": "src_lines",
                "releases": "src_releases", "release_lines": "src_release_lines", "allocations": "src_allocations",
                "fulfillment_details": "src_fulfilment_details", "tracking": "src_tracking",
                "statuses": "src_statuses", "fulfilment_statuses": "src_statuses", "reasons": "src_reasons",
                "locations": "src_locations", "warehouses": "src_warehouses", "line_notes": "src_notes",
                "order_notes": "src_notes", "payment_headers": "src_payment_headers",
                "payment_methods": "src_payment_methods", "payment_summaries": "src_payment_summaries",
                "transactions": "src_transactions", "transaction_details": "src_transaction_details",
                "invoices": "src_invoices", "invoice_lines": "src_invoice_lines", "fulfilments": "src_fulfilments",
                "fulfilment_lines": "src_fulfilment_lines", "fulfilment_reasons": "src_fulfilment_reasons",
                "packages": "src_packages", "package_details": "src_package_details"}
        if name in same:
            return t[same[name]]
        return getattr(self, f"make_{name}")(t)

    # small tables made from the ones above

    def make_payment_types(self, t: Inputs) -> DataFrame:
        return t["src_payment_methods"].select(F.col("payment_type").alias("payment_type_id")).distinct().withColumns({
            "is_prepaid": F.when(F.col("payment_type_id") == "PayPal", 1).otherwise(0), "profile_id": F.lit(PROFILE)})

    def make_order_types(self, t: Inputs) -> DataFrame:
        return t["src_orders"].select("order_type_id").distinct().withColumns({
            "doc_type_id": F.when(F.col("order_type_id") == "Launch", "Transfer").otherwise("CustomerOrder"),
            "profile_id": F.lit(PROFILE)})

    def make_payment_statuses(self, t: Inputs) -> DataFrame:
        return t["src_orders"].select(F.col("payment_status_id").alias("status_id")).distinct().withColumn(
            "status_name", F.concat(F.lit("paid "), "status_id"))

    def make_order_holds(self, t: Inputs) -> DataFrame:
        rows = t["src_orders"].filter("package_count = 1")
        return rows.select("org_id", F.col("pk").alias("order_pk"), F.lit("H1").alias("status_id"),
                           F.lit("RR").alias("resolve_reason_id"), F.lit("fraud").alias("hold_type"),
                           "updated_timestamp")

    def make_return_tracking(self, t: Inputs) -> DataFrame:
        return t["src_tracking"].withColumn("return_tracking_number", F.concat(F.lit("R"), "tracking_number"))

    def make_cancel_history(self, t: Inputs) -> DataFrame:
        rows = t["src_lines"].filter("max_fulfillment_status_id = '9000.000'")
        reason = F.concat(F.lit("CR"), (F.col("quantity") % 5).cast("string"))
        return rows.select("org_id", F.col("pk").alias("order_line_pk"), reason.alias("cancel_reason"),
                           "updated_timestamp", "pk")

    def make_return_details(self, t: Inputs) -> DataFrame:
        rows = t["src_lines"].filter("is_return = 1")
        return rows.select("org_id", F.col("pk").alias("order_line_pk"), F.col("ship_to_location_id")
                           .alias("location_id"), "updated_timestamp", "pk")

    def make_promising(self, t: Inputs) -> DataFrame:
        rows = t["src_lines"].filter("quantity % 2 = 0")
        return rows.select("org_id", F.col("pk").alias("order_line_pk"), F.col("physical_origin_id")
                           .alias("ship_from_location_id"), "updated_timestamp", "pk")

    def make_ship_to_addresses(self, t: Inputs) -> DataFrame:
        rows = t["src_orders"].filter("package_count <> 2")
        return rows.select("org_id", "order_id", F.concat(F.lit("AD"), (F.substring("pk", 2, 12).cast("bigint") % 5)
                                                          .cast("string")).alias("address_id"),
                           F.lit("Ann").alias("address_firstname"), F.lit("Lee").alias("address_lastname"),
                           F.lit("1 road").alias("address_address1"), F.lit(None).cast("string").alias(
                               "address_address2"), F.lit("town").alias("address_city"),
                           F.lit("123").alias("address_postalcode"), F.lit("st").alias("address_state"),
                           F.lit("us").alias("address_country"), F.lit("a@b.c").alias("address_email"),
                           F.lit("0x1").alias("address_phone"))

    def make_billing_addresses(self, t: Inputs) -> DataFrame:
        rows = t["src_payment_methods"].filter("payment_type <> 'Gift Card'")
        return rows.select("org_id", F.col("pk").alias("payment_method_pk"),
                           F.col("vendor_id").alias("address_firstname"), F.lit("bill").alias("address_lastname"),
                           F.lit("2 road").alias("address_address1"), F.lit(None).cast("string").alias(
                               "address_address2"), F.lit("town").alias("address_city"),
                           F.lit("321").alias("address_postalcode"), F.lit("st").alias("address_state"),
                           F.lit("us").alias("address_country"), F.lit("b@b.c").alias("address_email"),
                           F.lit("0x2").alias("address_phone"))

    def make_items(self, t: Inputs) -> DataFrame:
        return t["part"].select(F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("item_id"),
                                F.col("p_partkey").alias("pk"), F.lit(PROFILE).alias("profile_id"),
                                F.col("p_brand").alias("brand"), F.col("p_type").alias("color"))

    def make_selling_attributes(self, t: Inputs) -> DataFrame:
        size = F.col("p_size")
        return t["part"].select(F.col("p_partkey").alias("item_pk"), F.lit(PROFILE).alias("profile_id"),
                                (size % 2).alias("is_returnable_at_store"), (size % 3).alias("is_returnable_at_dc"),
                                (size % 2).alias("sold_in_stores"), (size % 5).alias("sold_online"),
                                size.alias("max_discount_amount"))

    def make_line_additional(self, t: Inputs) -> DataFrame:
        rows = t["src_lines"].filter("is_return = 1").select("org_id", F.col("pk").alias("order_line_pk")).distinct()
        return rows.withColumn("return_reason", F.lit("Lost Package "))

    def make_method_attributes(self, t: Inputs) -> DataFrame:
        rows = t["src_payment_methods"]
        return rows.select("org_id", F.col("pk").alias("payment_method_pk"), F.lit("AVSResultCode").alias("name"),
                           F.col("vendor_id").alias("value"))

    def make_package_statuses(self, t: Inputs) -> DataFrame:
        return t["region"].select((F.col("r_regionkey") * 1000).cast("string").alias("package_status_id"),
                                  F.col("r_name").alias("package_status_name"))

    def make_reason_types(self, t: Inputs) -> DataFrame:
        return t["region"].filter("r_regionkey in (1, 2)").select(
            F.concat((F.col("r_regionkey") * 1000).cast("string"), F.lit(".000")).alias("fulfillment_reason_type_id"),
            F.col("r_name").alias("fulfillment_reason_type_name"))

    def make_tasks(self, t: Inputs) -> DataFrame:
        return t["src_packages"].select("org_id", "task_id").distinct().withColumns({
            "task_type_id": F.lit("1"), "task_status_id": F.lit("2"), "assigned_to": F.lit("me")})

    def make_task_types(self, t: Inputs) -> DataFrame:
        return t["region"].filter("r_regionkey = 1").select(F.lit("1").alias("task_type_id"),
                                                            F.col("r_name").alias("task_type_name"))

    def make_task_statuses(self, t: Inputs) -> DataFrame:
        return t["region"].filter("r_regionkey = 2").select(F.lit("2").alias("task_status_id"),
                                                            F.col("r_name").alias("task_status_name"))

    def make_pick_details(self, t: Inputs) -> DataFrame:
        rows = t["src_fulfilment_lines"].join(t["src_fulfilments"].select(
            "org_id", F.col("pk").alias("fulfillment_pk"), "fulfillment_id"), ["org_id", "fulfillment_pk"])
        return rows.filter("ordered_qty % 3 = 0").select(
            "org_id", F.lit("TASK1").alias("task_id"), "fulfillment_id", "fulfillment_line_id",
            F.col("ordered_qty").alias("picked_qty"), F.col("ordered_qty").alias("quantity"))

    def make_line_shorts(self, t: Inputs) -> DataFrame:
        rows = t["src_fulfilment_lines"].filter("ordered_qty % 2 = 0")
        return rows.select("org_id", F.col("pk").alias("fulfillment_line_pk"),
                           F.when(F.col("ordered_qty") % 4 == 0, "Pick").otherwise("Pack").alias("transaction_type"),
                           F.lit("2000.000").alias("short_reason_id"), "updated_timestamp", "pk")

    def make_e_invoices(self, t: Inputs) -> DataFrame:
        return t["src_invoices"].withColumn("invoice_id", F.concat(F.lit("E"), "invoice_id"))

    def make_e_invoice_lines(self, t: Inputs) -> DataFrame:
        return t["src_invoice_lines"].withColumnRenamed("invoice_pk", "e_invoice_pk")


# Orders ------------------------------------------------------------------------------

_KIND = "lower(charge_type_id)"
_LINE_CHARGES = f"""SELECT {LINK},
    sum(charge_total) FILTER ({_KIND} = 'shipping' AND lower(process) NOT LIKE 'initial%') AS ship_now,
    sum(charge_total) FILTER ({_KIND} = 'shipping' AND lower(process) LIKE 'initial%') AS ship_first,
    sum(original_charge_amount) FILTER ({_KIND} = 'shipping' AND lower(process) NOT LIKE 'initial%') AS base_ship,
    sum(coalesce(charge_total, requested_amount)) FILTER ({_KIND} = 'coupon') AS coupon,
    sum(coalesce(charge_total, requested_amount)) FILTER ({_KIND} = 'promotion') AS promotion,
    sum(charge_total) FILTER ({_KIND} = 'return fee') AS return_fee,
    sum(charge_total) FILTER ({_KIND} = 'appeasement' AND parent_charge_detail_id IS NULL) AS appeasement,
    arg_max(charge_detail_id, charge_detail_id) FILTER ({_KIND} = 'coupon') AS reward,
    '[' || coalesce(string_agg('{{"couponCode":"' || CASE WHEN {_KIND} = 'coupon' THEN coalesce(
        charge_reference_detail_id, regexp_extract(charge_detail_id, '_(.+)_', 1)) ELSE charge_detail_id END ||
      '","promoGroup":"' || upper(charge_display_name) || '","promoCode":"' || charge_reference_id || '","amount":' ||
      CAST(abs(coalesce(charge_total, requested_amount)) AS VARCHAR) || '}}', ',' ORDER BY abs(charge_total) DESC,
      charge_reference_detail_id NULLS FIRST, charge_detail_id) FILTER ({_KIND} IN ('coupon', 'promotion') OR
      ({_KIND} = 'appeasement' AND parent_charge_detail_id IS NULL)), '') || ']' AS coupons,
    count(*) FILTER ({_KIND} = 'return fee') AS fees
  FROM src_charges WHERE lost = LOST AND coalesce(charge_total, requested_amount, 0) <> 0 GROUP BY ALL"""

_LINE_TAXES = f"""SELECT {LINK},
    sum(tax_amount) FILTER (lower(process) NOT LIKE 'initial%' AND coalesce(header_tax_detail_id, '') = 'Shipping_1')
      AS ship_now,
    sum(tax_amount) FILTER (lower(process) NOT LIKE 'initial%' AND coalesce(header_tax_detail_id, '') <> 'Shipping_1')
      AS sales_now,
    sum(tax_amount) FILTER (lower(process) LIKE 'initial%' AND coalesce(header_tax_detail_id, '') <> 'Shipping_1')
      AS sales_first,
    max(tax_code) FILTER (lower(process) NOT LIKE 'initial%' AND coalesce(header_tax_detail_id, '') = 'Shipping_1')
      AS tax_code
  FROM src_taxes WHERE lost = LOST AND lower(tax_type_id) = 'sales' AND coalesce(tax_amount, 0) <> 0 GROUP BY ALL"""


def _of(text: str, lost: int) -> str:
    """The charges or taxes that stand, or the cancelled ones."""
    return text.replace("LOST", str(lost))


def _dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


@query(f"""WITH l AS (SELECT * FROM src_lines QUALIFY row_number() OVER (PARTITION BY org_id, order_id, order_line_id
    ORDER BY updated_timestamp DESC, pk DESC) = 1),
  c AS ({_of(_LINE_CHARGES, 0)}), lc AS ({_of(_LINE_CHARGES, 1)}),
  x AS ({_of(_LINE_TAXES, 0)}), lx AS ({_of(_LINE_TAXES, 1)}),
  rel AS (SELECT r.org_id, r.release_id, rl.release_line_id, coalesce(r.ship_from_location_id, a.ship_from_location_id)
      AS ship_from FROM src_releases r JOIN src_release_lines rl ON rl.org_id = r.org_id AND rl.release_pk = r.pk
    JOIN l ON l.org_id = r.org_id AND l.order_id = r.order_id AND l.order_line_id = rl.order_line_id
    LEFT JOIN src_allocations a ON a.org_id = r.org_id AND a.order_line_pk = l.pk AND a.allocation_id = rl.allocation_id),
  fd AS (SELECT f.org_id, f.order_line_pk, f.tracking_number, tr.package_status, rel.ship_from FROM
      src_fulfilment_details f LEFT JOIN src_tracking tr ON tr.org_id = f.org_id AND tr.tracking_number =
      f.tracking_number LEFT JOIN rel ON rel.org_id = f.org_id AND rel.release_id = f.release_id AND
      rel.release_line_id = f.release_line_id),
  po AS (SELECT org_id, pk AS order_line_pk, physical_origin_id AS promised FROM l WHERE quantity % 2 = 0),
  bo AS (SELECT DISTINCT org_id, pk AS order_line_pk FROM src_lines WHERE max_fulfillment_status_id = '1500.000'),
  n AS (SELECT {LINK}, '[{{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY k) || '}}]' AS notes FROM (
    SELECT {LINK}, replace(lower(note_type_id), ' ', '') AS k, max(note_text) AS v FROM src_notes GROUP BY ALL)
    GROUP BY ALL),
  j AS (SELECT l.*, o.order_total, o.order_type_id, c.*  EXCLUDE (org_id, order_line_pk), x.ship_now AS st_now,
      x.sales_now, x.sales_first, x.tax_code AS tcode, lc.coupon AS l_coupon, coalesce(lx.sales_first, lx.sales_now) AS l_sales,
      coalesce(fd.ship_from, po.promised, l.physical_origin_id) AS place0, fd.package_status, n.notes,
      bo.order_line_pk IS NOT NULL AS bo
    FROM l JOIN src_orders o ON o.org_id = l.org_id AND o.pk = l.order_pk
      LEFT JOIN c ON c.org_id = l.org_id AND c.order_line_pk = l.pk
      LEFT JOIN lc ON lc.org_id = l.org_id AND lc.order_line_pk = l.pk
      LEFT JOIN x ON x.org_id = l.org_id AND x.order_line_pk = l.pk
      LEFT JOIN lx ON lx.org_id = l.org_id AND lx.order_line_pk = l.pk
      LEFT JOIN fd ON fd.org_id = l.org_id AND fd.order_line_pk = l.pk
      LEFT JOIN po ON po.org_id = l.org_id AND po.order_line_pk = l.pk
      LEFT JOIN bo ON bo.org_id = l.org_id AND bo.order_line_pk = l.pk
      LEFT JOIN n ON n.org_id = l.org_id AND n.order_line_pk = l.pk),
  w AS (SELECT j.*, coalesce(h.store_number, place0) AS place FROM j LEFT JOIN src_warehouses h
    ON h.org_id = j.org_id AND h.warehouse_id = place0)
  SELECT w.pk AS order_line_pk, CAST(CAST(max_fulfillment_status_id AS DOUBLE) AS INTEGER) AS max_status,
    s.description AS max_status_desc, place AS ship_from_location, k1.location_type_id AS ship_from_type,
    package_status, tcode AS tax_code, reward AS loyalty_reward_id, coupons, fees AS fee_count, notes,
    {_dbl('coalesce(ship_first, ship_now)', 'shipping')}, {_dbl('ship_first', 'original_shipping')},
    {_dbl('coupon', 'coupon')}, {_dbl('promotion', 'promotion')}, {_dbl('return_fee', 'return_fee')},
    {_dbl('appeasement', 'appeasement')}, {_dbl('l_coupon', 'cancelled_coupon')}, {_dbl('st_now', 'shipping_tax')},
    {_dbl('coalesce(sales_first, sales_now)', 'sales_tax')}, {_dbl('l_sales', 'cancelled_sales_tax')},
    {_dbl('unit_price', 'original_unit_price')}, {_dbl("CASE WHEN order_line_sub_total = 0 AND item_id LIKE '%ECARD%' "
    "THEN coalesce(gift_card_value, 0) ELSE order_line_sub_total END", 'sub_total')},
    CASE WHEN round(coalesce(ship_now, 0)) = 0 THEN 1 ELSE 0 END AS is_free_shipping,
    CASE WHEN round(coalesce(base_ship, 0)) <> 0 THEN 1 ELSE 0 END AS is_base_shipping_charged,
    CASE WHEN coupons IS NOT NULL THEN 1 ELSE 0 END AS is_loyalty_discount, CASE WHEN bo THEN 1 ELSE 0 END AS is_backorder,
    CASE WHEN json_extract_string(json_store, '$.Fields."extend::LaunchSKUFlag"') <> 'false' THEN 1 ELSE 0 END
      AS is_launch_sku, CASE WHEN lower(shipping_method_id) = 'express' THEN 1 ELSE 0 END AS rush_flag,
    CASE WHEN order_type_id = 'SaveTheSale' AND is_return = 1 THEN 0 ELSE 1 END AS is_restockable,
    CASE WHEN max_fulfillment_status_id = '9000.000' THEN 'CR' || CAST(quantity % 5 AS VARCHAR) END AS cancel_reason_id,
    CASE WHEN item_id LIKE '%ECARD%' THEN 'E_GIFT_CARD' ELSE 'REGULAR' END AS product_type
  FROM w LEFT JOIN src_statuses s ON s.status = w.max_fulfillment_status_id AND s.profile_id = 'main' AND
      s.process_type_id = 'ORDER_EXECUTION'
    LEFT JOIN src_locations k1 ON k1.location_id = w.place""",
       uses=["src_lines", "src_orders", "src_charges", "src_taxes", "src_releases", "src_release_lines",
             "src_allocations", "src_fulfilment_details", "src_tracking", "src_warehouses", "src_locations",
             "src_statuses", "src_notes"])
def order_line_fact_rows(t: Inputs) -> DataFrame:
    """Order line fact: star join of a line with its charges, taxes, release, tracking,
    notes, status texts and places."""
    source = Source(t)
    fact = X.order_line_fact(source, INITIAL, PROFILE, PROFILE)
    fees = F.size(F.from_json("return_fees", "array<struct<amount:double>>"))
    return as_doubles(fact.select(
        "order_line_pk", "max_status", "max_status_desc", "ship_from_location", "ship_from_type", "package_status",
        "tax_code", "loyalty_reward_id", "coupons", F.when(F.col("coupons").isNotNull(), fees.cast("bigint"))
        .alias("fee_count"), "notes", "shipping", "original_shipping", "coupon", "promotion", "return_fee",
        "appeasement", "cancelled_coupon", "shipping_tax", "sales_tax", "cancelled_sales_tax",
        "original_unit_price", "sub_total", "is_free_shipping", "is_base_shipping_charged", "is_loyalty_discount",
        "is_backorder", "is_launch_sku", "rush_flag", "is_restockable", "cancel_reason_id", "product_type"))


def _header_check(orders: str) -> str:
    return f"""WITH o AS ({orders}),
  c AS (SELECT org_id, order_pk, sum(coalesce(charge_total, requested_amount)) FILTER ({_KIND} = 'promotion') AS promo,
      sum(charge_total) FILTER ({_KIND} = 'shipping' AND lower(process) LIKE 'initial%') AS ship_first,
      sum(charge_total) FILTER ({_KIND} = 'shipping' AND lower(process) NOT LIKE 'initial%') AS ship_now
    FROM src_charges WHERE lost = 0 AND {_KIND} IN ('coupon', 'promotion', 'shipping') AND
      coalesce(charge_total, requested_amount, 0) <> 0 GROUP BY ALL),
  x AS (SELECT org_id, order_pk, sum(tax_amount) FILTER (tax_detail_id = 'Shipping_1' AND lower(process) NOT LIKE
      'initial%') AS st FROM src_taxes WHERE lost = 0 AND lower(tax_type_id) = 'sales' AND tax_amount <> 0 GROUP BY ALL),
  pm AS (SELECT h.org_id, h.order_id, '["' || string_agg(DISTINCT m.payment_type, '","' ORDER BY m.payment_type) || '"]'
      AS types, max(CASE m.payment_type WHEN 'PayPal' THEN 1 ELSE 0 END) AS prepaid FROM src_payment_headers h
    JOIN src_payment_methods m ON m.org_id = h.org_id AND m.payment_header_pk = h.pk GROUP BY ALL),
  ps AS (SELECT org_id, order_id, sum(requested_refund_amount) AS asked, sum(returned) AS returned,
      sum(credit_amount) FILTER (lower(reference_type) = 'return credit' AND credit_amount > 0) AS credits
    FROM src_payment_summaries GROUP BY ALL),
  rf AS (SELECT h.org_id, h.order_id, sum(ps.asked) FILTER (m.kind IN ('credit card')) AS ask_card,
      sum(m.refund) FILTER (m.kind = 'paypal') AS act_wallet, sum(ps.asked) AS ask_all, sum(m.refund) AS act_all,
      sum(ps.credits) AS credits, count(*) AS n FROM src_payment_headers h LEFT JOIN (SELECT org_id, payment_header_pk,
      lower(payment_type) AS kind, current_refund_amount AS refund FROM src_payment_methods WHERE
      current_refund_amount > 0) m ON m.org_id = h.org_id AND m.payment_header_pk = h.pk LEFT JOIN ps ON ps.org_id =
      h.org_id AND ps.order_id = h.order_id GROUP BY ALL),
  tr AS (SELECT org_id, order_pk, arg_max(tracking_number, (updated_timestamp, pk)) AS tracking FROM src_tracking
    GROUP BY ALL),
  nt AS (SELECT org_id, order_pk, arg_max(note_text, (updated_timestamp, pk)) AS note FROM src_notes
    WHERE lower(note_type_id) = 'csaordernote' GROUP BY ALL),
  ex AS (SELECT org_id, order_pk FROM src_lines GROUP BY ALL HAVING sum(CASE WHEN is_gift_card = 0 AND is_return = 1
    THEN 1 ELSE 0 END) > 0)
  SELECT o.order_id, o.updated_timestamp AS updated_ts, s3.description AS max_status_desc,
    rs.description AS return_status_desc,
    CASE order_type_id WHEN 'Launch' THEN 'Transfer' ELSE 'CustomerOrder' END AS doc_type,
    re.description AS cancel_reason_desc, 'paid ' || payment_status_id AS payment_status_desc,
    CASE WHEN package_count = 1 THEN 'fraud' END AS hold_hold_type, tr.tracking AS tracking_number,
    nt.note AS service_note, pm.types AS payment_types, CAST(coalesce(pm.prepaid, 0) AS INTEGER) AS is_prepaid,
    'en_' || substr(o.org_id, 1, 2) AS locale, 'F' || substr(customer_first_name, 6) AS loyalty_number,
    CASE WHEN json_extract_string(json_store, '$.Fields."extend::LaunchSKUFlag"') <> 'false' THEN 1 ELSE 0 END
      AS is_launch_sku,
    {_dbl('c.promo', 'promotion')}, {_dbl('coalesce(c.ship_first, c.ship_now)', 'shipping')},
    {_dbl('x.st', 'shipping_tax')}, {_dbl('rf.ask_card', 'refund_card_requested')},
    {_dbl('rf.act_wallet', 'refund_wallet_actual')}, {_dbl('rf.act_all', 'refund_total_actual')},
    {_dbl('rf.credits', 'return_credits_actual')}, {_dbl('order_total - rf.act_all', 'return_adjustment_actual')},
    {_dbl('CASE WHEN ex.order_pk IS NOT NULL THEN rf.credits END', 'exchange_credit_actual')},
    CASE WHEN rf.n > 0 THEN rf.n END AS credit_count
  FROM o LEFT JOIN c ON c.org_id = o.org_id AND c.order_pk = o.pk LEFT JOIN x ON x.org_id = o.org_id AND x.order_pk = o.pk
    LEFT JOIN pm ON pm.org_id = o.org_id AND pm.order_id = o.order_id
    LEFT JOIN rf ON rf.org_id = o.org_id AND rf.order_id = o.order_id
    LEFT JOIN tr ON tr.org_id = o.org_id AND tr.order_pk = o.pk LEFT JOIN nt ON nt.org_id = o.org_id AND nt.order_pk =
      o.pk LEFT JOIN ex ON ex.org_id = o.org_id AND ex.order_pk = o.pk
    LEFT JOIN src_statuses s3 ON s3.status = o.max_fulfillment_status_id AND s3.process_type_id = 'ORDER_EXECUTION' AND
      s3.profile_id = 'main'
    LEFT JOIN src_statuses rs ON rs.status = o.max_return_status_id AND rs.process_type_id = 'RETURN_EXECUTION'
    LEFT JOIN src_reasons re ON re.reason_id = o.cancel_reason_id AND lower(re.profile_id) = 'main'"""


_HEADER_USES = ["src_orders", "src_charges", "src_taxes", "src_payment_headers", "src_payment_methods",
                "src_payment_summaries", "src_tracking", "src_notes", "src_lines", "src_statuses", "src_reasons"]


def _header_rows(source: Source) -> DataFrame:
    fact = X.order_header_fact(source, INITIAL, PROFILE)
    return as_doubles(fact.select(
        "order_id", F.col("updated_timestamp").alias("updated_ts"), "max_status_desc", "return_status_desc",
        "doc_type", "cancel_reason_desc", "payment_status_desc", "hold_hold_type", "tracking_number",
        "service_note", "payment_types", "is_prepaid", "locale", "loyalty_number", "is_launch_sku", "promotion",
        "shipping", "shipping_tax", "refund_card_requested", "refund_wallet_actual", "refund_total_actual",
        "return_credits_actual", "return_adjustment_actual", "exchange_credit_actual",
        _credit_count().alias("credit_count")))


def _credit_count():
    return F.size(F.from_json("credits_info", "array<struct<adjustmentType:int>>")).cast("bigint")


@query(_header_check("SELECT * FROM src_orders"), uses=_HEADER_USES)
def order_header_fact_rows(t: Inputs) -> DataFrame:
    """Order header fact: charges, taxes, payments, refunds, status texts and notes."""
    return _header_rows(Source(t))


@query(_header_check("""SELECT * FROM src_orders UNION ALL SELECT * REPLACE (updated_timestamp - INTERVAL 1 DAY AS
  updated_timestamp, '1000.000' AS max_fulfillment_status_id) FROM src_orders"""), uses=_HEADER_USES)
def order_header_history_rows(t: Inputs) -> DataFrame:
    """The same over the order history: one row per version of an order."""
    source = Source(t)
    now = t["src_orders"]
    earlier = now.withColumns({"updated_timestamp": F.col("updated_timestamp") - F.expr("interval 1 day"),
                               "max_fulfillment_status_id": F.lit("1000.000")})
    source["orders"] = now.unionByName(earlier)
    return _header_rows(source)


@query("""WITH base AS (SELECT t.org_id, t.order_id, t.pk, t.payment_method_pk, t.payment_transaction_id AS txn,
    t.transaction_type, t.follow_on_id, t.updated_timestamp AS uts, d.payment_transaction_detail_id AS dtl, d.amount,
    i.invoice_id, il.invoice_line_id, il.order_line_id, il.item_id, t.request_id FROM src_transactions t
    LEFT JOIN src_transaction_details d ON d.org_id = t.org_id AND d.payment_transaction_pk = t.pk
    LEFT JOIN src_invoices i ON i.org_id = t.org_id AND i.invoice_id = d.reference_id
    LEFT JOIN src_invoice_lines il ON il.org_id = i.org_id AND il.invoice_pk = i.pk),
  f AS (SELECT * FROM base WHERE invoice_id IS NOT NULL),
  j AS (SELECT b.org_id, b.order_id, b.pk, b.payment_method_pk, b.txn, b.transaction_type, b.amount, b.dtl,
      coalesce(b.invoice_id, f.invoice_id) AS invoice_id, coalesce(b.invoice_line_id, f.invoice_line_id)
      AS invoice_line_id, coalesce(b.order_line_id, f.order_line_id) AS order_line_id, coalesce(b.item_id, f.item_id)
      AS item_id FROM base b LEFT JOIN f ON f.org_id = b.org_id AND f.order_id = b.order_id AND f.request_id =
      b.follow_on_id AND b.invoice_id IS NULL AND lower(b.transaction_type) NOT IN ('authorization',
      'authorization reversal', 'settlement')
    QUALIFY row_number() OVER (PARTITION BY b.org_id, b.order_id, b.order_line_id, b.payment_method_pk, b.txn, b.dtl,
      b.invoice_id, b.invoice_line_id ORDER BY b.uts DESC, f.pk DESC, f.invoice_line_id DESC, b.pk DESC) = 1)
  SELECT j.pk AS payment_line_pk, j.transaction_type, j.invoice_id, j.invoice_line_id, j.order_line_id, j.item_id,
    CAST(coalesce(j.amount, 0) AS DOUBLE) AS transaction_amount, m.payment_type, 'paid ' || h.status
      AS payment_status_desc, CASE WHEN m.payment_type <> 'Gift Card' THEN m.vendor_id END AS billing_first_name,
    m.vendor_id AS avs_code
  FROM j JOIN src_payment_methods m ON m.org_id = j.org_id AND m.pk = j.payment_method_pk
    JOIN src_payment_headers h ON h.org_id = m.org_id AND h.pk = m.payment_header_pk""",
       uses=["src_transactions", "src_transaction_details", "src_invoices", "src_invoice_lines",
             "src_payment_methods", "src_payment_headers"])
def payment_line_fact_rows(t: Inputs) -> DataFrame:
    """Payment lines; follow-on refunds take the invoice line of what they follow."""
    fact = X.payment_line_fact(Source(t))
    return as_doubles(fact.select(
        "payment_line_pk", "transaction_type", "invoice_id", "invoice_line_id", "order_line_id", "item_id",
        "transaction_amount", "payment_type", "payment_status_desc",
        F.col("billing_address_firstname").alias("billing_first_name"), "avs_code"))


def _line_versions(t: Inputs) -> DataFrame:
    """Order line versions as the fact table holds them: closed by update time."""
    rows = t["src_lines"].select("org_id", "order_id", "order_line_id", F.col("pk").alias("order_line_pk"),
                                 F.col("updated_timestamp").alias("start_ts"), F.col("pk").alias("hash_sk"),
                                 F.col("max_fulfillment_status_id").alias("hash_seq_num"),
                                 F.lit(0).cast("decimal(38,0)").alias("batch_id"), F.lit("Y").alias("active_flg"),
                                 F.lit("Y").alias("reporting_flg"), F.lit(None).cast("timestamp_ntz").alias("end_ts"))
    return scd2_close(rows)


@query("""WITH rel AS (SELECT r.org_id, r.release_id, rl.order_line_id, rl.allocation_id FROM src_releases r
    JOIN src_release_lines rl ON rl.org_id = r.org_id AND rl.release_pk = r.pk QUALIFY row_number() OVER (PARTITION BY
    r.org_id, r.order_id, rl.order_line_id ORDER BY rl.updated_timestamp DESC, r.updated_timestamp DESC, rl.pk DESC) = 1)
  SELECT DISTINCT a.pk AS allocation_pk, l.order_line_id, CASE WHEN trim(a.status_id) <> '' THEN a.status_id END
      AS status_id, rel.release_id, CASE lower(a.status_id) WHEN 'open' THEN a.quantity ELSE 0 END AS open_quantity,
    CASE lower(a.status_id) WHEN 'released' THEN a.quantity ELSE 0 END AS released_quantity,
    CASE lower(a.status_id) WHEN 'open' THEN a.created_timestamp END AS opened_ts, q.demand_type
  FROM src_allocations a JOIN (SELECT DISTINCT org_id, pk, order_line_id FROM src_lines) l ON l.org_id = a.org_id AND
      l.pk = a.order_line_pk
    LEFT JOIN rel ON rel.org_id = a.org_id AND rel.order_line_id = l.order_line_id AND rel.allocation_id =
      a.allocation_id
    LEFT JOIN (SELECT DISTINCT org_id, reservation_request_id, 'web' AS demand_type FROM src_allocations WHERE
      CAST(substr(reservation_request_id, 3) AS BIGINT) % 2 = 0) q ON q.org_id = a.org_id AND
      q.reservation_request_id = a.reservation_request_id""",
       uses=["src_releases", "src_release_lines", "src_allocations", "src_lines"])
def allocation_fact_rows(t: Inputs) -> DataFrame:
    """Allocations of current order lines, with release, reservation and quantities."""
    even = F.substring("reservation_request_id", 3, 9).cast("bigint") % 2
    reservations = t["src_allocations"].select("org_id", "reservation_request_id").distinct().select(
        "org_id", F.col("reservation_request_id").alias("request_id"), F.when(even == 0, 1).otherwise(0)
        .alias("is_confirmed"), F.lit("p").alias("supply_profile_id"), F.lit(1).alias("reservation_version"),
        F.lit("x").alias("all_or_none"), F.lit("web").alias("demand_type"),
        F.lit(None).cast("timestamp_ntz").alias("reservation_expiry_date"))
    fact = X.allocation_fact(t["src_allocations"], _line_versions(t), t["src_releases"], t["src_release_lines"],
                             reservations)
    return fact.select("allocation_pk", "order_line_id", "status_id", "release_id", "open_quantity",
                       "released_quantity", "opened_ts", "demand_type")


# Fulfilment and stock ------------------------------------------------------------------

@query("""WITH p AS (SELECT * FROM src_packages QUALIFY row_number() OVER (PARTITION BY org_id, fulfillment_id
    ORDER BY src_load_ts DESC, pk DESC) = 1)
  SELECT f.pk, p.package_id, CAST(nullif(p.package_status, '') AS INTEGER) AS package_status,
    r.r_name AS package_status_desc, replace(re.fulfillment_reason_id, '.000', '') AS reason_id,
    re.fulfillment_reason_name AS reason_name, rt.r_name AS reason_type_name,
    s.description AS max_status_desc FROM src_fulfilments f
    LEFT JOIN p ON p.org_id = f.org_id AND p.fulfillment_id = f.fulfillment_id
    LEFT JOIN region r ON CAST(r.r_regionkey * 1000 AS VARCHAR) = p.package_status
    LEFT JOIN src_fulfilment_reasons re ON re.fulfillment_reason_id = f.cancel_reason_id
    LEFT JOIN region rt ON rt.r_regionkey IN (1, 2) AND CAST(rt.r_regionkey * 1000 AS VARCHAR) || '.000' =
      re.fulfillment_reason_type_id
    LEFT JOIN src_statuses s ON s.status = f.max_status_id AND s.process_type_id = 'FULFILLMENT_EXECUTION'""",
       uses=["src_fulfilments", "src_packages", "src_fulfilment_reasons", "src_statuses"])
def fulfilment_header_rows(t: Inputs) -> DataFrame:
    fact = U.fulfilment_header_fact(Source(t), PROFILE)
    return fact.select("pk", F.col("package_package_id").alias("package_id"), "package_status", "package_status_desc",
                       "reason_id", F.col("fulfillment_reason_name").alias("reason_name"), "reason_type_name",
                       "max_status_desc")


@query("""WITH fd AS (SELECT d.org_id, l.order_id, l.order_line_id, d.tracking_number FROM src_fulfilment_details d
    JOIN (SELECT DISTINCT org_id, order_id, order_line_id, pk FROM src_lines) l ON l.org_id = d.org_id AND l.pk =
    d.order_line_pk),
  pm AS (SELECT h.org_id, h.order_id, max(m.payment_method_id) AS payment_method_id FROM src_payment_headers h
    JOIN src_payment_methods m ON m.org_id = h.org_id AND m.payment_header_pk = h.pk GROUP BY ALL)
  SELECT f.pk, h.fulfillment_id, CAST(CAST(nullif(f.fulfillment_line_status_id, '') AS DOUBLE) AS INTEGER) AS line_status,
    s.description AS line_status_desc, fd.tracking_number, pm.payment_method_id,
    CASE WHEN f.ordered_qty % 3 = 0 THEN 'ASIA' END AS task_status_name,
    CASE WHEN f.cancel_reason_id IS NOT NULL THEN 'why ASIA' END AS cancel_reason_desc,
    i.p_size % 2 AS sold_in_stores,
    CASE WHEN f.ordered_qty % 4 = 0 AND f.fulfillment_line_status_id = '3000.000' THEN '2000.000'
      WHEN f.ordered_qty % 4 = 2 AND f.fulfillment_line_status_id = '4000.000' THEN '2000.000' END AS short_reason_id,
    CASE WHEN (f.ordered_qty % 4 = 0 AND f.fulfillment_line_status_id = '3000.000') OR (f.ordered_qty % 4 = 2 AND
      f.fulfillment_line_status_id = '4000.000') THEN 1 ELSE 0 END AS rejected_flg
  FROM src_fulfilment_lines f JOIN src_fulfilments h ON h.org_id = f.org_id AND h.pk = f.fulfillment_pk
    LEFT JOIN src_statuses s ON s.status = f.fulfillment_line_status_id AND s.process_type_id = 'FULFILLMENT_EXECUTION'
    LEFT JOIN fd ON fd.org_id = f.org_id AND fd.order_id = f.order_id AND fd.order_line_id = f.order_line_id
    LEFT JOIN pm ON pm.org_id = f.org_id AND pm.order_id = f.order_id
    LEFT JOIN part i ON lpad(CAST(i.p_partkey AS VARCHAR), 7, '0') = f.item_id""",
       uses=["src_fulfilment_details", "src_lines", "src_payment_headers", "src_payment_methods",
             "src_fulfilment_lines", "src_fulfilments", "src_statuses"])
def fulfilment_line_rows(t: Inputs) -> DataFrame:
    versions = _line_versions(t).filter("active_flg = 'Y'")
    fact = U.fulfilment_line_fact(Source(t), versions, PROFILE, PROFILE)
    return fact.select("pk", "fulfillment_id", "line_status", "line_status_desc", "tracking_number",
                       "payment_method_id", "task_status_name", "cancel_reason_desc", "sold_in_stores",
                       "short_reason_id", "rejected_flg")


@query("""WITH pt AS (SELECT h.org_id, h.order_id, '["' || string_agg(DISTINCT m.payment_type, '","' ORDER BY
    m.payment_type) || '"]' AS types FROM src_payment_headers h JOIN src_payment_methods m ON m.org_id = h.org_id AND
    m.payment_header_pk = h.pk GROUP BY ALL),
  inv AS (SELECT i.org_id, i.package_id, il.package_detail_id, i.invoice_id, il.invoice_line_id FROM src_invoices i
    JOIN src_invoice_lines il ON il.org_id = i.org_id AND il.invoice_pk = i.pk QUALIFY row_number() OVER (PARTITION BY
    i.org_id, i.package_id, il.package_detail_id ORDER BY il.updated_timestamp DESC, i.updated_timestamp DESC,
    il.pk DESC) = 1)
  SELECT d.pk, p.package_id, CAST(nullif(p.package_status, '') AS INTEGER) AS package_status,
    r.r_name AS package_status_desc, inv.invoice_id, inv.invoice_line_id, l.location_type_id AS ship_from_type,
    pt.types AS payment_types, 'AMERICA' AS task_type_name
  FROM src_package_details d JOIN src_packages p ON p.org_id = d.org_id AND p.pk = d.packages_pk
    LEFT JOIN region r ON CAST(r.r_regionkey * 1000 AS VARCHAR) = p.package_status
    LEFT JOIN inv ON inv.org_id = d.org_id AND inv.package_id = p.package_id AND inv.package_detail_id =
      d.package_detail_id
    LEFT JOIN src_locations l ON l.location_id = p.ship_from_location_id
    LEFT JOIN pt ON pt.org_id = p.org_id AND pt.order_id = p.order_id""",
       uses=["src_payment_headers", "src_payment_methods", "src_invoices", "src_invoice_lines",
             "src_package_details", "src_packages", "src_locations"])
def package_detail_rows(t: Inputs) -> DataFrame:
    fact = U.package_detail_fact(Source(t), t["src_locations"])
    return fact.select("pk", "package_id", "package_status", "package_status_desc", "invoice_id", "invoice_line_id",
                       "ship_from_type", "payment_types", "task_type_name")


@query("""WITH rl AS (SELECT r.order_id, r.release_id, r.ship_from_location_id AS head_from, r.ship_via_id AS head_via,
    rl.* FROM src_release_lines rl JOIN src_releases r ON r.org_id = rl.org_id AND r.pk = rl.release_pk),
  l AS (SELECT * FROM src_lines QUALIFY row_number() OVER (PARTITION BY org_id, order_id, order_line_id ORDER BY
    updated_timestamp DESC, pk DESC) = 1),
  ch AS (SELECT org_id, pk, 'CR' || CAST(quantity % 5 AS VARCHAR) AS reason FROM src_lines WHERE
    max_fulfillment_status_id = '9000.000'),
  j AS (SELECT rl.*, l.pk AS line_pk, CAST(CAST(fd.status_id AS DOUBLE) AS INTEGER) AS found, fd.tracking_number,
      coalesce(rl.head_from, a.ship_from_location_id) AS place0, coalesce(fd.ship_via_id, head_via) AS ship_via,
      fd.order_line_pk IS NOT NULL AS has_detail, tr.shipped_date AS tracked, fh.shipped_date AS fshipped
    FROM rl JOIN l ON l.org_id = rl.org_id AND l.order_id = rl.order_id AND l.order_line_id = rl.order_line_id
    LEFT JOIN src_allocations a ON a.org_id = rl.org_id AND a.order_line_pk = l.pk AND a.allocation_id = rl.allocation_id
    LEFT JOIN src_fulfilment_details fd ON fd.org_id = rl.org_id AND fd.release_id = rl.release_id AND
      fd.release_line_id = rl.release_line_id
    LEFT JOIN src_tracking tr ON tr.org_id = rl.org_id AND tr.tracking_number = fd.tracking_number
    LEFT JOIN (SELECT h.fulfillment_id, f.fulfillment_line_id, h.shipped_date FROM src_fulfilment_lines f JOIN
      src_fulfilments h ON h.org_id = f.org_id AND h.pk = f.fulfillment_pk) fh ON fh.fulfillment_id = rl.release_id AND
      fh.fulfillment_line_id = rl.release_line_id)
  SELECT j.pk AS release_line_pk, coalesce(found, 1000) AS status, CASE WHEN found IS NULL THEN 'CREATED' ELSE
      s.description END AS status_desc, coalesce(h.store_number, place0) AS ship_from_location, ship_via,
    CASE WHEN found = 7000 THEN coalesce(fshipped, tracked) END AS shipped_ts,
    CASE lower(k.location_type_id) WHEN 'store' THEN 'Store' WHEN 'supplier' THEN 'Dropship' WHEN 'dc' THEN 'DC' END
      AS fulfilment_type, 0 AS is_rejected
  FROM j LEFT JOIN src_warehouses h ON h.org_id = j.org_id AND h.warehouse_id = place0
    LEFT JOIN src_locations k ON k.location_id = place0 AND k.active_flg = 'Y'
    LEFT JOIN src_statuses s ON s.process_type_id = 'ORDER_EXECUTION' AND s.profile_id = 'main' AND
      s.status = CAST(found AS VARCHAR) || '.000'""",
       uses=["src_release_lines", "src_releases", "src_lines", "src_allocations", "src_fulfilment_details",
             "src_tracking", "src_fulfilment_lines", "src_fulfilments", "src_warehouses", "src_locations",
             "src_statuses"])
def release_detail_rows(t: Inputs) -> DataFrame:
    """Release lines with their fulfilment, place, ship date and kind."""
    source = Source(t)
    fact = U.release_detail_fact(source, t["src_locations"], PROFILE)
    return fact.select("release_line_pk", "status", "status_desc", "ship_from_location", "ship_via", "shipped_ts",
                       "fulfilment_type", "is_rejected")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS supply_pk, coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_partkey + 5 END, -1)
    AS supply_allocation_pk, CASE WHEN p_size % 3 = 0 THEN p_size ELSE 0 END AS on_hand_available,
    CASE WHEN p_size % 3 = 1 THEN p_size ELSE 0 END AS in_transit, CASE WHEN p_partkey % 10 % 8 <> 5 THEN
      CASE p_partkey % 10 % 3 WHEN 0 THEN 'Store' WHEN 1 THEN 'DC' ELSE 'Supplier' END END AS location_type_id
  FROM part""")
def inventory_supply_rows(t: Inputs) -> DataFrame:
    """Supply by type bucket, per allocation; supply without one has the mark -1."""
    kind = F.when(F.col("p_size") % 3 == 0, "On Hand Available").when(F.col("p_size") % 3 == 1, "In Transit").otherwise(
        "Other")
    supply = t["part"].select(F.col("p_partkey").cast("string").alias("pk"), kind.alias("supply_type"),
                              F.col("p_size").alias("quantity"),
                              (F.col("p_partkey") % 10).cast("string").alias("location_id"))
    given = t["part"].filter("p_partkey % 2 = 0").select(
        F.col("p_partkey").cast("string").alias("supply_pk"), (F.col("p_partkey") + 5).alias("pk"),
        F.lit(1).alias("allocated_quantity"), F.lit(None).cast("timestamp_ntz").alias("updated_timestamp"))
    fact = U.inventory_supply_fact(supply, given, t["src_locations"])
    return fact.select("supply_pk", "supply_allocation_pk", "on_hand_available", "in_transit", "location_type_id")


@query("""SELECT DISTINCT 'EX' || CAST(l_partkey % 100 AS VARCHAR) AS exclusion_id, l_returnflag AS exclusion_level,
  CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS updated_at, l_shipdate AS created_at, l_shipdate AS src_load_ts
  FROM lineitem""")
def sku_exclusion_rows(t: Inputs) -> DataFrame:
    rows = t["lineitem"].select(
        F.concat(F.lit("EX"), (F.col("l_partkey") % 100).cast("string")).alias("exclusion_id"),
        F.col("l_returnflag").alias("exclusion_level"),
        F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")).alias("updated_at"),
        F.col("l_shipdate").alias("created_at"))
    return U.sku_exclusion_fact(rows).select(
        "exclusion_id", "exclusion_level", "updated_at", "created_at", "src_load_ts")


# Dimensions ----------------------------------------------------------------------------

@query("""WITH o AS (SELECT * FROM src_orders WHERE customer_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY org_id,
    customer_id ORDER BY src_load_ts DESC, order_id DESC) = 1),
  b AS (SELECT h.org_id, h.order_id, max(m.pk) AS pk FROM src_payment_headers h JOIN src_payment_methods m ON m.org_id =
    h.org_id AND m.payment_header_pk = h.pk WHERE m.payment_type <> 'Gift Card' GROUP BY ALL)
  SELECT o.org_id, o.customer_id, o.order_id, upper(customer_first_name) AS customer_first_name, customer_phone,
    'F' || substr(customer_first_name, 6) AS loyalty_number, m.vendor_id AS billing_first_name,
    CASE WHEN b.pk IS NOT NULL THEN 'BILL' END AS billing_last_name,
    CASE WHEN package_count <> 2 THEN 'LEE' END AS shipping_last_name,
    CASE WHEN package_count <> 2 THEN '0x1' END AS shipping_phone
  FROM o LEFT JOIN b ON b.org_id = o.org_id AND b.order_id = o.order_id LEFT JOIN src_payment_methods m ON
    m.org_id = b.org_id AND m.pk = b.pk""", uses=["src_orders", "src_payment_headers", "src_payment_methods"])
def customer_dimension_rows(t: Inputs) -> DataFrame:
    rows = D.customer_dimension(Source(t))
    return rows.select(
        "org_id", "customer_id", "order_id", "customer_first_name", "customer_phone", "loyalty_number",
        F.col("billing_address_firstname").alias("billing_first_name"),
        F.col("billing_address_lastname").alias("billing_last_name"),
        F.col("shipping_address_lastname").alias("shipping_last_name"),
        F.col("shipping_address_phone").alias("shipping_phone"))


@query("SELECT s_suppkey AS user_pk, s_name AS user_id FROM supplier")
def employee_dimension_rows(t: Inputs) -> DataFrame:
    users = t["supplier"].select(F.col("s_suppkey").alias("pk"), F.col("s_name").alias("user_id"))
    return D.employee_dimension(users)


@query("""SELECT p_partkey AS item_pk, p_size AS max_discount_amount, CASE WHEN p_partkey % 4 = 0 THEN '{}' ELSE
  '{"UPC":"' || CAST(p_partkey AS VARCHAR) || '"}' END AS item_codes FROM part
  UNION ALL SELECT p_partkey, p_size, '{"EAN":"x"}' FROM part WHERE p_partkey % 4 = 1""")
def item_dimension_rows(t: Inputs) -> DataFrame:
    source = Source(t)
    parts = t["part"].filter("p_partkey % 4 <> 0")
    upc = parts.select(F.col("p_partkey").alias("item_pk"), F.lit("upc").alias("code_type_id"),
                       F.col("p_partkey").cast("string").alias("value"))
    ean = parts.filter("p_partkey % 4 = 1").select(F.col("p_partkey").alias("item_pk"),
                                                   F.lit("Ean").alias("code_type_id"), F.lit("x").alias("value"))
    source["item_codes"] = upc.unionByName(ean)
    source["handling_attributes"] = t["part"].select(F.col("p_partkey").alias("item_pk"), F.lit(0).alias("is_frozen"))
    return D.item_dimension(source).select("item_pk", "max_discount_amount", "item_codes")


@query("""SELECT s_suppkey AS location_pk, t.r_name AS location_type_name, st.n_name AS location_status_name,
    k.n_name AS location_sub_type_name, CASE WHEN s_suppkey % 2 = 0 THEN 'C' || CAST(s_suppkey AS VARCHAR) END
    AS location_contact_id, CASE WHEN s_suppkey % 2 = 0 THEN c.r_name END AS location_contact_type_name
  FROM supplier LEFT JOIN region t ON t.r_regionkey = s_suppkey % 7 LEFT JOIN nation st ON st.n_nationkey = s_nationkey
    LEFT JOIN nation k ON k.n_nationkey = s_suppkey % 30 LEFT JOIN region c ON c.r_regionkey = s_suppkey % 6""")
def location_dimension_rows(t: Inputs) -> DataFrame:
    """Locations with all their names; some types, sub-types and contact types are unknown."""
    key = F.col("s_suppkey")
    contacts = t["supplier"].select(
        key.alias("location_pk"), F.when(key % 2 == 0, F.concat(F.lit("C"), key.cast("string"))).otherwise(
            F.concat(F.lit("Test"), key.cast("string"))).alias("location_contact_id"),
        (key % 6).cast("string").alias("location_contact_type_id"))

    def named(table: str, number: str, text: str, name: str) -> DataFrame:
        return t[table].select(F.col(number).cast("string").alias(f"location_{name}_id"),
                               F.col(text).alias(f"location_{name}_name"), F.lower(text).alias(f"location_{name}_desc"))

    rows = D.location_dimension({
        "locations": t["supplier"].select(key.alias("pk"), key.cast("string").alias("location_id"),
                                          (key % 7).cast("string").alias("location_type_id"),
                                          F.col("s_nationkey").cast("string").alias("location_status_id"),
                                          (key % 30).cast("string").alias("location_sub_type_id")),
        "location_statuses": named("nation", "n_nationkey", "n_name", "status"),
        "location_types": named("region", "r_regionkey", "r_name", "type"),
        "location_sub_types": named("nation", "n_nationkey", "n_name", "sub_type"),
        "location_contacts": contacts,
        "location_contact_types": named("region", "r_regionkey", "r_name", "contact_type")})
    return rows.select("location_pk", "location_type_name", "location_status_name", "location_sub_type_name",
                       "location_contact_id", "location_contact_type_name")


@query("""SELECT n_nationkey AS org_pk, n_name AS org_id, CASE WHEN n_nationkey % 2 = 0 THEN 'P' || CAST(n_regionkey AS
  VARCHAR) END AS parent_organization_id FROM nation""")
def organisation_dimension_rows(t: Inputs) -> DataFrame:
    organisations = t["nation"].select(F.col("n_nationkey").alias("pk"), F.col("n_name").alias("organization_id"))
    links = t["nation"].filter("n_nationkey % 2 = 0").select(
        F.col("n_nationkey").alias("organization_pk"), F.col("n_nationkey").alias("pk"),
        F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("parent_organization_id"),
        F.col("n_name").alias("child_organization_id"))
    return D.organisation_dimension(organisations, links).select("org_pk", "org_id", "parent_organization_id")


@query("""SELECT c.p_partkey AS pk, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS item_promo_group,
  CASE WHEN p_partkey % 4 = 0 THEN 'if' END AS item_promo_condition, CASE WHEN p_size % 2 = 0 THEN 'even' END
  AS promo_type_desc, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS combo_min_units FROM part c""")
def promotion_dimension_rows(t: Inputs) -> DataFrame:
    profile, promo = F.lit("main").alias("profile_id"), F.col("p_partkey").cast("string").alias("promo_id")
    rows = D.promotion_dimension({
        "combo_promotions": t["part"].select(profile, promo, F.col("p_partkey").alias("pk"),
                                             (F.col("p_size") % 2).cast("string").alias("promo_type")),
        "combo_qualifiers": t["part"].filter("p_partkey % 3 = 0").select(
            profile, F.col("p_partkey").alias("combo_promotion_config_pk"), F.col("p_size").alias("min_units")),
        "item_promotions": t["part"].filter("p_partkey % 2 = 0").select(
            profile, promo, F.col("p_partkey").alias("pk"), F.col("p_name").alias("promo_group")),
        "item_qualifiers": t["part"].filter("p_partkey % 4 = 0").select(
            profile, F.col("p_partkey").alias("item_promotion_config_pk"), F.lit("if").alias("promo_condition"),
            F.lit("q").alias("qualifier_desc")),
        "promotion_types": t["region"].filter("r_regionkey = 0").select(
            profile, F.lit("0").alias("promo_type_id"), F.lit("even").alias("description"))})
    return rows.select("pk", "item_promo_group", "item_promo_condition", "promo_type_desc", "combo_min_units")


# Availability ----------------------------------------------------------------------------

def _network_check(message: str) -> str:
    return f"""SELECT * REPLACE (trim(item_id) AS item_id) FROM src_network WHERE message_type = '{message}' QUALIFY
      row_number() OVER (PARTITION BY trim(item_id), updated_ts, selling_channel, message_type ORDER BY header_ts DESC,
      load_ts DESC, row_id DESC) = 1"""


_ALERT, _FULL = "networkAvailabilityAlert", "networkFullAvailabilitySync"


def _ordered_feed(t: Inputs, name: str) -> DataFrame:
    """Feed rows with a load time that no two share, so that ties cannot arise."""
    return t[name].withColumn("load_ts", F.col("load_ts") + F.make_dt_interval(secs=F.col("row_id") % 86000))


@query(f"""SELECT item_id, updated_ts, selling_channel, CAST(coalesce(atp, 0) AS DOUBLE) AS atp,
    CAST(CASE WHEN coalesce(atp, 0) = 0 THEN 0 ELSE coalesce(warehouse_atp, 0) END AS DOUBLE) AS warehouse_atp,
    CAST(CASE WHEN coalesce(atp, 0) = 0 THEN 0 ELSE coalesce(dropship_atp, 0) END AS DOUBLE) AS dropship_atp
  FROM (SELECT * FROM (SELECT * REPLACE (trim(item_id) AS item_id, load_ts + to_seconds(row_id % 86000) AS load_ts)
    FROM src_network) WHERE message_type = '{_FULL}' QUALIFY row_number() OVER (PARTITION BY item_id, updated_ts,
    selling_channel, message_type ORDER BY header_ts DESC, load_ts DESC) = 1)""", uses=["src_network"])
def network_feed_rows(t: Inputs) -> DataFrame:
    rows = V.network_feed(_ordered_feed(t, "src_network"), V.NETWORK_FULL)
    return as_doubles(rows.select("item_id", "updated_ts", "selling_channel", "atp", "warehouse_atp",
                                  "dropship_atp"))


@query("""SELECT item_id, location_id, updated_ts, selling_channel, row_id FROM (SELECT * REPLACE (load_ts +
  to_seconds(row_id % 86000) AS load_ts) FROM src_location_feed) WHERE message_type = 'locationAvailabilityDeltaSync'
  AND location_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY item_id, location_id, updated_ts, message_type,
  selling_channel ORDER BY header_ts DESC, load_ts DESC) = 1""", uses=["src_location_feed"])
def location_feed_rows(t: Inputs) -> DataFrame:
    rows = V.location_feed(_ordered_feed(t, "src_location_feed"), V.LOCATION_DELTA)
    return rows.select("item_id", "location_id", "updated_ts", "selling_channel", "row_id")


_TODAY = datetime(2000, 6, 1)


@query("""SELECT sha256(strftime(updated_ts, '%Y-%m-%d %H:%M:%S') || chr(1) || item_id || chr(1) || message_type || chr(1)
    || selling_channel || chr(1) || CAST(coalesce(atp, 0) AS VARCHAR)) AS hash_sk, message_type, load_ts AS start_ts,
  'Y' AS active_flg, count(*) AS n FROM (SELECT * FROM (SELECT * REPLACE (trim(item_id) AS item_id, load_ts +
    to_seconds(row_id % 86000) AS load_ts) FROM src_network) WHERE message_type IN ('networkFullAvailabilitySync',
    'networkAvailabilityAlert') QUALIFY row_number() OVER (PARTITION BY item_id, updated_ts, selling_channel,
    message_type ORDER BY header_ts DESC, load_ts DESC) = 1)
  WHERE (message_type = 'networkAvailabilityAlert' AND load_ts >= TIMESTAMP '2000-05-31')
    OR (message_type = 'networkFullAvailabilitySync' AND load_ts >= TIMESTAMP '2000-05-30') GROUP BY ALL""",
       uses=["src_network"])
def network_fact_rows(t: Inputs) -> DataFrame:
    """Alerts and full syncs with their own lookbacks, staged for type 2."""
    feed = _ordered_feed(t, "src_network")
    fact = V.network_fact(V.network_feed(feed, V.NETWORK_ALERT), V.network_feed(feed, V.NETWORK_FULL), _TODAY)
    return fact.groupBy("hash_sk", "message_type", "start_ts", "active_flg").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT item_id, location_id, message_type, load_ts AS start_ts FROM (SELECT * REPLACE (load_ts +
    to_seconds(row_id % 86000) AS load_ts) FROM src_location_feed) WHERE location_id IS NOT NULL
  AND load_ts >= TIMESTAMP '2000-05-31' QUALIFY row_number() OVER (PARTITION BY item_id, location_id, updated_ts,
  message_type, selling_channel ORDER BY header_ts DESC, load_ts DESC) = 1""", uses=["src_location_feed"])
def location_fact_rows(t: Inputs) -> DataFrame:
    feed = _ordered_feed(t, "src_location_feed")
    fact = V.location_fact(V.location_feed(feed, V.LOCATION_DELTA), V.location_feed(feed, V.LOCATION_FULL), _TODAY)
    return fact.select("item_id", "location_id", "message_type", "start_ts")


_NETWORK_CHANNEL = """CASE selling_channel WHEN 'FL-US - ShipToHome' THEN 'FL_US_ECOMM' WHEN 'FL-US - BOPIS' THEN
  'FL_US_RETAIL' WHEN 'FL-CA - ShipToHome' THEN 'FL_CA_ECOMM' WHEN 'KFL-CA - ShipToHome' THEN 'KIDS_CA_ECOMM'
  ELSE selling_channel END"""

_PUBLISHED_NETWORK = f"""SELECT DISTINCT CASE p.banner_id WHEN '81' THEN p.online_us_sku || '-' || p.online_us_sku_size
      WHEN '98' THEN p.online_ca_sku || '-' || p.online_ca_sku_size END AS product_id, p.sku_number AS gtin,
    {_NETWORK_CHANNEL} AS selling_channel, CASE WHEN atp > 0 THEN 'true' ELSE 'false' END AS available,
    CASE WHEN store_atp > 0 THEN 'true' ELSE 'false' END AS available_in_store,
    strftime(updated_ts, '%Y-%m-%dT%H:%M:%S') || '.000' AS update_time, CAST(atp AS VARCHAR) AS total_atp,
    load_ts, message_type
  FROM src_network n LEFT JOIN products p ON trim(p.global_size_id) = trim(n.item_id) AND p.banner_id =
    CASE WHEN n.selling_channel LIKE 'FL-CA%' OR n.selling_channel LIKE 'CH-CA%' THEN '98' ELSE '81' END"""


@query(_PUBLISHED_NETWORK, uses=["src_network", "products"])
def publish_network_rows(t: Inputs) -> DataFrame:
    return V.publish_network(t["src_network"], t["products"]).select(
        "product_id", "gtin", "selling_channel", "available", "available_in_store", "update_time", "total_atp",
        "load_ts", "message_type").distinct()


@query(f"""SELECT product_id, gtin, selling_channel, message_type, max(update_time) AS update_time
  FROM ({_PUBLISHED_NETWORK}) GROUP BY 1, 2, 3, 4""", uses=["src_network", "products"])
def load_published_network(t: Inputs) -> DataFrame:
    """History append and upsert of the newest row per published key, in two loads."""
    table = BucketTable(t.spark, new_folder(t, "network"), V.NETWORK_PUBLISH_KEY, buckets=8)
    history = new_folder(t, "network-history")
    # as if loaded over twelve days, the second half first
    loaded = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.month("load_ts"), F.lit(0), F.lit(0), F.lit(0))
    rows = V.publish_network(t["src_network"].withColumn("load_ts", loaded), t["products"])
    middle = F.lit(datetime(2024, 1, 7)).cast("timestamp_ntz")
    V.load_published(rows.filter(F.col("load_ts") >= middle), table, history, V.NETWORK_PUBLISH_KEY, batch=1)
    V.load_published(rows.filter(F.col("load_ts") < middle), table, history, V.NETWORK_PUBLISH_KEY, batch=2)
    if t.spark.read.parquet(history).count() != rows.count():
        raise AssertionError("the history is not whole")
    return table.read().select("product_id", "gtin", "selling_channel", "message_type", "update_time")


@query("""SELECT DISTINCT st.store_number AS location_id, upper(pl.type) AS location_type,
    CASE selling_channel WHEN 'FL-US - ShipToHome' THEN 'FL_US_ECOMM' WHEN 'FL-US - BOPIS' THEN 'FL_US_ECOMM' WHEN
      'FL-CA - ShipToHome' THEN 'FL_CA_ECOMM' WHEN 'CH-CA - BOPIS' THEN 'CHP_CA_ECOMM' WHEN 'KFL-CA - ShipToHome' THEN
      'KIDS_CA_ECOMM' ELSE selling_channel END AS selling_channel, p.sku_number AS gtin,
    trim(concat_ws('-', CASE WHEN upper(selling_channel) LIKE '%CA%' THEN p.online_ca_sku ELSE p.online_us_sku END,
      p.legacy_size_desc)) AS product_id, CASE WHEN selling_channel ILIKE '%bopis%' THEN 'PICK' WHEN selling_channel ILIKE
      '%shiptohome%' THEN 'SHIP' END AS fulfilment_type, CAST(atp AS VARCHAR) AS atp,
    CASE status WHEN 'AVAILABLE' THEN 'GREEN' ELSE 'RED' END AS atp_status,
    strftime(updated_ts, '%Y-%m-%dT%H:%M:%S') || '.000000000' AS update_time, load_ts
  FROM src_location_feed f LEFT JOIN places pl ON pl.location_id = f.location_id
    LEFT JOIN products p ON trim(p.global_size_id) = trim(f.item_id) AND p.banner_id = CASE WHEN upper(selling_channel)
      LIKE '%CA%' THEN '98' ELSE '81' END
    LEFT JOIN (SELECT lpad(short_number, 5, '0') AS padded, store_number FROM stores WHERE upper(banner_geo) = 'NA'
      QUALIFY row_number() OVER (PARTITION BY lpad(short_number, 5, '0') ORDER BY location_sk DESC, location_seq DESC)
      = 1) st ON st.padded = lpad(f.location_id, 5, '0')
  WHERE message_type = 'locationAvailabilityDeltaSync'""", uses=["src_location_feed", "places", "products", "stores"])
def publish_location_rows(t: Inputs) -> DataFrame:
    rows = V.publish_location(t["src_location_feed"], t["products"], t["places"], t["stores"])
    return rows.select("location_id", "location_type", "selling_channel", "gtin", "product_id", "fulfilment_type",
                       "atp", "atp_status", "update_time", "load_ts")


# Products -----------------------------------------------------------------------------

@query("""SELECT lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS global_size_id, CASE p_partkey % 3 WHEN 0 THEN '81' WHEN 1
  THEN '98' ELSE '03' END AS banner_id, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS current_price,
  p_partkey % 2 = 0 AS is_discountable, '["' || p_brand || '"]' AS all_upcs FROM part""")
def product_master_rows(t: Inputs) -> DataFrame:
    """Product documents as typed columns; a price that is no number is null."""
    return product_master(t["src_product_documents"]).select(
        "global_size_id", "banner_id", "current_price", "is_discountable", "all_upcs")


@query("""SELECT DISTINCT banner_id AS banner, trim(global_size_id) AS size_id, online_us_sku AS sku FROM products
    WHERE banner_id IN ('81', '98')
  UNION ALL SELECT DISTINCT CASE banner_id WHEN '03' THEN 'FL-US' WHEN '16' THEN 'KFL-US' WHEN '18' THEN 'CH-US'
    WHEN '76' THEN 'FL-CA' ELSE 'CH-CA' END, trim(global_size_id), trim(legacy_sku) || '-' || trim(legacy_size_code)
    FROM products WHERE banner_id NOT IN ('81', '98')""", uses=["products"])
def product_projections(t: Inputs) -> DataFrame:
    """Distinct products of the online banners and of the store divisions."""
    online = banner_products(t["products"], ["online_us_sku"]).toDF("banner", "size_id", "sku")
    division = division_products(t["products"]).select(
        F.col("division_org").alias("banner"), F.col("division_size_id").alias("size_id"),
        F.col("division_sku").alias("sku"))
    return online.unionByName(division)


@query("""SELECT order_line_pk, order_line_id, delivery_method, physical_origin FROM (SELECT pk AS order_line_pk,
  order_line_id, delivery_method_id AS delivery_method, physical_origin_id AS physical_origin FROM src_lines)""",
       uses=["src_lines"])
def fact_columns_for_marts(t: Inputs) -> DataFrame:
    rows = mart_lines(t["src_lines"].withColumnRenamed("pk", "order_line_pk"))
    return rows.select("order_line_pk", "order_line_id", "delivery_method", "physical_origin")
