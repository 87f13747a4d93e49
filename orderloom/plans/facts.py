"""Order facts: header, line, payment line, allocation.

Every function takes current or historic source tables by name, returns one row per
natural key, and leaves versioning to ``operators.history``. Source columns without a
rule of their own pass through under their own name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import between_marks, blank_to_null, status_or_null
from orderloom.operators.aggregate import distinct_text, max_if, newest_if, pack_ordered, pivot_notes, sum_if
from orderloom.operators.history import current_only
from orderloom.operators.joins import lookup_join, prefixed
from orderloom.operators.latest import latest_per_key, newest
from orderloom.operators.nested import with_json_fields
from orderloom.plans.amounts import LINE_KEY, ORDER_KEY

Tables = Mapping[str, DataFrame]

ORDER_LINK, LINE_LINK = ("org_id", "order_pk"), ("org_id", "order_line_pk")
CHARGE_KINDS = ("shipping", "appeasement", "promotion", "coupon", "return fee", "discount")
# Appeasement reasons that point back to the original order.
SERVICE_REASONS = ("csarefund", "customer service credit", "customerservice", "lost/damaged package credit",
                   "wrong item", "missing items credit")
CARD_REFUNDS = ("credit card", "in store credit card")
UNSETTLED = ("authorization", "authorization reversal", "settlement")
NOT_SHIPPED_TAX = "Shipping_1"


def newest_of(df: DataFrame, keys: Sequence[str], columns: Sequence[str], stamp: str = "updated_timestamp",
              prefix: str = "") -> DataFrame:
    """Columns of the newest row per key; ``pk`` breaks ties where the table has one."""
    tie = ["pk"] if "pk" in df.columns else []
    rows = latest_per_key(df, keys, newest(stamp, *tie))
    return prefixed(rows, prefix, keys=keys, only=columns)


def for_profile(df: DataFrame, profile: str | None) -> DataFrame:
    return df if profile is None else df.filter(F.lower("profile_id") == profile.lower())


def _original(prefix: str) -> Column:
    """Rows that a process wrote when the order was first captured."""
    return F.lower("process").startswith(prefix.lower())


# Charges and taxes ---------------------------------------------------------------

def charge_sums(charges: DataFrame, keys: Sequence[str], original_process: str,
                kinds: Sequence[str] = CHARGE_KINDS) -> DataFrame:
    """Charge totals per key and kind, captured shipping apart from later changes."""
    rows = _charges(charges, kinds)
    kind, first = F.lower("charge_type_id"), _original(original_process)
    either = F.coalesce("charge_total", "requested_amount")
    return rows.groupBy(*keys).agg(
        sum_if((kind == "shipping") & ~first, "charge_total").alias("changed_shipping"),
        sum_if((kind == "shipping") & first, "charge_total").alias("original_shipping"),
        sum_if(kind == "coupon", either).alias("coupon"),
        sum_if(kind == "promotion", either).alias("promotion"),
        sum_if(kind == "discount", either).alias("discount_charge"),
    ).withColumn("shipping", F.coalesce("original_shipping", "changed_shipping"))


def _charges(charges: DataFrame, kinds: Sequence[str]) -> DataFrame:
    either = F.coalesce("charge_total", "requested_amount", F.lit(0))
    return charges.filter(F.lower("charge_type_id").isin(*kinds) & (either != 0))


def line_charge_details(charges: DataFrame, original_process: str) -> DataFrame:
    """Per line: charge sums, newest reasons, and the coupon and return-fee arrays."""
    rows = _charges(charges, CHARGE_KINDS)
    kind = F.lower("charge_type_id")
    whole_appeasement = (kind == "appeasement") & F.col("parent_charge_detail_id").isNull()
    at = F.struct("updated_timestamp", "charge_detail_id")
    extra = rows.groupBy(*LINE_LINK).agg(
        sum_if((kind == "shipping") & ~_original(original_process), "original_charge_amount")
        .alias("base_shipping"),
        sum_if(kind == "return fee", "charge_total").alias("return_fee"),
        sum_if(whole_appeasement, "charge_total").alias("appeasement"),
        newest_if("charge_detail_id", at, kind == "coupon").alias("loyalty_reward_id"),
        newest_if("tax_code", at, whole_appeasement).alias("appeasement_tax_code"),
        newest_if("reason_id", at, whole_appeasement).alias("appeasement_reason"),
        newest_if("charge_display_name", at, kind == "promotion").alias("price_override_reason"))

    # the largest charge first; equal ones by reference, then by id
    order = {"_size": -F.abs("charge_total"), "_reference": F.col("charge_reference_detail_id"),
             "_id": F.col("charge_detail_id")}
    amount = F.abs(F.coalesce("charge_total", "requested_amount"))
    code = F.when(kind == "coupon", F.coalesce("charge_reference_detail_id", between_marks("charge_detail_id"))
                  ).otherwise(F.col("charge_detail_id"))
    coupon = F.when(kind.isin("coupon", "promotion", "discount") | whole_appeasement, F.struct(
        code.alias("couponCode"), F.upper("charge_display_name").alias("promoGroup"),
        F.col("charge_reference_id").alias("promoCode"), amount.alias("amount")))
    fee = F.when(kind == "return fee", F.struct(
        F.lit(2).alias("adjustmentType"), F.lit("RETURN LABEL FEE").alias("adjustmentTypeDesc"),
        F.lit("NA").alias("adjustmentTypeId"), F.abs("charge_total").alias("amount"),
        F.lit("NA").alias("override")))
    coupons = pack_ordered(rows, LINE_LINK, order, coupon, "_coupons")
    fees = pack_ordered(rows, LINE_LINK, order, fee, "_fees")
    joined = (extra.join(charge_sums(charges, LINE_LINK, original_process), list(LINE_LINK))
              .join(coupons, list(LINE_LINK), "left").join(fees, list(LINE_LINK), "left"))
    return joined.withColumns({
        "coupons": F.coalesce(F.to_json("_coupons"), F.lit("[]")),
        "return_fees": F.coalesce(F.to_json("_fees"), F.lit("[]")),
    }).drop("_coupons", "_fees")


def tax_sums(taxes: DataFrame, keys: Sequence[str], original_process: str, detail: str = "header_tax_detail_id"
             ) -> DataFrame:
    """Sales tax and shipping tax per key, captured amounts apart from later ones."""
    rows = taxes.filter((F.lower("tax_type_id") == "sales") & (F.coalesce("tax_amount", F.lit(0)) != 0))
    shipping = F.coalesce(F.col(detail), F.lit("")) == NOT_SHIPPED_TAX
    first = _original(original_process)
    return rows.groupBy(*keys).agg(
        sum_if(~first & shipping, "tax_amount").alias("changed_shipping_tax"),
        sum_if(~first & ~shipping, "tax_amount").alias("changed_sales_tax"),
        max_if(~first & shipping, "tax_code").alias("tax_code"),
        sum_if(first & shipping, "tax_amount").alias("original_shipping_tax"),
        sum_if(first & ~shipping, "tax_amount").alias("original_sales_tax"),
    ).withColumns({"shipping_tax": F.coalesce("original_shipping_tax", "changed_shipping_tax"),
                   "sales_tax": F.coalesce("original_sales_tax", "changed_sales_tax")}
                  ).drop("changed_shipping_tax", "changed_sales_tax")


def _cancelled(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return prefixed(df, "cancelled_", keys=keys)


# Header --------------------------------------------------------------------------

# Fields of the JSON column of an order, with their types.
HEADER_JSON = {"locale": ("extend::OrderLocale", "string"), "loyalty_number": ("extend::FLX-ID", "string"),
               "browser_ip": ("extend::browserIp", "string"),
               "cart_company_number": ("extend::CartCompanyNumber", "string"),
               "store_order_id": ("extend::ReplacedOrder", "string"),
               "shopping_cart_id": ("extend::ShoppingCartId", "string"),
               "associate_number": ("extend::AssociateNumber", "string"),
               "user_agent": ("extend::userAgent", "string"), "channel": ("extend::source", "string"),
               "cancelled_charges": ("CancelledTotalCharges", "string"),
               "cancelled_taxes": ("CancelledTotalTaxes", "string"),
               "_launch": ("extend::LaunchSKUFlag", "string")}


def payment_profile(tables: Tables, profile: str | None) -> DataFrame:
    """Payment types of an order as sorted text, with currency, vendor and prepaid flag."""
    types = for_profile(tables["payment_types"], profile).select(
        F.col("payment_type_id").alias("payment_type"), "is_prepaid")
    methods = tables["payment_methods"].select(
        "org_id", F.col("payment_header_pk").alias("_header"), "payment_type", "currency_code", "vendor_id")
    heads = tables["payment_headers"].select("org_id", F.col("pk").alias("_header"), "order_id")
    rows = heads.join(methods, ["org_id", "_header"]).join(types, "payment_type", "left")
    summary = rows.groupBy(*ORDER_KEY).agg(F.max("currency_code").alias("payment_currency"),
                                           F.max("vendor_id").alias("vendor_id"),
                                           F.max("is_prepaid").alias("is_prepaid"))
    texts = distinct_text(rows, ORDER_KEY, "payment_type", "payment_types")
    return summary.join(texts, list(ORDER_KEY), "left")


def refund_credits(tables: Tables) -> DataFrame:
    """Requested and actual refunds per order by payment type, and its credits.

    Refunds are counted per payment method with a current refund, against the order's
    payment summary.
    """
    asked = (F.col("requested_refund_amount") > 0) | (F.col("returned") != 0)
    credit = F.lower("reference_type") == "return credit"
    summary = tables["payment_summaries"].groupBy(*ORDER_KEY).agg(
        sum_if(asked, "requested_refund_amount").alias("_asked"), sum_if(asked, "returned").alias("_returned"),
        sum_if((F.col("credit_amount") > 0) & credit, "credit_amount").alias("_credits"))
    heads = tables["payment_headers"].select("org_id", F.col("pk").alias("_header"), "order_id")
    methods = tables["payment_methods"].filter(F.col("current_refund_amount") > 0).select(
        "org_id", F.col("payment_header_pk").alias("_header"), F.lower("payment_type").alias("_kind"),
        F.col("current_refund_amount").alias("_refund"))
    rows = (heads.join(methods, ["org_id", "_header"], "left").join(summary, list(ORDER_KEY), "left"))
    card, wallet = F.col("_kind").isin(*CARD_REFUNDS), F.col("_kind") == "paypal"
    sums = rows.groupBy(*ORDER_KEY).agg(
        sum_if(card, "_asked").alias("refund_card_requested"),
        sum_if(wallet, "_asked").alias("refund_wallet_requested"),
        sum_if(card, "_refund").alias("refund_card_actual"),
        sum_if(wallet, "_refund").alias("refund_wallet_actual"),
        F.sum("_asked").alias("refund_total_requested"), F.sum("_refund").alias("refund_total_actual"),
        F.sum("_returned").alias("return_total_actual"),
        F.sum("_credits").alias("return_credits_requested"),
        F.sum("_credits").alias("return_credits_actual"))
    item = F.struct(F.lit(101).alias("adjustmentType"), F.lit("NA").alias("adjustmentTypeDesc"),
                    F.lit("NA").alias("adjustmentTypeId"), F.abs("_credits").alias("amount"),
                    F.lit("NA").alias("override"))
    listed = pack_ordered(rows, ORDER_KEY, {"_size": -F.abs("_credits"), "_id": F.col("_header")}, item,
                          "_credits_info")
    return sums.join(listed, list(ORDER_KEY), "left").withColumn(
        "credits_info", F.to_json("_credits_info")).drop("_credits_info")


def exchanged_or_returned(lines: DataFrame) -> DataFrame:
    """Orders with at least one returned line that is no gift card."""
    hit = F.when((F.col("is_gift_card") == 0) & (F.col("is_return") == 1), 1).otherwise(0)
    return (lines.groupBy(*ORDER_LINK).agg(F.sum(hit).alias("_hits")).filter("_hits > 0")
            .select(*ORDER_LINK, F.lit(True).alias("has_return")))


def line_statuses(tables: Tables, profile: str | None) -> DataFrame:
    """Descriptions of the order statuses, one per status; of several the last in order."""
    return (for_profile(tables["statuses"], profile).filter(F.lower("process_type_id") == "order_execution")
            .groupBy(status_or_null("status").alias("_status")).agg(F.max("description").alias("description")))


def order_header_fact(tables: Tables, original_process: str, profile: str | None = None) -> DataFrame:
    """One row per order from the order table and its details. Key: org_id, order_id."""
    orders = tables["orders"]
    keyed = orders.withColumn("order_pk", F.col("pk"))
    statuses = for_profile(tables["statuses"], profile).select(
        status_or_null("status").alias("_status"), F.lower("process_type_id").alias("_process"),
        F.col("description"))

    def described(df: DataFrame, column: str, process: str, name: str) -> DataFrame:
        table = statuses.filter(F.col("_process") == process).select("_status", F.col("description").alias(name))
        return lookup_join(df, table, status_or_null(column) == F.col("_status")).drop("_status")

    rows = described(keyed, "min_fulfillment_status_id", "order_execution", "min_status_desc")
    rows = described(rows, "max_fulfillment_status_id", "order_execution", "max_status_desc")
    rows = described(rows, "max_return_status_id", "return_execution", "return_status_desc")

    kinds = for_profile(tables["order_types"], profile).select(
        F.col("order_type_id").alias("_kind"), F.col("doc_type_id").alias("doc_type"))
    reasons = for_profile(tables["reasons"], profile).select(
        F.col("reason_id").alias("_reason"), F.col("description").alias("cancel_reason_desc"))
    paid = tables["payment_statuses"].select(status_or_null("status_id").alias("_paid"),
                                             F.col("status_name").alias("payment_status_desc"))
    notes = tables["order_notes"].filter(F.lower("note_type_id") == "csaordernote")
    order_kinds = ("coupon", "promotion", "shipping")
    charges = charge_sums(tables["order_charges"], ORDER_LINK, original_process, order_kinds)
    lost_charges = charge_sums(tables["cancelled_order_charges"], ORDER_LINK, original_process, order_kinds)
    taxes = tax_sums(tables["order_taxes"], ORDER_LINK, original_process, "tax_detail_id").drop("tax_code")
    lost_taxes = tax_sums(tables["cancelled_order_taxes"], ORDER_LINK, original_process, "tax_detail_id")

    rows = lookup_join(rows, kinds, F.col("order_type_id") == F.col("_kind")).drop("_kind")
    rows = lookup_join(rows, reasons, F.col("cancel_reason_id") == F.col("_reason")).drop("_reason")
    rows = lookup_join(rows, paid, status_or_null("payment_status_id") == F.col("_paid")).drop("_paid")
    rows = (rows.join(newest_of(tables["order_holds"], ORDER_LINK, ("status_id", "resolve_reason_id", "hold_type"),
                            prefix="hold_"), list(ORDER_LINK), "left")
            .join(newest_of(tables["tracking"], ORDER_LINK, ("tracking_number",)), list(ORDER_LINK), "left")
            .join(newest_of(tables["return_tracking"], ORDER_LINK, ("return_tracking_number",)),
                  list(ORDER_LINK), "left")
            .join(newest_of(tables["invoices"], ORDER_LINK, ("invoice_id",)), list(ORDER_LINK), "left")
            .join(newest_of(notes, ORDER_LINK, ("note_text",)).withColumnRenamed("note_text", "service_note"),
                  list(ORDER_LINK), "left")
            .join(exchanged_or_returned(tables["order_lines"]), list(ORDER_LINK), "left")
            .join(charges, list(ORDER_LINK), "left").join(taxes, list(ORDER_LINK), "left")
            .join(_cancelled(lost_charges, ORDER_LINK), list(ORDER_LINK), "left")
            .join(_cancelled(lost_taxes.drop("tax_code"), ORDER_LINK), list(ORDER_LINK), "left")
            .join(payment_profile(tables, profile), list(ORDER_KEY), "left")
            .join(refund_credits(tables), list(ORDER_KEY), "left"))
    exchange = F.col("has_return").isNotNull()
    return with_json_fields(rows, "json_store", HEADER_JSON).withColumns({
        "is_launch_sku": launch_flag(),
        "is_prepaid": F.coalesce("is_prepaid", F.lit(0)),
        "payment_status": status_or_null("payment_status_id"),
        "min_status": status_or_null("min_fulfillment_status_id"),
        "max_status": status_or_null("max_fulfillment_status_id"),
        "return_status": status_or_null("max_return_status_id"),
        "return_adjustment_actual": F.col("order_total") - F.col("refund_total_actual"),
        "return_adjustment_requested": F.col("order_total") - F.col("refund_total_requested"),
        "exchange_credit_actual": F.when(exchange, F.col("return_credits_actual")),
        "exchange_credit_requested": F.when(exchange, F.col("return_credits_requested")),
    }).drop("json_store", "has_return", "pk", "_launch")


def launch_flag() -> Column:
    return F.when(F.col("_launch") != "false", 1).otherwise(0)


# Line ----------------------------------------------------------------------------

# Fields of the JSON column of an order line, with their types.
LINE_JSON = {"cart_ship_method": ("extend::CartShipMethod", "string"),
             "ship_method": ("extend::ShippingMethod", "string"),
             "product_id": ("extend::ProductId", "string"), "color_image_uri": ("ColorImageURI", "string"),
             "original_unit_price": ("extend::FLOriginalUnitPrice", "decimal(16,2)"),
             "cancelled_line_total": ("CancelledOrderLineTotal", "decimal(16,2)"),
             "cancelled_charges": ("CancelledTotalCharges", "decimal(16,2)"),
             "cancelled_taxes": ("CancelledTotalTaxes", "decimal(16,2)"),
             "original_sub_total": ("extend::OrigLineSubtotal", "decimal(16,2)"),
             "original_quantity": ("extend::OrigOrderedQty", "decimal(16,0)"),
             "original_total_tax": ("extend::OrigTotalTaxes", "decimal(16,2)"),
             "original_discount": ("extend::OriginalDiscountAmount", "decimal(16,2)"),
             "prorated_discount": ("extend::ProratedDiscountTotal", "decimal(16,2)"),
             "_launch": ("extend::LaunchSKUFlag", "string")}


def release_rows(tables: Tables, lines: DataFrame) -> DataFrame:
    """Newest release line, with what its allocation adds. Key: org_id, release_id,
    release_line_id."""
    heads = prefixed(tables["releases"], "head_", only=(
        "org_id", "pk", "release_id", "order_id", "ship_from_location_id", "ship_via_id", "updated_timestamp"))
    rows = tables["release_lines"].join(
        heads, (F.col("org_id") == F.col("head_org_id")) & (F.col("release_pk") == F.col("head_pk")))
    rows = rows.withColumnsRenamed({"head_release_id": "release_id", "head_order_id": "order_id"})
    rows = latest_per_key(rows, ["org_id", "release_id", "release_line_id"],
                          newest("updated_timestamp", "head_updated_timestamp", "pk"))
    given = newest_of(tables["allocations"], (*LINE_LINK, "allocation_id"), (
        "reservation_request_id", "ship_via_id", "ship_from_location_id", "uom", "carrier_code"),
        prefix="allocated_")
    known = lines.select(*LINE_KEY, F.col("pk").alias("order_line_pk"))
    return (rows.drop("order_line_pk").join(known, list(LINE_KEY))
            .join(given, [*LINE_LINK, "allocation_id"], "left")
            .withColumns({
                "release_ship_from": F.coalesce("head_ship_from_location_id", "allocated_ship_from_location_id"),
                "release_ship_via": F.coalesce("head_ship_via_id", "allocated_ship_via_id")}))


def fulfilled_lines(tables: Tables, releases: DataFrame) -> DataFrame:
    """Newest fulfilment detail per order line, with tracking and release."""
    details = latest_per_key(tables["fulfillment_details"], LINE_LINK,
                             newest("updated_timestamp", "status_id", "pk"))
    tracked = newest_of(tables["tracking"], ("org_id", "tracking_number"), (
        "package_status", "original_est_delivery_date", "scheduled_date", "shipped_date", "delivered_date",
        "estimated_delivery_date"))
    shipped = releases.select("org_id", "release_id", "release_line_id", "release_ship_from", "release_ship_via",
                              "allocation_id", "allocated_reservation_request_id")
    return (details.select(*LINE_LINK, "tracking_number", "release_id", "release_line_id", "package_id")
            .join(tracked, ["org_id", "tracking_number"], "left")
            .join(shipped, ["org_id", "release_id", "release_line_id"], "left")
            .drop("release_id", "release_line_id"))


def backordered_lines(line_history: DataFrame) -> DataFrame:
    """Lines that were on backorder at any time."""
    rows = line_history.filter(status_or_null("max_fulfillment_status_id") == 1500)
    return rows.select("org_id", F.col("pk").alias("order_line_pk")).distinct().withColumn("_backorder", F.lit(True))


def order_line_fact(tables: Tables, original_process: str, profile: str | None = None,
                    item_profile: str | None = None) -> DataFrame:
    """One row per order line: a star join over its details. Key: LINE_KEY.

    ``order_line_history`` may hold every status of a line; the newest is the fact row,
    all of them tell whether it was ever on backorder.
    """
    history = tables["order_line_history"].filter(F.col("order_id").isNotNull())
    lines = latest_per_key(history, LINE_KEY, newest("updated_timestamp", "pk"))
    heads = tables["orders"].select("org_id", F.col("pk").alias("order_pk"),
                                    F.col("order_total").alias("_order_total"),
                                    F.col("order_type_id").alias("_order_type"),
                                    F.col("package_count").alias("package_count"))
    charges = line_charge_details(tables["line_charges"], original_process)
    taxes = tax_sums(tables["line_taxes"], LINE_LINK, original_process)
    lost_charges = charge_sums(tables["cancelled_line_charges"], LINE_LINK, original_process,
                               ("coupon", "promotion", "shipping", "discount"))
    lost_taxes = tax_sums(tables["cancelled_line_taxes"], LINE_LINK, original_process).drop("tax_code")
    releases = release_rows(tables, lines)
    notes = pivot_notes(tables["line_notes"], LINE_LINK, F.replace(F.lower("note_type_id"), F.lit(" "), F.lit("")),
                        F.col("note_text"), "notes")
    statuses = line_statuses(tables, profile)
    reasons = for_profile(tables["reasons"], profile).select(
        F.col("reason_id").alias("cancel_reason_id"), F.col("description").alias("cancel_reason_desc"))
    cancelled = (newest_of(tables["cancel_history"], LINE_LINK, ("cancel_reason",))
                 .withColumnRenamed("cancel_reason", "cancel_reason_id").join(reasons, "cancel_reason_id", "left"))
    returned = newest_of(tables["return_details"], LINE_LINK, ("location_id",)).withColumnRenamed(
        "location_id", "return_location")
    promised = newest_of(tables["promising"], LINE_LINK, ("ship_from_location_id",)).withColumnRenamed(
        "ship_from_location_id", "_promised_from")
    addresses = prefixed(tables["ship_to_addresses"], "ship_", keys=ORDER_KEY).withColumnRenamed(
        "ship_address_id", "ship_to_address_id")
    selling = item_attributes(tables, item_profile, ("is_returnable_at_store", "is_returnable_at_dc"))
    more = tables["line_additional"].select(*LINE_LINK, "return_reason")
    houses = tables["warehouses"].select("org_id", F.col("warehouse_id").alias("_from"),
                                         F.col("store_number").alias("_house_store"))
    kinds = tables["locations"].filter(F.col("reporting_flg") == "Y").select(
        "location_id", F.col("location_type_id").alias("_kind"))

    rows = lines.withColumnsRenamed({"pk": "order_line_pk"}).drop("cancel_reason_id", "cancel_reason_desc",
                                                                 "tracking_number", "tax_code")
    rows = (rows.join(heads, list(ORDER_LINK))
            .join(addresses, [*ORDER_KEY, "ship_to_address_id"], "left")
            .join(fulfilled_lines(tables, releases), list(LINE_LINK), "left")
            .join(promised, list(LINE_LINK), "left"))
    for column, name in (("min_fulfillment_status_id", "min_status_desc"),
                         ("max_fulfillment_status_id", "max_status_desc")):
        table = statuses.select("_status", F.col("description").alias(name))
        rows = lookup_join(rows, table, status_or_null(column) == F.col("_status")).drop("_status")
    for other in (charges, taxes, _cancelled(lost_charges, LINE_LINK), _cancelled(lost_taxes, LINE_LINK),
                  returned, cancelled, more, notes, backordered_lines(history)):
        # one partitioning by line serves all of these joins
        rows = rows.join(other, list(LINE_LINK), "left")
    rows = rows.join(selling, "item_id", "left")

    # a warehouse is known by its store number; the location type follows that number
    rows = rows.withColumn("_from", F.coalesce("release_ship_from", "_promised_from", "physical_origin_id"))
    rows = lookup_join(rows, houses, ["org_id", "_from"])
    rows = rows.withColumn("ship_from_location", F.coalesce("_house_store", "_from"))
    for column, name in (("ship_from_location", "ship_from_type"), ("ship_to_location_id", "ship_to_type")):
        table = kinds.select(F.col("location_id").alias("_place"), F.col("_kind").alias(name))
        rows = lookup_join(rows, table, F.col(column) == F.col("_place")).drop("_place")

    card = F.lower("item_id").like("%card%")
    no_total = F.coalesce("_order_total", F.lit(0)) == 0

    def card_value(column: str) -> Column:
        amount = F.coalesce(F.col(column), F.lit(0))
        empty = (amount == 0) & F.col("item_id").like("%ECARD%")
        return F.when(empty, F.coalesce("gift_card_value", F.lit(0))).otherwise(amount)

    derived = {
        "max_status": status_or_null("max_fulfillment_status_id"),
        "min_status": status_or_null("min_fulfillment_status_id"),
        "is_free_shipping": F.when(F.round(F.coalesce("changed_shipping", F.lit(0))) == 0, 1).otherwise(0),
        "is_appeasement": F.when(no_total & (F.lower("_order_type") == "callcenter") & card, 1).otherwise(0),
        "is_loyalty_discount": F.when(F.col("coupons").isNotNull(), 1).otherwise(0),
        "is_backorder": F.when(F.col("_backorder"), 1).otherwise(0),
        "is_launch_sku": launch_flag(),
        "is_base_shipping_charged": F.when(F.round(F.coalesce("base_shipping", F.lit(0))) != 0, 1).otherwise(0),
        "is_restockable": F.when((F.lower("_order_type") == "savethesale")
                                 & (F.trim(F.lower("return_reason")) == "lost package"), 0).otherwise(1),
        "rush_flag": F.when(F.lower("shipping_method_id").isin("express", "overnight"), 1).otherwise(0),
        "product_type": F.when(card, "E_GIFT_CARD").otherwise("REGULAR"),
        "related_order": F.when(F.lower("appeasement_reason").isin(*SERVICE_REASONS),
                                F.coalesce("parent_order_id", "order_id")),
        "sub_total": card_value("order_line_sub_total"), "line_total": card_value("order_line_total"),
        "discount": F.col("total_discounts"), "charges": F.col("total_charges"), "taxes": F.col("total_taxes"),
        "cancelled_sub_total": F.col("cancelled_order_line_sub_total"),
        "cancelled_discount": F.col("cancelled_total_discounts"),
    }
    return with_json_fields(rows, "json_store", LINE_JSON).withColumns(derived).drop(
        "json_store", "_launch", "_order_total", "_order_type", "_backorder", "_promised_from", "_from",
        "_house_store", "total_discounts", "total_charges", "total_taxes", "order_line_sub_total",
        "order_line_total", "cancelled_order_line_sub_total", "cancelled_total_discounts")


def item_attributes(tables: Tables, profile: str | None, columns: Sequence[str]) -> DataFrame:
    """Selling attributes per item of one profile."""
    items = for_profile(tables["items"], profile).select("item_id", F.col("pk").alias("item_pk"), "profile_id")
    selling = tables["selling_attributes"].select("item_pk", "profile_id", *columns)
    return items.join(selling, ["item_pk", "profile_id"]).groupBy("item_id").agg(
        F.max(F.struct(*columns)).alias("_best")).select("item_id", "_best.*")


# Payment line --------------------------------------------------------------------

def _invoiced_transactions(tables: Tables, transactions: DataFrame) -> DataFrame:
    """Transactions with their details, invoices and invoice lines."""
    details = tables["transaction_details"].select(
        "org_id", F.col("payment_transaction_pk").alias("transaction_pk"),
        F.col("payment_transaction_detail_id").alias("transaction_detail_id"),
        F.col("amount").alias("_detail_amount"), F.col("reference_id").alias("_invoice"))
    invoices = tables["invoices"].select(
        "org_id", F.col("invoice_id").alias("_invoice"), F.col("invoice_id"), F.col("pk").alias("invoice_pk"),
        "package_id", "invoice_type", "invoice_total")
    lines = tables["invoice_lines"].select(
        "org_id", "invoice_pk", "invoice_line_id", "order_line_id", "item_id", "package_detail_id",
        F.col("invoice_line_total"), F.col("updated_timestamp").alias("invoice_line_updated_ts"))
    # the few columns of the invoices are joined first, so that the transactions are dealt out once
    links = details.join(invoices, ["org_id", "_invoice"], "left").join(lines, ["org_id", "invoice_pk"], "left")
    return transactions.withColumn("transaction_pk", F.col("pk")).join(links, ["org_id", "transaction_pk"], "left")


def payment_line_fact(tables: Tables, changed: DataFrame | None = None) -> DataFrame:
    """One row per payment transaction and invoice line.

    A follow-on transaction without an invoice takes the invoice line of the
    transaction it follows. ``changed`` limits the load to some transactions; the ones
    they follow are still looked up among all transactions of the same orders.
    """
    everything = tables["transactions"]
    base = _invoiced_transactions(tables, everything if changed is None else changed)
    orders = base.select(*ORDER_KEY).distinct()
    followed = everything if changed is None else everything.join(orders, list(ORDER_KEY), "left_semi")
    lookup = (_invoiced_transactions(tables, followed).filter(F.col("invoice_id").isNotNull())
              .select(*ORDER_KEY, F.col("request_id").alias("_followed"),
                      *[F.col(c).alias(f"_f_{c}") for c in ("invoice_id", "invoice_line_id", "order_line_id",
                                                            "item_id", "transaction_pk")]))
    # the follow-on key is null for rows that need no lookup, so they match nothing
    needs = F.col("invoice_id").isNull() & ~F.lower("transaction_type").isin(*UNSETTLED)
    keyed = base.withColumn("_followed", F.when(needs, F.col("follow_on_id")))
    # the transactions of an order are few: they come as one value, and what follows stays with the order
    names = [c for c in lookup.columns if c not in ORDER_KEY]
    per_order = lookup.filter(F.col("_followed").isNotNull()).groupBy(*ORDER_KEY).agg(
        F.collect_list(F.struct(*names)).alias("_lookup"))
    joined = keyed.join(per_order, list(ORDER_KEY), "left").withColumn("_hit", F.explode_outer(
        F.filter("_lookup", lambda f: f["_followed"] == F.col("_followed"))))
    joined = joined.select("*", *[F.col(f"_hit.{c}").alias(c) for c in names if c != "_followed"]).drop("_lookup", "_hit")
    per_line = [*ORDER_KEY, "order_line_id", "payment_method_pk", "payment_transaction_id",
                "transaction_detail_id", "invoice_id", "invoice_line_id"]
    rows = latest_per_key(joined, per_line, newest("updated_timestamp", "_f_transaction_pk", "_f_invoice_line_id",
                                                   "transaction_pk"))
    rows = rows.withColumns({c: F.coalesce(c, f"_f_{c}")
                             for c in ("invoice_id", "invoice_line_id", "order_line_id", "item_id")})

    heads = tables["payment_headers"].select("org_id", F.col("pk").alias("payment_header_pk"),
                                             F.col("order_id").alias("_head_order"), "payment_group_id",
                                             F.col("status").alias("payment_status"))
    methods = prefixed(tables["payment_methods"].drop("order_id"), "method_",
                       keys=("org_id", "payment_header_pk", "payment_type", "card_type", "payment_method_id"))
    billing = prefixed(tables["billing_addresses"], "billing_", keys=("org_id", "payment_method_pk"))
    name = F.lower("name")
    attributes = tables["method_attributes"].groupBy("org_id", "payment_method_pk").agg(
        max_if(name == "cvvresultcode", "value").alias("cvv_response"),
        max_if(name == "avsresultcode", "value").alias("avs_code"))
    known = heads.join(methods, ["org_id", "payment_header_pk"])
    paid = tables["payment_statuses"].select(status_or_null("status_id").alias("_paid"),
                                             F.col("status_name").alias("payment_status_desc"))
    rows = (known.withColumn("payment_method_pk", F.col("method_pk"))
            .join(rows, ["org_id", "payment_method_pk"])
            .join(billing, ["org_id", "payment_method_pk"], "left")
            .join(attributes, ["org_id", "payment_method_pk"], "left"))
    rows = lookup_join(rows, paid, status_or_null("payment_status") == F.col("_paid"))
    return rows.withColumns({
        "order_id": F.col("_head_order"),
        "transaction_id": F.col("payment_transaction_id"),
        "transaction_amount": F.coalesce("_detail_amount", F.lit(0)),
        "payment_line_pk": F.col("transaction_pk"),
    }).drop("_followed", "_head_order", "_paid", "_invoice", "_detail_amount",
            *[c for c in joined.columns if c.startswith("_f_")])


# Allocation ----------------------------------------------------------------------

def allocation_fact(allocations: DataFrame, line_versions: DataFrame, releases: DataFrame,
                    release_lines: DataFrame, reservations: DataFrame) -> DataFrame:
    """One row per allocation of a current order line. Key: allocation_pk, allocation_id,
    LINE_KEY."""
    heads = prefixed(releases, "head_", only=("org_id", "pk", "release_id", "order_id", "updated_timestamp"))
    released = release_lines.join(
        heads, (F.col("org_id") == F.col("head_org_id")) & (F.col("release_pk") == F.col("head_pk")))
    released = latest_per_key(released, ["org_id", "head_order_id", "order_line_id"],
                              newest("updated_timestamp", "head_updated_timestamp", "pk"))
    released = released.select("org_id", "order_line_id", "allocation_id",
                               F.col("head_release_id").alias("release_id"), "release_line_id")
    lines = current_only(line_versions).select(*LINE_KEY, "order_line_pk")
    confirmed = reservations.filter(F.col("is_confirmed") == 1).select(
        "org_id", F.col("request_id").alias("reservation_request_id"), "supply_profile_id",
        "reservation_version", "all_or_none", "demand_type", "reservation_expiry_date")
    status = blank_to_null("status_id")

    def of_status(text: str, value: Column, otherwise: Column) -> Column:
        return F.when(F.lower("status_id") == text, value).otherwise(otherwise)

    return (allocations.withColumn("status_id", status)
            .join(lines, list(LINE_LINK))
            .join(released, ["org_id", "order_line_id", "allocation_id"], "left")
            .join(confirmed, ["org_id", "reservation_request_id"], "left")
            .withColumns({
                "allocation_pk": F.col("pk"),
                "open_quantity": of_status("open", F.col("quantity"), F.lit(0)),
                "released_quantity": of_status("released", F.col("quantity"), F.lit(0)),
                "opened_ts": of_status("open", F.col("created_timestamp"), F.lit(None)),
                "released_ts": of_status("released", F.col("created_timestamp"), F.lit(None)),
            }).drop("pk").distinct())
