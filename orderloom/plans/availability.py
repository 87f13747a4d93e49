"""Availability to promise: cleaned feeds, type-2 rows, and the published tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import codes
from orderloom.functions.text import iso_text, store_key, true_or_false
from orderloom.operators.history import scd2_stage
from orderloom.operators.latest import latest_per_key, newest
from orderloom.operators.merge import upsert_table
from orderloom.plans.places import store_numbers
from orderloom.plans.products import banner_products
from orderloom.sources.buckets import BucketTable
from orderloom.sources.schemas import RecordedSink, fitted
from orderloom.sources.tables import replace_partitions, union_sources

NETWORK_FULL, NETWORK_ALERT = "networkfullavailabilitysync", "networkavailabilityalert"
LOCATION_DELTA, LOCATION_FULL = "locationavailabilitydeltasync", "locationavailabilityfullsync"
NETWORK_KEY = ("item_id", "updated_ts", "selling_channel", "message_type")
LOCATION_KEY = ("item_id", "location_id", "updated_ts", "message_type", "selling_channel")
NETWORK_HASH = ("updated_ts", "item_id", "message_type", "selling_channel", "atp")
NETWORK_CONTEXT = ("environment", "region", "time_zone", "transaction_type", "on_hand_quantity", "on_hand_status",
                   "warehouse_atp", "store_atp", "dropship_atp", "atp_status", "future_quantity", "future_date",
                   "load_ts")
LOCATION_CONTEXT = ("transaction_type", "region", "time_zone", "country", "on_hand_quantity", "on_hand_status",
                    "atp", "status", "future_quantity", "load_ts")
PARTS = ("warehouse_atp", "store_atp", "dropship_atp")


def zero_guarded(part: Column | str, total: Column | str) -> Column:
    """A component of the stock is zero where the total is zero or unknown."""
    part, total = (F.col(c) if isinstance(c, str) else c for c in (part, total))
    return F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(0)).otherwise(F.coalesce(part, F.lit(0)))


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("decimal(38,0)"), F.lit(0)) for c in columns
                           if c in df.columns})


def network_feed(raw: DataFrame, message: str) -> DataFrame:
    """Network messages of one type: newest per key, of several at once the one with the highest
    amount; stock parts guarded by the total. Key: NETWORK_KEY."""
    rows = raw.filter(F.lower("message_type") == message).withColumn("item_id", F.trim("item_id"))
    rows = latest_per_key(rows, NETWORK_KEY, newest("header_ts", "load_ts", "atp"))
    guarded = rows.withColumns({p: zero_guarded(p, "atp") for p in PARTS})
    return _numbers(guarded, ("atp", *PARTS, "on_hand_quantity", "future_quantity", "first_future_quantity"))


def location_feed(raw: DataFrame, message: str) -> DataFrame:
    """Location messages of one type with a location: newest per key. Key: LOCATION_KEY."""
    rows = raw.filter((F.lower("message_type") == message) & F.col("location_id").isNotNull())
    return latest_per_key(rows, LOCATION_KEY, newest("header_ts", "load_ts"))


def network_fact(alerts: DataFrame, full: DataFrame, today: datetime, batch_id: int = 0) -> DataFrame:
    """Alerts of the last day and full syncs of the last two days, staged for type 2."""
    rows = union_sources((alerts, "load_ts", today, timedelta(days=1)), (full, "load_ts", today, timedelta(days=2)))
    return scd2_stage(rows, NETWORK_HASH, NETWORK_CONTEXT, F.col("load_ts"), batch_id)


def location_fact(delta: DataFrame, full: DataFrame, today: datetime, batch_id: int = 0) -> DataFrame:
    """Deltas and full syncs of the last day, staged for type 2."""
    day = timedelta(days=1)
    rows = union_sources((delta, "load_ts", today, day), (full, "load_ts", today, day))
    return scd2_stage(rows, LOCATION_KEY, LOCATION_CONTEXT, F.col("load_ts"), batch_id)


# Publishing ----------------------------------------------------------------------

NETWORK_PUBLISH_KEY = ("org_id", "product_id", "gtin", "selling_channel", "message_type")
LOCATION_PUBLISH_KEY = ("selling_channel", "product_id", "org_id", "fulfilment_type", "location_id",
                        "location_type")


def publish_network(facts: DataFrame, products: DataFrame) -> DataFrame:
    """Network availability as published: product keys, flags and amounts as text."""
    table = banner_products(products, ("online_us_sku", "online_us_sku_size", "online_ca_sku",
                                       "online_ca_sku_size", "sku_number"))
    us = F.concat_ws("-", "online_us_sku", "online_us_sku_size")
    canada = F.concat_ws("-", "online_ca_sku", "online_ca_sku_size")
    product = F.when(F.col("banner_id") == codes.US_BANNER, us).when(
        F.col("banner_id") == codes.CANADA_BANNER, canada)
    region = F.trim(F.substring_index("selling_channel", "-", 2))  # channels may have blanks around the dash
    keyed = facts.withColumns({"banner_id": codes.product_banner(region), "global_size_id": F.trim("item_id")})
    joined = keyed.join(table, ["banner_id", "global_size_id"], "left")
    known = F.col("sku_number").isNotNull() | F.col("online_us_sku").isNotNull() | F.col("online_ca_sku").isNotNull()

    def available(column: str) -> Column:
        return true_or_false(F.coalesce(F.col(column) > 0, F.lit(False)))

    return joined.select(
        F.lit("FL_NA").alias("org_id"), F.when(known, product).alias("product_id"),
        F.lit("EACH").alias("uom"), F.col("sku_number").alias("gtin"), available("atp").alias("available"),
        available("store_atp").alias("available_in_store"),
        available("warehouse_atp").alias("available_in_warehouse"),
        available("dropship_atp").alias("available_by_dropship"),
        codes.published_channel("selling_channel", codes.NETWORK_CHANNELS).alias("selling_channel"),
        F.lit("ATP_PUBLISH").alias("transaction_type"), iso_text("updated_ts").alias("update_time"),
        F.col("future_date").cast("string").alias("future_date"),
        F.col("atp").cast("string").alias("total_atp"),
        *[F.col(p).cast("string").alias(p) for p in PARTS], "load_ts", "message_type").distinct()


def publish_location(facts: DataFrame, products: DataFrame, locations: DataFrame, stores: DataFrame) -> DataFrame:
    """Location availability as published, from the delta messages."""
    table = banner_products(products, ("sku_number", "online_us_sku", "online_ca_sku", "legacy_size_desc"))
    in_canada = F.upper("selling_channel").like("%CA%")
    kinds = locations.select(F.col("location_id"), F.upper("type").alias("location_type"))
    keyed = facts.filter(F.lower("message_type") == LOCATION_DELTA).withColumns({
        "banner_id": F.when(in_canada, codes.CANADA_BANNER).otherwise(codes.US_BANNER),
        "global_size_id": F.trim("item_id"), "_store_key": store_key("location_id")})
    joined = (keyed.join(kinds, "location_id", "left").join(table, ["banner_id", "global_size_id"], "left")
              .join(store_numbers(stores), F.col("_store_key") == F.col("_store"), "left"))
    sku = F.when(in_canada, F.col("online_ca_sku")).otherwise(F.col("online_us_sku"))
    channel = F.lower("selling_channel")
    return joined.select(
        F.col("store_number").cast("string").alias("location_id"), "location_type", F.lit("FL-NA").alias("org_id"),
        codes.published_channel("selling_channel", codes.LOCATION_CHANNELS).alias("selling_channel"),
        F.lit("CHECKOUT").alias("transaction_type"), F.col("sku_number").alias("gtin"),
        F.trim(F.concat_ws("-", sku, "legacy_size_desc")).alias("product_id"), F.lit("EACH").alias("uom"),
        F.when(channel.like("%bopis%"), "PICK").when(channel.like("%shiptohome%"), "SHIP").alias("fulfilment_type"),
        F.col("atp").cast("string").alias("atp"),
        F.when(F.col("status") == "AVAILABLE", "GREEN").otherwise("RED").alias("atp_status"),
        F.lit("0.0").alias("demand"), F.lit("0").alias("safety_stock"), F.lit("COMMON_POOL").alias("segment"),
        F.lit("0.0").alias("supply"), iso_text("updated_ts", "000000").alias("update_time"), "load_ts").distinct()


def load_published(rows: DataFrame, target: BucketTable, history_path: str, keys: Sequence[str],
                   batch: int) -> DataFrame:
    """Add all rows to the history, and upsert the newest per key into the target.

    The rows of a batch lie in folders of its number, and columns may be added from batch to batch; a batch that runs
    again replaces its own folders and changes nothing else.
    """
    history = rows.withColumns({"load_date": F.to_date("load_ts"), "batch": F.lit(batch)})
    recorded = RecordedSink(rows.sparkSession, history_path).admit(history.schema)
    replace_partitions(fitted(history, recorded), history_path, ["load_date", "batch"])
    rest = [c for c in rows.columns if c not in (*keys, "update_time")]
    return upsert_table(target, rows, keys, stamp="update_time", tie_break=rest)
