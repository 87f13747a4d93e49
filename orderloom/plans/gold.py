"""Type-2 loads of the facts and dimensions: one declaration per model, one job that carries it out.

A load takes the keys that any of a model's inputs has touched since the last run, cuts every input to these keys before
anything is aggregated or joined, computes the rows, and merges them as versions: replaced versions are closed, keys gone
from the source end or go, the newest version of each status is flagged, and the buckets concerned are committed at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.audit import FIRST_WATERMARK, AuditLog
from orderloom.operators.history import mark_status_history, scd2_merge, scd2_stage
from orderloom.operators.joins import same_key
from orderloom.plans import availability as V
from orderloom.plans import dimensions as D
from orderloom.plans import facts as X
from orderloom.plans import fulfilment as U
from orderloom.plans.amounts import LINE_KEY, ORDER_KEY
from orderloom.session import freed_shuffles, run_dir, write_staged
from orderloom.sources.buckets import BucketTable
from orderloom.sources.schemas import evolved, fitted
from orderloom.sources.tables import read_increment

Tables = Mapping[str, DataFrame]
ORDER_LINK, LINE_LINK = X.ORDER_LINK, X.LINE_LINK
STATUS_FLAG = "status_hist_flg"
# Columns that tell how and when a row was loaded and are no part of what a version says.
LOAD_COLUMNS = ("src_load_ts", "loaded_ts", "etl_updt_ts")


@dataclass(frozen=True)
class Input:
    """A table whose rows belong to keys of the scope: by its own columns ``link``, or by a row of the input ``via`` that
    has the same values in its columns ``on``. With ``triggers`` a new row makes its keys part of the load."""
    table: str
    link: tuple[str, ...]
    via: str | None = None
    on: tuple[str, ...] = ()
    triggers: bool = True


@dataclass(frozen=True)
class Deletion:
    """Rows whose ``column`` is no longer among ``live`` values of ``table`` are ended (kind 2) or removed (kind 1)."""
    table: str
    live: str
    column: str
    kind: int = 2


@dataclass(frozen=True)
class GoldModel:
    """``scope`` names the columns of a key of the load; empty where every new row is a version of its own. ``context``
    are the columns whose change opens a version; by default all that are neither keys nor load columns. ``start`` is the
    column a version starts at; by default it is the time of the load."""
    name: str
    build: Callable[[Tables], DataFrame]
    keys: tuple[str, ...]
    scope: tuple[str, ...]
    inputs: tuple[Input, ...]
    deletion: Deletion | None = None
    status: str | None = None
    context: tuple[str, ...] | None = None
    start: str | None = None


class ScopedTables(dict):
    """The inputs of a model cut to some keys; other tables as they are."""

    def __init__(self, model: GoldModel, tables: Tables, changed: DataFrame):
        super().__init__()
        self.model, self.tables, self.changed = model, tables, changed
        self.inputs = {i.table: i for i in model.inputs}

    def __missing__(self, name: str) -> DataFrame:
        rows = self.tables[name]
        if name in self.inputs:
            one = self.inputs[name]
            if one.via is None:
                keys, on = self.changed, self.model.scope
            else:
                keys, on = self[one.via].select(*one.on).distinct(), one.on
            right = keys.select(*[F.col(c).alias(f"_k_{c}") for c in on])
            rows = rows.join(right, same_key(rows, right, dict(zip(one.link, right.columns))), "left_semi")
        self[name] = rows
        return rows


def increments(model: GoldModel, tables: Tables, stamp: str, low: datetime, lookback: timedelta) -> dict[str, DataFrame]:
    """The new rows of every input that starts a load."""
    return {i.table: read_increment(tables[i.table], stamp, low, lookback) for i in model.inputs if i.triggers}


def changed_keys(model: GoldModel, tables: Tables, new: Mapping[str, DataFrame]) -> DataFrame:
    """The scope keys that any new row of any input belongs to, each once."""
    inputs = {i.table: i for i in model.inputs}

    def scope_of(rows: DataFrame, one: Input) -> DataFrame:
        keys = rows.select(*one.link).distinct()
        if one.via is None:
            return keys.toDF(*model.scope)
        holder = tables[one.via]
        keys = keys.toDF(*[f"_k_{c}" for c in one.link])
        held = holder.join(keys, same_key(holder, keys, dict(zip(one.on, keys.columns))), "left_semi")
        return scope_of(held, inputs[one.via])

    parts = [scope_of(rows, inputs[name]) for name, rows in new.items()]
    return reduce(DataFrame.unionByName, parts).distinct()


def _staged(df: DataFrame) -> DataFrame:
    """Written once to the shared folder, so that what follows reads it and does not compute it again."""
    return write_staged(df, f"{run_dir(df.sparkSession)}/staged/{uuid.uuid4().hex}")


def context_columns(model: GoldModel, rows: DataFrame) -> list[str]:
    if model.context is not None:
        return list(model.context)
    return [c for c in rows.columns if c not in (*model.keys, *LOAD_COLUMNS)]


def gone_keys(model: GoldModel, tables: Tables, target: BucketTable) -> DataFrame | None:
    """``hash_sk`` and the deletion column of current versions without a source row; only these columns are read."""
    if model.deletion is None or not target.exists():
        return None
    rule = model.deletion
    live = tables[rule.table].select(F.col(rule.live).alias("_live"))
    held = target.read().filter("active_flg = 'Y'").select("hash_sk", rule.column)
    return held.join(live, held[rule.column].eqNullSafe(live["_live"]), "left_anti").distinct()


def _without_gone(rows: DataFrame, gone: DataFrame, rule: Deletion, ended_at: datetime) -> DataFrame:
    # one row per key, so that rows dealt out by key stay where they are
    marks = gone.groupBy(F.col("hash_sk").alias("_sk")).agg(F.collect_list(F.struct(F.col(rule.column).alias("live"))).alias("_gone"))
    joined = rows.join(marks, rows["hash_sk"] == marks["_sk"], "left")
    hit = F.coalesce(F.exists("_gone", lambda g: g["live"].eqNullSafe(F.col(rule.column))), F.lit(False))
    if rule.kind == 1:
        return joined.filter(~hit).drop("_sk", "_gone")
    ends = hit & (F.col("active_flg") == "Y")
    return joined.withColumns({
        "end_ts": F.when(ends, F.lit(ended_at).cast("timestamp_ntz")).otherwise(F.col("end_ts")),
        "active_flg": F.when(ends, "N").otherwise(F.col("active_flg"))}).drop("_sk", "_gone")


@dataclass
class LoadResult:
    """What a load did: the newest stamp it has read, and the buckets it wrote."""
    processed: datetime | None
    buckets: list[int] = field(default_factory=list)


def load_model(model: GoldModel, tables: Tables, target: BucketTable, batch_id: int, loaded_at: datetime,
               low: datetime = FIRST_WATERMARK, lookback: timedelta = timedelta(0),
               stamp: str = "src_load_ts") -> LoadResult:
    """Bring ``target``, whose key is ``hash_sk``, up to date with the source rows loaded since ``low``.

    Run again it changes nothing but load times. A run from the first watermark takes all keys.
    """
    base = target.version()
    new = increments(model, tables, stamp, low, lookback)
    newest = reduce(DataFrame.unionByName, [rows.agg(F.max(stamp).alias("at")) for rows in new.values()])
    processed = newest.agg(F.max("at")).first()[0]
    if low <= FIRST_WATERMARK:
        scoped: Tables = tables
    elif not model.scope:
        scoped = {**tables, **new}
    else:
        scoped = ScopedTables(model, tables, _staged(changed_keys(model, tables, new)))
    rows = model.build(scoped)
    start = F.lit(loaded_at).cast("timestamp_ntz") if model.start is None else F.col(model.start).cast("timestamp_ntz")
    versions = _staged(scd2_stage(rows, model.keys, context_columns(model, rows), start, batch_id,
                                  F.lit(loaded_at).cast("timestamp_ntz")))
    gone = gone_keys(model, tables, target)
    touched = versions.select("hash_sk")
    if gone is not None:
        gone = _staged(gone)
        touched = touched.union(gone.select("hash_sk"))
    buckets = target.buckets_of(touched)
    if not buckets:
        return LoadResult(processed)
    if base:
        held = target.read(buckets).drop(STATUS_FLAG)
        schema = evolved(held.schema, versions.schema)
        merged = scd2_merge(fitted(held, schema), fitted(versions, schema))
        if gone is not None:
            merged = _without_gone(merged, gone, model.deletion, loaded_at)
    else:
        merged = scd2_merge(versions.filter(F.lit(False)), versions)
    if model.status is not None:
        merged = mark_status_history(merged, model.status, dealt_by_key=True)
    target.commit(merged, buckets, base, dealt_by_key=True)
    return LoadResult(processed, buckets)


class GoldLoader:
    """Loads models into tables below ``root``, each from its own watermark, with an audit row per outcome."""

    def __init__(self, spark: SparkSession, root: str, tables: Tables, buckets: int = 32,
                 lookback: timedelta = timedelta(0), stamp: str = "src_load_ts"):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self.buckets, self.lookback, self.stamp = buckets, lookback, stamp
        self.audit = AuditLog(spark, f"{self.root}/audit")

    def table(self, model: GoldModel) -> BucketTable:
        return BucketTable(self.spark, f"{self.root}/{model.name}", ["hash_sk"], self.buckets)

    def run(self, model: GoldModel, batch_id: int, loaded_at: datetime, load_type: str = "INCREMENTAL") -> LoadResult:
        """Load one model; its watermark moves only where the load succeeds."""
        run_id = f"{model.name}/{batch_id}/{uuid.uuid4().hex}"
        low = self.audit.watermark(model.name, load_type)
        self.audit.start((model.name, model.name, run_id, load_type))
        try:
            with freed_shuffles(self.spark):
                result = load_model(model, self.tables, self.table(model), batch_id, loaded_at, low, self.lookback, self.stamp)
        except Exception as error:
            self.audit.failure([run_id], str(error)[:1000])
            raise
        self.audit.success({run_id: result.processed if result.processed is not None else low})
        return result


# Models --------------------------------------------------------------------------

def _order_inputs(orders: str = "orders") -> tuple[Input, ...]:
    by_order = ("order_holds", "tracking", "return_tracking", "invoices", "order_notes", "order_lines", "order_charges",
                "cancelled_order_charges", "order_taxes", "cancelled_order_taxes")
    return (Input(orders, ("org_id", "pk")), *[Input(t, ORDER_LINK) for t in by_order],
            Input("payment_headers", ORDER_KEY, orders, ORDER_KEY), Input("payment_summaries", ORDER_KEY, orders, ORDER_KEY),
            Input("payment_methods", ("org_id", "payment_header_pk"), "payment_headers", ("org_id", "pk")))


def order_header(original_process: str, profile: str | None = None) -> GoldModel:
    return GoldModel("order_header", lambda t: X.order_header_fact(t, original_process, profile), ORDER_KEY, ORDER_LINK,
                     _order_inputs(), Deletion("orders", "pk", "order_pk"))


def order_header_history(original_process: str, profile: str | None = None) -> GoldModel:
    """Every version of an order, each from its own update on."""
    return GoldModel("order_header_history", lambda t: X.order_header_fact(t, original_process, profile), ORDER_KEY,
                     ORDER_LINK, _order_inputs(), Deletion("orders", "pk", "order_pk"), "max_fulfillment_status_id",
                     start="updated_timestamp")


def order_line(original_process: str, profile: str | None = None, item_profile: str | None = None) -> GoldModel:
    by_line = ("line_charges", "cancelled_line_charges", "line_taxes", "cancelled_line_taxes", "release_lines", "allocations",
               "fulfillment_details", "line_notes", "cancel_history", "return_details", "promising", "line_additional")
    history = "order_line_history"
    return GoldModel(
        "order_line", lambda t: X.order_line_fact(t, original_process, profile, item_profile), LINE_KEY, LINE_LINK,
        (Input(history, ("org_id", "pk")), *[Input(t, LINE_LINK) for t in by_line],
         Input("orders", ("org_id", "pk"), history, ORDER_LINK),
         Input("ship_to_addresses", ORDER_KEY, history, ORDER_KEY),
         Input("releases", ("org_id", "pk"), "release_lines", ("org_id", "release_pk")),
         Input("tracking", ("org_id", "tracking_number"), "fulfillment_details", ("org_id", "tracking_number"))),
        Deletion(history, "pk", "order_line_pk"), "max_fulfillment_status_id")


def payment_line() -> GoldModel:
    keys = (*ORDER_KEY, "payment_method_id", "transaction_id", "transaction_detail_id", "invoice_id", "invoice_line_id")
    return GoldModel(
        "payment_line", X.payment_line_fact, keys, ORDER_KEY,
        (Input("transactions", ORDER_KEY), Input("payment_headers", ORDER_KEY),
         Input("transaction_details", ("org_id", "payment_transaction_pk"), "transactions", ("org_id", "pk")),
         Input("invoices", ("org_id", "invoice_id"), "transaction_details", ("org_id", "reference_id")),
         Input("invoice_lines", ("org_id", "invoice_pk"), "invoices", ("org_id", "pk")),
         Input("payment_methods", ("org_id", "payment_header_pk"), "payment_headers", ("org_id", "pk")),
         Input("billing_addresses", ("org_id", "payment_method_pk"), "payment_methods", ("org_id", "pk")),
         Input("method_attributes", ("org_id", "payment_method_pk"), "payment_methods", ("org_id", "pk"))),
        Deletion("transactions", "pk", "payment_line_pk", kind=1))


def allocation() -> GoldModel:
    return GoldModel(
        "allocation", lambda t: X.allocation_fact(t["allocations"], t["line_versions"], t["releases"], t["release_lines"],
                                                  t["reservations"]),
        ("allocation_pk", "allocation_id", *LINE_KEY), LINE_LINK,
        (Input("allocations", LINE_LINK), Input("release_lines", LINE_LINK), Input("line_versions", LINE_LINK, triggers=False),
         Input("releases", ("org_id", "pk"), "release_lines", ("org_id", "release_pk")),
         Input("reservations", ("org_id", "request_id"), "allocations", ("org_id", "reservation_request_id"))),
        Deletion("allocations", "pk", "allocation_pk", kind=1), "status_id")


def fulfilment_header(profile: str | None = None) -> GoldModel:
    link = ("org_id", "fulfillment_id")
    return GoldModel("fulfilment_header", lambda t: U.fulfilment_header_fact(t, profile), link, link,
                     (Input("fulfilments", link), Input("packages", link)), Deletion("fulfilments", "pk", "pk"))


def fulfilment_line(profile: str | None = None, item_profile: str | None = None) -> GoldModel:
    lines, keys = "fulfilment_lines", ("org_id", "fulfillment_id", "fulfillment_line_id")
    order_line_key = ("org_id", "order_id", "order_line_id")
    return GoldModel(
        "fulfilment_line", lambda t: U.fulfilment_line_fact(t, t["line_versions"], profile, item_profile), keys,
        ("org_id", "fulfilment_line_pk"),
        (Input(lines, ("org_id", "pk")), Input("line_shorts", ("org_id", "fulfillment_line_pk")),
         Input("fulfilments", ("org_id", "pk"), lines, ("org_id", "fulfillment_pk")),
         Input("pick_details", ("org_id", "fulfillment_id"), "fulfilments", ("org_id", "fulfillment_id")),
         Input("line_versions", order_line_key, lines, order_line_key, triggers=False),
         Input("fulfillment_details", LINE_LINK, "line_versions", LINE_LINK),
         Input("payment_headers", ORDER_KEY, lines, ORDER_KEY),
         Input("payment_methods", ("org_id", "payment_header_pk"), "payment_headers", ("org_id", "pk"))),
        Deletion(lines, "pk", "pk", kind=1), "fulfillment_line_status_id")


def package_detail() -> GoldModel:
    link = ("org_id", "packages_pk")
    return GoldModel(
        "package_detail", lambda t: U.package_detail_fact(t, t["locations"]), ("org_id", "package_id", "package_detail_id"),
        link,
        (Input("package_details", link), Input("packages", ("org_id", "pk")),
         Input("invoices", ("org_id", "package_id"), "packages", ("org_id", "package_id")),
         Input("invoice_lines", ("org_id", "invoice_pk"), "invoices", ("org_id", "pk")),
         Input("e_invoices", ("org_id", "package_id"), "packages", ("org_id", "package_id")),
         Input("e_invoice_lines", ("org_id", "e_invoice_pk"), "e_invoices", ("org_id", "pk")),
         Input("payment_headers", ORDER_KEY, "packages", ORDER_KEY),
         Input("payment_methods", ("org_id", "payment_header_pk"), "payment_headers", ("org_id", "pk"))),
        Deletion("package_details", "pk", "pk"), "package_status")


def release_detail(profile: str | None = None) -> GoldModel:
    details = "fulfillment_details"
    return GoldModel(
        "release_detail", lambda t: U.release_detail_fact(t, t["locations"], profile),
        (*LINE_KEY, "release_id", "release_line_id"), LINE_LINK,
        (Input("release_lines", LINE_LINK), Input("allocations", LINE_LINK), Input("order_lines", ("org_id", "pk")),
         Input("cancel_history", LINE_LINK), Input(details, LINE_LINK),
         Input("releases", ("org_id", "pk"), "release_lines", ("org_id", "release_pk")),
         Input("invoices", ORDER_LINK, "order_lines", ORDER_LINK),
         Input("tracking", ("org_id", "tracking_number"), details, ("org_id", "tracking_number")),
         Input("fulfilments", ("org_id", "fulfillment_id"), "releases", ("org_id", "release_id")),
         Input("fulfilment_lines", ("org_id", "fulfillment_pk"), "fulfilments", ("org_id", "pk"))),
        Deletion("release_lines", "pk", "release_line_pk"))


def inventory_supply() -> GoldModel:
    return GoldModel(
        "inventory_supply", lambda t: U.inventory_supply_fact(t["supply"], t["supply_allocations"], t["locations"]),
        ("supply_pk", "supply_allocation_pk"), ("supply_pk",),
        (Input("supply", ("pk",)), Input("supply_allocations", ("supply_pk",))), Deletion("supply", "pk", "supply_pk"))


def sku_exclusion() -> GoldModel:
    return GoldModel("sku_exclusion", lambda t: U.sku_exclusion_fact(t["exclusions"]), ("exclusion_id", "exclusion_level"),
                     ("exclusion_id",), (Input("exclusions", ("exclusion_id",)),))


def network_availability() -> GoldModel:
    return GoldModel(
        "network_availability", lambda t: V.network_feed(t["network_alerts"], V.NETWORK_ALERT).unionByName(
            V.network_feed(t["network_full"], V.NETWORK_FULL), allowMissingColumns=True),
        V.NETWORK_HASH, (), (Input("network_alerts", ()), Input("network_full", ())), context=V.NETWORK_CONTEXT,
        start="load_ts")


def location_availability() -> GoldModel:
    return GoldModel(
        "location_availability", lambda t: V.location_feed(t["location_delta"], V.LOCATION_DELTA).unionByName(
            V.location_feed(t["location_full"], V.LOCATION_FULL), allowMissingColumns=True),
        V.LOCATION_KEY, (), (Input("location_delta", ()), Input("location_full", ())), context=V.LOCATION_CONTEXT,
        start="load_ts")


def customer() -> GoldModel:
    return GoldModel(
        "customer", lambda t: D.customer_dimension(t).drop("order_id"), ("org_id", "customer_id"), ("org_id", "customer_id"),
        (Input("orders", ("org_id", "customer_id")), Input("payment_headers", ORDER_KEY, "orders", ORDER_KEY),
         Input("payment_methods", ("org_id", "payment_header_pk"), "payment_headers", ("org_id", "pk")),
         Input("billing_addresses", ("org_id", "payment_method_pk"), "payment_methods", ("org_id", "pk")),
         Input("ship_to_addresses", ORDER_KEY, "orders", ORDER_KEY)))


def employee() -> GoldModel:
    return GoldModel("employee", lambda t: D.employee_dimension(t["users"]), ("user_id",), ("user_pk",),
                     (Input("users", ("pk",)),), Deletion("users", "pk", "user_pk"))


def item() -> GoldModel:
    parts = ("item_codes", "handling_attributes", "selling_attributes")
    return GoldModel("item", D.item_dimension, ("item_pk", "item_codes"), ("item_pk",),
                     (Input("items", ("pk",)), *[Input(t, ("item_pk",)) for t in parts]), Deletion("items", "pk", "item_pk"))


def location(profile: str | None = None) -> GoldModel:
    return GoldModel("location", lambda t: D.location_dimension(t, profile), ("location_id",), ("location_pk",),
                     (Input("locations", ("pk",)), Input("location_contacts", ("location_pk",))),
                     Deletion("locations", "pk", "location_pk"))


def organisation() -> GoldModel:
    return GoldModel("organisation", lambda t: D.organisation_dimension(t["organisations"], t["hierarchy"]),
                     ("org_pk", "hierarchy_pk"), ("org_pk",),
                     (Input("organisations", ("pk",)), Input("hierarchy", ("organization_pk",))),
                     Deletion("organisations", "pk", "org_pk"))


def promotion() -> GoldModel:
    key = ("profile_id", "promo_id")
    return GoldModel(
        "promotion", D.promotion_dimension, key, key,
        (Input("combo_promotions", key), Input("item_promotions", key),
         Input("combo_qualifiers", ("profile_id", "combo_promotion_config_pk"), "combo_promotions", ("profile_id", "pk")),
         Input("item_qualifiers", ("profile_id", "item_promotion_config_pk"), "item_promotions", ("profile_id", "pk"))),
        Deletion("combo_promotions", "pk", "pk"))


def gold_models(original_process: str, profile: str | None = None, item_profile: str | None = None
                ) -> Sequence[GoldModel]:
    """All models; lines come before what is joined to their current versions."""
    return (order_header(original_process, profile), order_header_history(original_process, profile),
            order_line(original_process, profile, item_profile), payment_line(), allocation(), fulfilment_header(profile),
            fulfilment_line(profile, item_profile), package_detail(), release_detail(profile), inventory_supply(),
            sku_exclusion(), network_availability(), location_availability(), customer(), employee(), item(),
            location(profile), organisation(), promotion())
