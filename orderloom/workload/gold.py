"""Two-batch loads of all gold models: what arrives late, what leaves, and the versions that come of it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.plans import gold as G
from orderloom.plans.gold import GoldLoader, GoldModel
from orderloom.plans.mart_inputs import pinned_sources
from orderloom.plans.orders import order_header_mart
from orderloom.workload.facts import INITIAL, PROFILE, Source, _line_versions
from orderloom.workload.registry import as_doubles, new_folder, query
from orderloom.workload.standins import Inputs

FIRST, SECOND = datetime(2024, 1, 2), datetime(2024, 1, 3)
STAMP = "loaded_ts"


@dataclass(frozen=True)
class Story:
    """``late`` rows of a table come with the second batch only, ``gone`` ones with the first only."""
    model: GoldModel
    late: Mapping[str, str]
    gone: Mapping[str, str]


class Batch(Source):
    """The source tables as they stand at a batch, each row with the time it was loaded."""

    def __init__(self, t: Inputs, story: Story, number: int):
        super().__init__(t)
        self.story, self.number = story, number

    def build(self, name: str) -> DataFrame:
        # the facts know locations by other columns than the dimension's source has
        whole = name == "locations" and self.story.model.name == "location"
        rows = self.t.sql(LOCATIONS) if whole else super().build(name)
        if self.story.model.name == "allocation" and name in ("allocations", "release_lines"):
            # an allocation has a number of its own, which those of the other stand-ins have not
            rows = rows.withColumn("allocation_id", F.concat(F.lit("AL"), "order_line_pk"))
        late = F.expr(self.story.late.get(name, "FALSE"))
        gone = F.expr(self.story.gone.get(name, "FALSE"))
        first = next(c for c in ("item_id", *rows.columns) if c in rows.columns)
        # the first batch was loaded in the course of an hour, the late rows a day after
        seconds = F.pmod(F.xxhash64(F.col(first).cast("string")), F.lit(3600)).cast("int")
        early = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(secs=seconds.cast("decimal(18,6)"))
        loaded = F.when(late, F.lit(datetime(2024, 1, 2, 12)).cast("timestamp_ntz")).otherwise(early)
        return rows.withColumn(STAMP, loaded).filter(~late if self.number == 1 else ~gone)

    def make_line_versions(self, t: Inputs) -> DataFrame:
        return _line_versions(t).filter("active_flg = 'Y'")

    def make_reservations(self, t: Inputs) -> DataFrame:
        return t["src_allocations"].select("org_id", F.col("reservation_request_id").alias("request_id")).distinct(
            ).withColumns({"is_confirmed": F.lit(1), "supply_profile_id": F.lit("p"), "reservation_version": F.lit(1),
                           "all_or_none": F.lit("x"), "demand_type": F.lit("web"),
                           "reservation_expiry_date": F.lit(None).cast("timestamp_ntz")})

    def make_supply(self, t: Inputs) -> DataFrame:
        return t.sql(SUPPLY)

    def make_supply_allocations(self, t: Inputs) -> DataFrame:
        return t.sql(SUPPLY_ALLOCATIONS)

    def make_exclusions(self, t: Inputs) -> DataFrame:
        return t.sql(EXCLUSIONS)

    def make_network_alerts(self, t: Inputs) -> DataFrame:
        return t["src_network"]

    def make_network_full(self, t: Inputs) -> DataFrame:
        return t["src_network"]

    def make_location_delta(self, t: Inputs) -> DataFrame:
        return t["src_location_feed"]

    def make_location_full(self, t: Inputs) -> DataFrame:
        return t["src_location_feed"]

    def make_users(self, t: Inputs) -> DataFrame:
        return t.sql(USERS)

    def make_item_codes(self, t: Inputs) -> DataFrame:
        return t.sql(ITEM_CODES)

    def make_handling_attributes(self, t: Inputs) -> DataFrame:
        return t.sql("SELECT p_partkey AS item_pk, 0 AS is_frozen FROM {part}")

    def make_location_contacts(self, t: Inputs) -> DataFrame:
        return t.sql(CONTACTS)

    def _named(self, table: str, number: str, text: str, name: str) -> DataFrame:
        return self.t[table].select(F.col(number).cast("string").alias(f"location_{name}_id"),
                                    F.col(text).alias(f"location_{name}_name"), F.lower(text).alias(f"location_{name}_desc"))

    def make_location_statuses(self, t: Inputs) -> DataFrame:
        return self._named("nation", "n_nationkey", "n_name", "status")

    def make_location_types(self, t: Inputs) -> DataFrame:
        return self._named("region", "r_regionkey", "r_name", "type")

    def make_location_sub_types(self, t: Inputs) -> DataFrame:
        return self._named("nation", "n_nationkey", "n_name", "sub_type")

    def make_location_contact_types(self, t: Inputs) -> DataFrame:
        return self._named("region", "r_regionkey", "r_name", "contact_type")

    def make_organisations(self, t: Inputs) -> DataFrame:
        return t.sql("SELECT n_nationkey AS pk, n_name AS organization_id FROM {nation}")

    def make_hierarchy(self, t: Inputs) -> DataFrame:
        return t.sql(HIERARCHY)

    def make_combo_promotions(self, t: Inputs) -> DataFrame:
        return t.sql(PROMOTIONS)

    def make_combo_qualifiers(self, t: Inputs) -> DataFrame:
        return t.sql(COMBO_QUALIFIERS)

    def make_item_promotions(self, t: Inputs) -> DataFrame:
        return t.sql("SELECT 'main' AS profile_id, CAST(p_partkey AS STRING) AS promo_id, p_partkey AS pk, p_name AS promo_group "
                     "FROM {part} WHERE p_partkey % 2 = 0")

    def make_item_qualifiers(self, t: Inputs) -> DataFrame:
        return t.sql(ITEM_QUALIFIERS)

    def make_promotion_types(self, t: Inputs) -> DataFrame:
        return t.sql("SELECT 'main' AS profile_id, '0' AS promo_type_id, 'even' AS description FROM {region} WHERE r_regionkey = 0")


# small source tables, in the SQL that Spark and DuckDB share
SUPPLY = """SELECT CAST(p_partkey AS STRING) AS pk, CASE p_size % 3 WHEN 0 THEN 'On Hand Available' WHEN 1 THEN 'In Transit'
  ELSE 'Other' END AS supply_type, p_size AS quantity, CAST(p_partkey % 10 AS STRING) AS location_id FROM {part}"""
SUPPLY_ALLOCATIONS = """SELECT CAST(p_partkey AS STRING) AS supply_pk, p_partkey + 5 AS pk, 1 AS allocated_quantity,
  CAST(NULL AS TIMESTAMP) AS updated_timestamp FROM {part} WHERE p_partkey % 2 = 0"""
EXCLUSIONS = """SELECT 'EX' || CAST(l_partkey % 100 AS STRING) AS exclusion_id, l_returnflag AS exclusion_level,
  CAST(max(l_linenumber) AS BIGINT) AS style_id, max(l_shipdate) AS updated_at, min(l_shipdate) AS created_at
  FROM {lineitem} GROUP BY l_partkey % 100, l_returnflag"""
USERS = """SELECT s_suppkey AS pk, s_name AS user_id, 'Ann' || CAST(s_suppkey AS STRING) AS first_name,
  CAST(s_nationkey AS STRING) AS address_state, CAST(s_suppkey % 2 AS STRING) AS is_active FROM {supplier}"""
ITEM_CODES = """SELECT p_partkey AS item_pk, 'upc' AS code_type_id, CAST(p_partkey AS STRING) AS value FROM {part}
  WHERE p_partkey % 4 <> 0 UNION ALL SELECT p_partkey, 'Ean', 'x' FROM {part} WHERE p_partkey % 4 = 1"""
LOCATIONS = """SELECT s_suppkey AS pk, CAST(s_suppkey AS STRING) AS location_id, CAST(s_suppkey % 7 AS STRING)
  AS location_type_id, CAST(s_nationkey AS STRING) AS location_status_id, CAST(s_suppkey % 30 AS STRING)
  AS location_sub_type_id FROM {supplier}"""
CONTACTS = """SELECT s_suppkey AS location_pk, CASE WHEN s_suppkey % 2 = 0 THEN 'C' ELSE 'Test' END ||
  CAST(s_suppkey AS STRING) AS location_contact_id, CAST(s_suppkey % 6 AS STRING) AS location_contact_type_id FROM {supplier}"""
HIERARCHY = """SELECT n_nationkey AS organization_pk, n_nationkey AS pk, 'P' || CAST(n_regionkey AS STRING)
  AS parent_organization_id, n_name AS child_organization_id FROM {nation} WHERE n_nationkey % 2 = 0"""
PROMOTIONS = """SELECT 'main' AS profile_id, CAST(p_partkey AS STRING) AS promo_id, p_partkey AS pk,
  CAST(p_size % 2 AS STRING) AS promo_type FROM {part}"""
COMBO_QUALIFIERS = """SELECT 'main' AS profile_id, p_partkey AS combo_promotion_config_pk, p_size AS min_units FROM {part}
  WHERE p_partkey % 3 = 0"""
ITEM_QUALIFIERS = """SELECT 'main' AS profile_id, p_partkey AS item_promotion_config_pk, 'if' AS promo_condition,
  'q' AS qualifier_desc FROM {part} WHERE p_partkey % 4 = 0"""


# Checks --------------------------------------------------------------------------------

def _hash(columns: tuple[str, ...]) -> str:
    return "sha256(" + " || chr(1) || ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns) + ")"


_D1, _D2 = f"TIMESTAMP '{FIRST}'", f"TIMESTAMP '{SECOND}'"


def _versions(body: str, tables: Mapping[str, tuple[str, str, str]], keys: tuple[str, ...], context: tuple[str, ...],
              leaves: str, kind: int, status: str | None) -> str:
    """Versions from the rows of ``body`` as they are in both batches. ``tables`` are names in the body: SQL, late, gone;
    ``leaves`` tells of a row whether its source row goes, which ends (2) or removes (1) it."""
    ctes = []
    for name, (source, late, gone) in tables.items():
        for n, missing in ((1, late), (2, gone)):
            ctes.append(f"{name}_{n} AS (SELECT * FROM ({source.replace('{', '').replace('}', '')}) WHERE NOT ({missing}))")
    for n in (1, 2):
        text = body
        for name in tables:
            text = text.replace("{" + name + "}", f"{name}_{n}")
        ctes.append(f"b{n} AS (SELECT {_hash(keys)} AS sk, {_hash(context)} AS seq, {status or 'NULL'} AS st, ({leaves}) AS leaves "
                    f"FROM ({text}))")
    flag = ", CASE WHEN start_ts = max(start_ts) OVER (PARTITION BY sk, st) THEN 'Y' ELSE 'N' END AS status_hist_flg" if status else ""
    removed = " AND NOT b1.leaves" if kind == 1 else ""
    ended = "b1.leaves OR " if kind == 2 else ""
    return "WITH " + ",\n".join(ctes) + f""", v AS (
      SELECT b1.sk, b1.seq, b1.st, {_D1} AS start_ts, CASE WHEN {ended} b2.seq <> b1.seq THEN {_D2} END AS end_ts
      FROM b1 LEFT JOIN b2 ON b2.sk = b1.sk WHERE TRUE {removed}
      UNION ALL SELECT b2.sk, b2.seq, b2.st, {_D2}, NULL FROM b2 LEFT JOIN b1 ON b1.sk = b2.sk
      WHERE b1.sk IS NULL OR b1.seq <> b2.seq)
    SELECT sk AS hash_sk, seq AS hash_seq_num, start_ts, CAST(end_ts AS TIMESTAMP) AS end_ts,
      CASE WHEN end_ts IS NULL THEN 'Y' ELSE 'N' END AS active_flg {flag} FROM v"""


def _load(t: Inputs, story: Story) -> DataFrame:
    """Both batches, the second from the watermark that the first has left, and run twice."""
    root = new_folder(t, story.model.name)
    loader = GoldLoader(t.spark, root, Batch(t, story, 1), buckets=8, stamp=STAMP)
    loader.run(story.model, 1, FIRST)
    loader.tables = Batch(t, story, 2)
    loader.run(story.model, 2, SECOND)
    flag = [G.STATUS_FLAG] if story.model.status else []
    return loader.table(story.model).read().select("hash_sk", "hash_seq_num", "start_ts", "end_ts", "active_flg", *flag)


def gold_query(model: GoldModel, context: tuple[str, ...], body: str, tables: Mapping[str, tuple[str, str, str]],
               leaves: str = "FALSE", uses: tuple[str, ...] = (), named: Mapping[str, str] | None = None,
               keys: tuple[str, ...] | None = None, check: str | None = None,
               make: Callable[[Story], Story] = lambda s: s) -> None:
    """Register ``load_<model>``. ``named`` gives the source table of a name in the body where they differ."""
    names = {name: (named or {}).get(name, name) for name in tables}
    late = {names[n]: rule[1] for n, rule in tables.items() if rule[1] != "FALSE"}
    gone = {names[n]: rule[2] for n, rule in tables.items() if rule[2] != "FALSE"}
    model = replace(model, context=context, keys=keys or model.keys)
    story = make(Story(model, late, gone))
    kind = model.deletion.kind if model.deletion else 0
    text = check or _versions(body, tables, model.keys, context, leaves, kind, model.status)

    def load(t: Inputs) -> DataFrame:
        return _load(t, story)

    query(text, uses=uses, name=f"load_{model.name}")(load)


_SUM = """SELECT {group}, sum(coalesce(charge_total, requested_amount)) AS {name} FROM {{charges}} WHERE lower(charge_type_id) =
  '{kind}' AND coalesce(charge_total, requested_amount, 0) <> 0 GROUP BY ALL"""

gold_query(G.order_header(INITIAL, PROFILE), ("max_fulfillment_status_id", "promotion"), f"""
  SELECT o.org_id, o.order_id, o.pk, o.max_fulfillment_status_id, c.promotion FROM {{orders}} o LEFT JOIN (
    {_SUM.format(group='org_id, order_pk', name='promotion', kind='promotion')}) c ON c.org_id = o.org_id AND
    c.order_pk = o.pk""",
           {"orders": ("SELECT * FROM src_orders", "pk LIKE '%8'", "pk LIKE '%55'"),
            "charges": ("SELECT * FROM src_charges WHERE lost = 0", "order_pk LIKE '%3'", "FALSE")},
           "pk LIKE '%55'", ("src_orders", "src_charges"), {"charges": "order_charges"})


@query(f"""WITH v AS (SELECT org_id, order_id, '1000.000' AS s, updated_timestamp - INTERVAL 1 DAY AS start_ts,
    updated_timestamp AS end_ts FROM src_orders
  UNION ALL SELECT org_id, order_id, max_fulfillment_status_id, updated_timestamp, CASE WHEN pk LIKE '%55' THEN {_D2} END
  FROM src_orders)
  SELECT {_hash(('org_id', 'order_id'))} AS hash_sk, {_hash(('s',))} AS hash_seq_num, start_ts, end_ts,
    CASE WHEN end_ts IS NULL THEN 'Y' ELSE 'N' END AS active_flg, 'Y' AS status_hist_flg FROM v""", uses=["src_orders"])
def load_order_header_history(t: Inputs) -> DataFrame:
    """Versions start at their own update; the newer one of some orders comes with the second batch."""
    model = replace(G.order_header_history(INITIAL, PROFILE), context=("max_fulfillment_status_id",))
    late = {"orders": "max_fulfillment_status_id <> '1000.000' AND pk LIKE '%8'"}
    story = Story(model, late, {"orders": "pk LIKE '%55'"})
    root = new_folder(t, model.name)
    batches = []
    for n in (1, 2):
        batch = Batch(t, story, n)
        now = t["src_orders"]
        both = now.unionByName(now.withColumns({
            "updated_timestamp": F.col("updated_timestamp") - F.expr("interval 1 day"),
            "max_fulfillment_status_id": F.lit("1000.000")}))
        is_late, gone = F.expr(late["orders"]), F.expr("pk LIKE '%55'")
        stamp = F.when(is_late, F.lit(datetime(2024, 1, 2, 12))).otherwise(F.lit(datetime(2024, 1, 1))).cast("timestamp_ntz")
        batch["orders"] = both.withColumn(STAMP, stamp).filter(~is_late if n == 1 else ~gone)
        batches.append(batch)
    loader = GoldLoader(t.spark, root, batches[0], buckets=8, stamp=STAMP)
    loader.run(model, 1, FIRST)
    loader.tables = batches[1]
    loader.run(model, 2, SECOND)
    return loader.table(model).read().select("hash_sk", "hash_seq_num", "start_ts", "end_ts", "active_flg", G.STATUS_FLAG)


gold_query(G.order_line(INITIAL, PROFILE, PROFILE), ("max_fulfillment_status_id", "coupon"), f"""
  SELECT l.org_id, l.order_id, l.order_line_id, l.pk, l.max_fulfillment_status_id, c.coupon FROM (SELECT * FROM {{lines}}
    QUALIFY row_number() OVER (PARTITION BY org_id, order_id, order_line_id ORDER BY updated_timestamp DESC, pk DESC) = 1) l
    LEFT JOIN ({_SUM.format(group='org_id, order_line_pk', name='coupon', kind='coupon')}) c ON c.org_id = l.org_id AND
    c.order_line_pk = l.pk""",
           # of some lines only a charge arrives in the second batch, of others only a newer status
           {"lines": ("SELECT * FROM src_lines", "max_fulfillment_status_id = '9000.000'", "pk LIKE '%77'"),
            "charges": ("SELECT * FROM src_charges WHERE lost = 0", "charge_detail_id LIKE 'c_3%' AND order_line_pk LIKE '%5'",
                        "FALSE")},
           "pk LIKE '%77'", ("src_lines", "src_charges"), {"lines": "order_line_history", "charges": "line_charges"})

gold_query(G.payment_line(), ("transaction_type", "payment_type", "avs_code"), """
  SELECT b.org_id, b.order_id, m.payment_method_id, b.payment_transaction_id AS transaction_id,
    b.dtl AS transaction_detail_id, coalesce(b.invoice_id, f.invoice_id) AS invoice_id,
    coalesce(b.invoice_line_id, f.invoice_line_id) AS invoice_line_id, b.transaction_type, m.payment_type, a.value AS avs_code,
    b.pk FROM (SELECT t.*, d.payment_transaction_detail_id AS dtl, i.invoice_id, il.invoice_line_id FROM {transactions} t
      LEFT JOIN src_transaction_details d ON d.org_id = t.org_id AND d.payment_transaction_pk = t.pk
      LEFT JOIN src_invoices i ON i.org_id = t.org_id AND i.invoice_id = d.reference_id
      LEFT JOIN src_invoice_lines il ON il.org_id = i.org_id AND il.invoice_pk = i.pk) b
    LEFT JOIN (SELECT t.org_id, t.order_id, t.request_id, i.invoice_id, il.invoice_line_id FROM src_transactions t
      JOIN src_transaction_details d ON d.org_id = t.org_id AND d.payment_transaction_pk = t.pk
      JOIN src_invoices i ON i.org_id = t.org_id AND i.invoice_id = d.reference_id
      JOIN src_invoice_lines il ON il.org_id = i.org_id AND il.invoice_pk = i.pk) f ON b.invoice_id IS NULL AND
        lower(b.transaction_type) NOT IN ('authorization', 'authorization reversal', 'settlement') AND
        f.org_id = b.org_id AND f.order_id = b.order_id AND f.request_id = b.follow_on_id
    JOIN src_payment_methods m ON m.org_id = b.org_id AND m.pk = b.payment_method_pk
    JOIN {headers} h ON h.org_id = m.org_id AND h.pk = m.payment_header_pk
    LEFT JOIN {attributes} a ON a.org_id = m.org_id AND a.payment_method_pk = m.pk""",
           {"transactions": ("SELECT * FROM src_transactions", "pk LIKE 'TF%3'", "pk LIKE 'TF%7'"),
            "headers": ("SELECT * FROM src_payment_headers", "pk LIKE '%6'", "FALSE"),
            "attributes": ("SELECT org_id, pk AS payment_method_pk, vendor_id AS value FROM src_payment_methods",
                           "payment_method_pk LIKE '%4'", "FALSE")},
           "pk LIKE 'TF%7'", ("src_transactions", "src_transaction_details", "src_invoices", "src_invoice_lines",
                              "src_payment_methods", "src_payment_headers"),
           {"headers": "payment_headers", "attributes": "method_attributes"})

gold_query(G.allocation(), ("status_id", "release_id"), """
  SELECT a.pk AS allocation_pk, 'AL' || a.order_line_pk AS allocation_id, l.org_id, l.order_id, l.order_line_id, a.pk,
    CASE WHEN trim(a.status_id) <> '' THEN a.status_id END AS status_id, rel.release_id
  FROM {allocations} a JOIN (SELECT DISTINCT org_id, pk, order_id, order_line_id FROM src_lines) l ON l.org_id = a.org_id AND
      l.pk = a.order_line_pk
    LEFT JOIN (SELECT r.org_id, r.order_id, r.release_id, rl.order_line_id, rl.allocation_id, rl.order_line_pk FROM src_releases r
      JOIN {release_lines} rl ON rl.org_id = r.org_id AND rl.release_pk = r.pk) rel ON rel.org_id = a.org_id AND
      rel.order_line_pk = a.order_line_pk AND rel.allocation_id = a.allocation_id""",
           {"allocations": ("SELECT * FROM src_allocations", "pk LIKE '%6'", "pk LIKE '%44'"),
            "release_lines": ("SELECT * FROM src_release_lines", "pk LIKE '%3'", "FALSE")},
           "pk LIKE '%44'", ("src_allocations", "src_release_lines", "src_releases", "src_lines"))

gold_query(G.fulfilment_header(PROFILE), ("max_status_id", "package_status"), """
  SELECT f.org_id, f.fulfillment_id, f.pk, f.max_status_id, CAST(nullif(p.package_status, '') AS INTEGER) AS package_status
  FROM {fulfilments} f LEFT JOIN (SELECT * FROM {packages} QUALIFY row_number() OVER (PARTITION BY org_id, fulfillment_id
    ORDER BY src_load_ts DESC, pk DESC) = 1) p ON p.org_id = f.org_id AND p.fulfillment_id = f.fulfillment_id""",
           {"fulfilments": ("SELECT * FROM src_fulfilments", "pk LIKE '%8'", "pk LIKE '%66'"),
            "packages": ("SELECT * FROM src_packages", "pk LIKE '%2'", "FALSE")},
           "pk LIKE '%66'", ("src_fulfilments", "src_packages"))

gold_query(G.fulfilment_line(PROFILE, PROFILE), ("fulfillment_line_status_id", "short_reason_id"), """
  SELECT f.org_id, h.fulfillment_id, f.fulfillment_line_id, f.pk, f.fulfillment_line_status_id, s.short_reason_id
  FROM {lines} f JOIN src_fulfilments h ON h.org_id = f.org_id AND h.pk = f.fulfillment_pk
    LEFT JOIN {shorts} s ON s.org_id = f.org_id AND s.pk = f.pk AND s.at = f.fulfillment_line_status_id""",
           {"lines": ("SELECT * FROM src_fulfilment_lines", "pk LIKE '%8'", "pk LIKE '%44'"),
            "shorts": ("""SELECT org_id, pk, '2000.000' AS short_reason_id, CASE WHEN ordered_qty % 4 = 0 THEN '3000.000'
              ELSE '4000.000' END AS at FROM src_fulfilment_lines WHERE ordered_qty % 2 = 0""", "pk LIKE '%2'", "FALSE")},
           "pk LIKE '%44'", ("src_fulfilment_lines", "src_fulfilments"),
           {"lines": "fulfilment_lines", "shorts": "line_shorts"})

_PAPER = """SELECT i.org_id, i.package_id, il.package_detail_id, i.invoice_id FROM src_invoices i JOIN {lines} il ON
  il.org_id = i.org_id AND il.invoice_pk = i.pk QUALIFY row_number() OVER (PARTITION BY i.org_id, i.package_id,
  il.package_detail_id ORDER BY il.updated_timestamp DESC, i.updated_timestamp DESC, il.pk DESC) = 1"""
# package numbers of the stand-ins repeat over orders, so the order is part of the key here
gold_query(G.package_detail(), ("package_status", "invoice_id"), f"""
  SELECT d.org_id, p.order_id, p.package_id, d.package_detail_id, d.pk, CAST(nullif(p.package_status, '') AS INTEGER)
    AS package_status, coalesce(i.invoice_id, 'E' || e.invoice_id) AS invoice_id
  FROM {{details}} d JOIN src_packages p ON p.org_id = d.org_id AND p.pk = d.packages_pk
    LEFT JOIN ({_PAPER.format(lines='{invoice_lines}')}) i ON i.org_id = d.org_id AND i.package_id = p.package_id AND
      i.package_detail_id = d.package_detail_id
    LEFT JOIN ({_PAPER.format(lines='src_invoice_lines')}) e ON e.org_id = d.org_id AND e.package_id = p.package_id AND
      e.package_detail_id = d.package_detail_id""",
           {"details": ("SELECT * FROM src_package_details", "pk LIKE '%8'", "pk LIKE '%44'"),
            "invoice_lines": ("SELECT * FROM src_invoice_lines", "pk LIKE '%3'", "FALSE")},
           "pk LIKE '%44'", ("src_package_details", "src_packages", "src_invoices", "src_invoice_lines"),
           {"details": "package_details"}, keys=("org_id", "order_id", "package_id", "package_detail_id"))

gold_query(G.release_detail(PROFILE), ("status", "tracking_number"), """
  SELECT l.org_id, l.order_id, l.order_line_id, r.release_id, rl.release_line_id, rl.pk,
    coalesce(CAST(CAST(d.status_id AS DOUBLE) AS INTEGER), 1000) AS status, d.tracking_number
  FROM {release_lines} rl JOIN src_releases r ON r.org_id = rl.org_id AND r.pk = rl.release_pk
    JOIN (SELECT DISTINCT org_id, order_id, order_line_id FROM src_lines) l ON l.org_id = r.org_id AND
      l.order_id = r.order_id AND l.order_line_id = rl.order_line_id
    LEFT JOIN {details} d ON d.org_id = rl.org_id AND d.release_id = r.release_id AND d.release_line_id = rl.release_line_id""",
           {"release_lines": ("SELECT * FROM src_release_lines", "pk LIKE '%8'", "pk LIKE '%44'"),
            "details": ("SELECT * FROM src_fulfilment_details", "pk LIKE '%3'", "FALSE")},
           "pk LIKE '%44'", ("src_release_lines", "src_releases", "src_lines", "src_fulfilment_details"),
           {"details": "fulfillment_details"})

gold_query(G.inventory_supply(), ("on_hand_available", "in_transit"), """
  SELECT s.pk AS supply_pk, coalesce(a.pk, -1) AS supply_allocation_pk,
    CASE WHEN supply_type = 'On Hand Available' THEN quantity ELSE 0 END AS on_hand_available,
    CASE WHEN supply_type = 'In Transit' THEN quantity ELSE 0 END AS in_transit
  FROM {supply} s LEFT JOIN {allocations} a ON a.supply_pk = s.pk""",
           {"supply": (SUPPLY, "pk LIKE '%3'", "pk LIKE '%77'"),
            "allocations": (SUPPLY_ALLOCATIONS, "supply_pk LIKE '%4'", "FALSE")},
           "supply_pk LIKE '%77'", named={"allocations": "supply_allocations"})

gold_query(G.sku_exclusion(), ("style_id",), "SELECT * FROM {exclusions}",
           {"exclusions": (EXCLUSIONS, "exclusion_id LIKE '%5'", "FALSE")})

for _model, _feed, _place, _context in ((G.network_availability(), "src_network", "", ("on_hand_status", "store_atp")),
                                        (G.location_availability(), "src_location_feed", "location_id, ",
                                         ("on_hand_status", "country"))):
    _types = ("networkFullAvailabilitySync", "networkAvailabilityAlert") if not _place else (
        "locationAvailabilityFullSync", "locationAvailabilityDeltaSync")
    _item = "item_id" if _place else "trim(item_id) AS item_id"
    _keyed = [f"strftime({k}, '%Y-%m-%d %H:%M:%S')" if k == "updated_ts" else k for k in _model.keys]
    _filter = "location_id IS NOT NULL" if _place else "TRUE"
    # a key without its amount may come with several amounts at once: the highest of them counts
    _tie = "1" if _place else "atp DESC NULLS LAST"
    _value = "CASE WHEN coalesce(atp, 0) = 0 THEN 0 ELSE store_atp END AS store_atp, coalesce(atp, 0) AS atp" if not _place else "atp"
    _text = f"""WITH f AS (SELECT * FROM {_feed} WHERE message_type IN {_types} AND {_filter} QUALIFY row_number() OVER (
        PARTITION BY item_id, {_place} updated_ts, selling_channel, message_type ORDER BY header_ts DESC, load_ts DESC, {_tie}) = 1),
      g AS (SELECT {_item}, {_place} updated_ts, selling_channel, message_type, load_ts, on_hand_status, country, {_value} FROM f)
      SELECT {_hash(tuple(_keyed))} AS hash_sk, load_ts AS start_ts, CAST(NULL AS TIMESTAMP) AS end_ts, 'Y' AS active_flg FROM g"""

    def _feed_load(t: Inputs, model=_model, place=_place, context=_context) -> DataFrame:
        late = "item_id LIKE '%3'"
        names = ("location_delta", "location_full") if place else ("network_alerts", "network_full")
        story = Story(replace(model, context=context), dict.fromkeys(names, late), {})
        return _load(t, story).drop("hash_seq_num")

    query(_text, uses=(_feed,), name=f"load_{_model.name}")(_feed_load)

gold_query(G.customer(), ("customer_first_name", "customer_phone", "shipping_address_lastname", "billing_address_lastname"), """
  SELECT o.org_id, o.customer_id, upper(customer_first_name) AS customer_first_name, customer_phone,
    CASE WHEN package_count <> 2 THEN 'LEE' END AS shipping_address_lastname, b.last AS billing_address_lastname
  FROM (SELECT * FROM {orders} WHERE customer_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY org_id, customer_id ORDER BY
    src_load_ts DESC, order_id DESC) = 1) o LEFT JOIN (SELECT DISTINCT h.org_id, h.order_id, 'BILL' AS last FROM
      src_payment_headers h JOIN src_payment_methods m ON m.org_id = h.org_id AND m.payment_header_pk = h.pk
      WHERE m.payment_type <> 'Gift Card') b ON b.org_id = o.org_id AND b.order_id = o.order_id""",
           {"orders": ("SELECT * FROM src_orders", "pk LIKE '%8'", "FALSE")},
           uses=("src_orders", "src_payment_headers", "src_payment_methods"))

gold_query(G.employee(), ("first_name", "state", "is_active"),
           "SELECT pk, user_id, first_name, address_state AS state, is_active FROM {users}",
           {"users": (USERS, "pk % 10 = 3", "pk % 10 = 7")}, "pk % 10 = 7")

gold_query(G.item(), ("max_discount_amount", "brand"), """
  SELECT p.p_partkey AS item_pk, p_size AS max_discount_amount, p_brand AS brand, coalesce('{"' || upper(c.code_type_id) ||
    '":"' || c.value || '"}', '{}') AS item_codes FROM (SELECT * FROM {parts}) p LEFT JOIN {codes} c ON
    c.item_pk = p.p_partkey""".replace("'{\"'", "chr(123) || '\"'").replace("'\"}'", "'\"' || chr(125)").replace(
        "'{}'", "chr(123) || chr(125)"),
           {"parts": ("SELECT *, p_partkey AS pk FROM part", "pk % 10 = 3", "pk % 10 = 7"),
            "codes": (ITEM_CODES, "code_type_id = 'Ean'", "FALSE")}, "item_pk % 10 = 7",
           named={"parts": "items", "codes": "item_codes"})

gold_query(G.location(), ("location_type_name", "location_contact_id"), """
  SELECT l.pk AS location_pk, l.location_id, t.r_name AS location_type_name, c.location_contact_id FROM {locations} l
    LEFT JOIN region t ON CAST(t.r_regionkey AS VARCHAR) = l.location_type_id
    LEFT JOIN {contacts} c ON c.location_pk = l.pk AND c.location_contact_id NOT LIKE 'Test%'""",
           {"locations": (LOCATIONS, "pk % 10 = 3", "pk % 10 = 7"), "contacts": (CONTACTS, "location_pk % 4 = 0", "FALSE")},
           "location_pk % 10 = 7", named={"contacts": "location_contacts"})

gold_query(G.organisation(), ("org_id", "parent_organization_id"), """
  SELECT o.pk AS org_pk, o.organization_id AS org_id, h.pk AS hierarchy_pk, h.parent_organization_id FROM {organisations} o
    LEFT JOIN {hierarchy} h ON h.organization_pk = o.pk""",
           {"organisations": ("SELECT n_nationkey AS pk, n_name AS organization_id FROM nation", "pk % 10 = 3", "pk % 10 = 7"),
            "hierarchy": (HIERARCHY, "pk % 4 = 0", "FALSE")}, "org_pk % 10 = 7")

gold_query(G.promotion(), ("promo_type_desc", "item_promo_condition", "combo_min_units"), """
  SELECT p.profile_id, p.promo_id, p.pk, CASE WHEN p.promo_type = '0' THEN 'even' END AS promo_type_desc,
    CASE WHEN p.pk % 2 = 0 THEN i.promo_condition END AS item_promo_condition, c.min_units AS combo_min_units
  FROM {promotions} p LEFT JOIN {combo} c ON c.combo_promotion_config_pk = p.pk LEFT JOIN {conditions} i ON
    i.item_promotion_config_pk = p.pk""",
           {"promotions": (PROMOTIONS, "pk % 10 = 3", "pk % 10 = 7"),
            "combo": (COMBO_QUALIFIERS, "combo_promotion_config_pk % 9 = 0", "FALSE"),
            "conditions": (ITEM_QUALIFIERS, "item_promotion_config_pk % 8 = 0", "FALSE")}, "pk % 10 = 7",
           named={"promotions": "combo_promotions", "combo": "combo_qualifiers", "conditions": "item_qualifiers"})


# Marts from facts ------------------------------------------------------------------------

_STATUS = """CASE WHEN CAST(CAST(max_fulfillment_status_id AS DOUBLE) AS INTEGER) = 3000 THEN 'FULFILMENT_PROCESSING'
  WHEN CAST(CAST(max_fulfillment_status_id AS DOUBLE) AS INTEGER) = 7000 THEN 'FULFILMENT_COMPLETE' ELSE 'CANCELLED' END"""


@query(f"""WITH l AS (SELECT * FROM src_lines QUALIFY row_number() OVER (PARTITION BY org_id, order_id, order_line_id ORDER BY
    updated_timestamp DESC, pk DESC) = 1),
  c AS (SELECT org_id, order_line_pk, sum(coalesce(charge_total, requested_amount)) AS coupon FROM src_charges
    WHERE lower(charge_type_id) = 'coupon' AND coalesce(charge_total, requested_amount, 0) <> 0 GROUP BY ALL),
  s AS (SELECT l.org_id, l.order_id, abs(sum(CASE WHEN coalesce(order_line_sub_total, 0) = 0 AND item_id LIKE '%ECARD%' THEN
      coalesce(gift_card_value, 0) ELSE coalesce(order_line_sub_total, 0) END)) AS sub, abs(coalesce(sum(coupon), 0)) AS coupon
    FROM l LEFT JOIN c ON c.org_id = l.org_id AND c.order_line_pk = l.pk
    WHERE parent_order_id IS NULL OR is_even_exchange = 1 GROUP BY ALL)
  SELECT org_id, order_id, {_STATUS} AS order_status, CAST(sub AS DOUBLE) AS sub_total_amount,
    CAST(s.coupon AS DOUBLE) AS coupon_amount FROM src_orders JOIN s USING (org_id, order_id)
  WHERE order_type_id <> 'Launch'""", uses=["src_lines", "src_charges", "src_orders"])
def order_mart_from_facts(t: Inputs) -> DataFrame:
    """Gold loads of headers, lines and payments, and the order mart from their pinned versions."""
    story = Story(G.order_header(INITIAL, PROFILE), {}, {})
    loader = GoldLoader(t.spark, new_folder(t, "facts"), Batch(t, story, 1), buckets=8, stamp=STAMP)
    models = G.order_header(INITIAL, PROFILE), G.order_line(INITIAL, PROFILE, PROFILE), G.payment_line()
    for model in models:
        loader.run(model, 1, FIRST, "FULL")
    facts = pinned_sources(*[loader.table(m) for m in models])
    mart = order_header_mart(facts.headers, facts.lines, facts.payments, t["places"], t["stores"], t["cancel_codes"])
    return as_doubles(mart.select("org_id", "order_id", "order_status", "sub_total_amount", "coupon_amount"))
