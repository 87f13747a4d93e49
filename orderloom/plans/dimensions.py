"""Dimensions: customer, employee, item, location, organisation, promotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import prefixed
from orderloom.operators.latest import latest_per_key, newest
from orderloom.operators.nested import with_json_fields
from orderloom.plans.amounts import ORDER_KEY

Tables = Mapping[str, DataFrame]

ADDRESS = ("address_firstname", "address_lastname", "address_address1", "address_address2", "address_city",
           "address_postalcode", "address_state", "address_country", "address_email", "address_phone")


def _upper_texts(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Upper-case text columns, phone numbers and ``keep`` apart."""
    texts = [c for c, kind in df.dtypes if kind == "string" and not c.endswith("phone") and c not in keep]
    return df.withColumns({c: F.upper(c) for c in texts})


def customer_dimension(tables: Tables) -> DataFrame:
    """Newest details per customer: from the order, the billing and the ship-to address.
    Key: org_id, customer_id."""
    orders = tables["orders"].filter(F.col("customer_id").isNotNull())
    orders = with_json_fields(orders, "json_store", {
        "loyalty_number": ("extend::FLX-ID", "string"), "company_number": ("extend::CartCompanyNumber", "string")})
    # only the newest order of a customer counts, so the addresses are joined to it alone
    newest_order = latest_per_key(orders, ["org_id", "customer_id"], newest("src_load_ts", "order_id"))
    rows = newest_order.select(*ORDER_KEY, "customer_id", "customer_first_name", "customer_last_name",
                               "customer_phone", "loyalty_number", "company_number", "src_load_ts")
    billing = (tables["payment_headers"].select(*ORDER_KEY, F.col("pk").alias("payment_header_pk"))
               .join(tables["payment_methods"].select("org_id", "payment_header_pk",
                                                      F.col("pk").alias("payment_method_pk")),
                     ["org_id", "payment_header_pk"])
               .join(tables["billing_addresses"].select("org_id", "payment_method_pk", *ADDRESS),
                     ["org_id", "payment_method_pk"]))
    billing = latest_per_key(billing, ORDER_KEY, newest("payment_method_pk"))
    shipping = latest_per_key(tables["ship_to_addresses"], ORDER_KEY, newest("address_id"))
    texts = _upper_texts(rows, keep=(*ORDER_KEY, "customer_id", "loyalty_number", "company_number"))
    billing = prefixed(_upper_texts(billing, keep=ORDER_KEY), "billing_", keys=ORDER_KEY, only=ADDRESS)
    shipping = prefixed(_upper_texts(shipping, keep=ORDER_KEY), "shipping_", keys=ORDER_KEY, only=ADDRESS)
    return texts.join(billing, list(ORDER_KEY), "left").join(shipping, list(ORDER_KEY), "left")


# The columns of a user that the dimension holds, by their names at the source.
EMPLOYEE = {
    "user_pk": "pk", "user_id": "user_id", "user_type_id": "user_type_id", "primary_org_id": "primary_org_id",
    "account_type_id": "account_type_id", "identity_type_id": "identity_type_id", "is_active": "is_active",
    "first_name": "first_name", "last_name": "last_name", "address1": "address_address1", "address2": "address_address2",
    "address3": "address_address3", "country": "address_country", "city": "address_city", "county": "address_county",
    "phone": "address_phone", "postal_code": "address_postalcode", "state": "address_state", "gender": "gender",
    "all_business_units": "has_access_to_all_b_us", "all_locations": "has_access_to_all_locations",
    "business_unit": "userbusinessunit_c", "user_group": "usergroup_c", "supply_location": "userlocationsci_c",
    "location": "userlocation_c", "start_date": "start_date", "end_date": "end_date", "src_load_ts": "src_load_ts"}


def employee_dimension(users: DataFrame) -> DataFrame:
    """One row per user, with identity, address, access and dates. Key: user_id. A column that a source lacks is null."""
    have = set(users.columns)
    return users.select(*[F.col(source).alias(name) if source in have else F.lit(None).cast("string").alias(name)
                          for name, source in EMPLOYEE.items()])


def item_dimension(tables: Tables) -> DataFrame:
    """One row per item and code, with handling and selling attributes. Key: item_pk, item_codes.

    Items are grouped by all of their columns; the highest discount limit stands.
    """
    items = tables["items"].withColumnRenamed("pk", "item_pk")
    codes = tables["item_codes"].select("item_pk", F.upper("code_type_id").alias("_kind"), F.col("value").alias("_value"))
    handling = prefixed(tables["handling_attributes"], "handling_", keys=("item_pk",))
    selling = prefixed(tables["selling_attributes"].drop("max_discount_amount"), "selling_", keys=("item_pk",))
    limits = tables["selling_attributes"].groupBy("item_pk").agg(
        F.max("max_discount_amount").alias("max_discount_amount"))
    rows = (items.join(codes, "item_pk", "left").join(handling, "item_pk", "left")
            .join(selling.distinct(), "item_pk", "left").join(limits, "item_pk", "left"))
    pair = F.when(F.col("_kind").isNotNull() & F.col("_value").isNotNull(),
                  F.create_map("_kind", "_value"))
    text = F.coalesce(F.to_json(pair), F.lit("{}"))
    return rows.withColumn("item_codes", text).drop("_kind", "_value").distinct()


def location_dimension(tables: Tables, profile: str | None = None, test_prefix: str = "Test") -> DataFrame:
    """One row per location and contact, with the names of its status, type, sub-type and
    contact type. Key: location_id."""
    sub_types = tables["location_sub_types"]
    if profile is not None:
        sub_types = sub_types.filter(F.col("profile_id") == profile)
    contacts = tables["location_contacts"].filter(~F.col("location_contact_id").startswith(test_prefix)).select(
        F.col("location_pk"), "location_contact_id", "location_contact_type_id")
    rows = tables["locations"].withColumnRenamed("pk", "location_pk")
    for table, key in (("location_statuses", "location_status"), ("location_types", "location_type")):
        rows = rows.join(tables[table].select(f"{key}_id", f"{key}_name", f"{key}_desc"), f"{key}_id", "left")
    rows = rows.join(sub_types.select("location_sub_type_id", "location_sub_type_name", "location_sub_type_desc"),
                     "location_sub_type_id", "left")
    rows = rows.join(contacts, "location_pk", "left")
    return rows.join(tables["location_contact_types"].select(
        "location_contact_type_id", "location_contact_type_name", "location_contact_type_desc"),
        "location_contact_type_id", "left")


def organisation_dimension(organisations: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """One row per organisation and place in the hierarchy. Key: org_pk, hierarchy_pk."""
    links = hierarchy.select(F.col("organization_pk").alias("org_pk"), F.col("pk").alias("hierarchy_pk"),
                             "parent_organization_id", "child_organization_id")
    rows = organisations.withColumnsRenamed({"pk": "org_pk", "organization_id": "org_id"})
    return rows.join(links, "org_pk", "left")


def promotion_dimension(tables: Tables) -> DataFrame:
    """One row per combined promotion, with its item promotion, qualifiers and type. Key:
    profile_id, promo_id."""
    qualifiers = tables["item_qualifiers"].select(
        "profile_id", F.col("item_promotion_config_pk").alias("pk"), "promo_condition", "qualifier_desc")
    items = prefixed(tables["item_promotions"].join(qualifiers, ["profile_id", "pk"], "left"), "item_",
                     keys=("profile_id", "promo_id"))
    types = tables["promotion_types"].select("profile_id", F.col("promo_type_id").alias("promo_type"),
                                             F.col("description").alias("promo_type_desc"))
    combined = tables["combo_qualifiers"].select(
        "profile_id", F.col("combo_promotion_config_pk").alias("pk"),
        *[F.col(c).alias(f"combo_{c}") for c in tables["combo_qualifiers"].columns
          if c not in ("profile_id", "combo_promotion_config_pk", "pk")])
    return (tables["combo_promotions"].join(combined, ["profile_id", "pk"], "left")
            .join(items, ["profile_id", "promo_id"], "left").join(types, ["profile_id", "promo_type"], "left"))
