"""Amounts of an order line as they stood at its first status.

Marts report what was ordered, so each amount is the cancelled part plus the current
part of the line's first version. All of them come from one pass over the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.latest import latest_per_key, newest, oldest, spread

LINE_KEY = ("org_id", "order_id", "order_line_id")
ORDER_KEY = ("org_id", "order_id")
# Each of these has a twin named cancelled_<amount>.
PLAIN_AMOUNTS = ("discount", "coupon", "line_total", "charges", "taxes", "sub_total")
# These are kept twice: as they stand now and as first captured (original_<amount>).
CAPTURED_AMOUNTS = ("shipping", "shipping_tax", "sales_tax")
TOTAL_PARTS = ("sub_total_amount", "shipping_amount", "shipping_tax_amount", "sales_tax_amount")
LAST_ORDER_STATUS = 9000


def newest_line() -> list[Column]:
    return newest("updated_ts", "line_version_id")


def newest_header() -> list[Column]:
    return newest("updated_ts", "header_version_id")


def eligible(rows: DataFrame) -> DataFrame:
    """Rows that have reached a status, up to cancelled; later ones are returns."""
    return rows.filter(F.col("max_status") <= LAST_ORDER_STATUS)


def eligible_lines(lines: DataFrame) -> DataFrame:
    """Lines of original orders, and of even exchanges among the follow-up orders."""
    return eligible(lines).filter(F.col("parent_order_id").isNull() | (F.col("is_even_exchange") == 1))


def customer_orders(headers: DataFrame) -> DataFrame:
    return headers.filter(F.col("doc_type") == "CustomerOrder")


def latest_headers(headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Newest header per order; the columns get the prefix ``order_`` unless they have it."""
    rows = latest_per_key(headers, ORDER_KEY, newest_header())
    return rows.select(*ORDER_KEY, *[
        F.col(c).alias(c if c.startswith("order_") else f"order_{c}") for c in columns])


def first_line_rows(lines: DataFrame) -> DataFrame:
    """The version of each line at its lowest status, the earliest of several."""
    return latest_per_key(lines, LINE_KEY, _first_version())


def _first_version() -> list[Column]:
    return [*oldest("max_status", "updated_ts"), F.col("line_version_id").asc()]


def signed_amounts(current_for_returns: bool = False) -> dict[str, Column]:
    """Cancelled plus current part per amount. Returned lines may use the shipping and
    tax amounts as they stand, because nothing was captured for them."""
    def captured(name: str, prefix: str) -> Column:
        first = F.col(f"{prefix}original_{name}")
        if not current_for_returns:
            return first
        return F.when(F.col("is_return") == 1, F.col(prefix + name)).otherwise(first)

    def both(cancelled: Column, current: Column) -> Column:
        return F.coalesce(cancelled, F.lit(0)) + F.coalesce(current, F.lit(0))

    plain = {a: both(F.col(f"cancelled_{a}"), F.col(a)) for a in PLAIN_AMOUNTS}
    return plain | {a: both(captured(a, "cancelled_"), captured(a, "")) for a in CAPTURED_AMOUNTS}


def with_totals(rows: DataFrame) -> DataFrame:
    """Total: goods, shipping and both taxes; discounted total: less the discount."""
    total = sum((F.col(c) for c in TOTAL_PARTS[1:]), F.col(TOTAL_PARTS[0]))
    return rows.withColumn("total_amount", total).withColumn(
        "discounted_total_amount", F.col("total_amount") - F.col("discount_amount"))


def _amount_columns(current_for_returns: bool = False) -> dict[str, Column]:
    """Signed amounts of a row, and those that are told as they are."""
    return {
        "signed_retail_price": F.coalesce("original_unit_price", "unit_price", F.lit(0)),
        "signed_unit_price": F.coalesce("unit_price", F.lit(0)),
        "gift_card_amount": F.abs(F.coalesce("gift_card_value", F.lit(0))),
        "card_or_unit_price": F.abs(F.coalesce("gift_card_value", "unit_price", F.lit(0))),
        "first_line_total": F.abs(F.coalesce("line_total", F.lit(0))),
        **{f"signed_{a}": c for a, c in signed_amounts(current_for_returns).items()}}


def _with_absolute(rows: DataFrame) -> DataFrame:
    names = (*PLAIN_AMOUNTS, *CAPTURED_AMOUNTS, "retail_price", "unit_price")
    return with_totals(rows.withColumns({f"{a}_amount": F.abs(f"signed_{a}") for a in names}))


def line_amounts(first_rows: DataFrame, current_for_returns: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row per line with its combined amounts, as absolute values.

    The signed amounts are kept as ``signed_<amount>`` for sums over an order.
    """
    columns = _amount_columns(current_for_returns)
    return _with_absolute(first_rows.select(*LINE_KEY, *keep, *[c.alias(n) for n, c in columns.items()]))


def with_first_amounts(rows: DataFrame, current_for_returns: bool = False) -> DataFrame:
    """Every version of a line, with the amounts that ``line_amounts`` gives for its first one.

    A window over the versions of a line: rows that are dealt out by line or by order are not dealt out again.
    """
    by_line = Window.partitionBy(*LINE_KEY).orderBy(*_first_version())
    first = rows.withColumn("_first", F.first(F.struct(*[
        c.alias(n) for n, c in _amount_columns(current_for_returns).items()])).over(by_line))
    return _with_absolute(first.select("*", "_first.*").drop("_first"))


def order_amounts() -> list[Column]:
    """Aggregates over the lines of an order: absolute values of the summed amounts."""
    return [*[F.abs(F.sum(c)).alias(f"{a}_amount") for a, c in signed_amounts().items()],
            F.abs(F.coalesce(F.sum("gift_card_value"), F.lit(0))).alias("gift_card_amount"),
            F.abs(F.coalesce(F.sum("line_total"), F.lit(0))).alias("current_line_total"),
            F.abs(F.coalesce(F.sum("sub_total"), F.lit(0))).alias("current_sub_total")]


def with_order_totals(rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Every row, with absolute sums over all rows of its order alongside."""
    per_order = rows.groupBy(*ORDER_KEY).agg(*[F.abs(F.sum(c)).alias(n) for n, c in totals.items()])
    return spread(rows, per_order, ORDER_KEY, null_keys=False)


def ordered_quantity() -> Column:
    """Quantity first ordered for a cancelled line, else the quantity as it stands."""
    return F.when(F.col("max_status").isin(9000, 19000), F.col("original_quantity")).otherwise(F.col("quantity"))
