"""Hash keys, check digits and sellable keys as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import col

SEPARATOR = "\u0001"
NULL_MARK = "\u0000"


def hash_key(columns: Iterable[Column | str]) -> Column:
    """SHA-256 over the columns as text; null and empty text hash differently."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def email_hash(c: Column | str) -> Column:
    """One rule for every feed: the same address gives the same hash."""
    return F.md5(F.upper(F.trim(col(c))))


def check_digit(c: Column | str) -> Column:
    """The digit that lifts the weighted digit sum to the next multiple of ten.

    Odd places count double (as a digit sum), even places single. Null unless the
    text is made of digits only.
    """
    c = col(c)
    places = F.transform(F.sequence(F.lit(1), F.length(c)),
                         lambda i: F.struct(i.alias("place"), F.substr(c, i, F.lit(1)).cast("int").alias("digit")))

    def weight(p: Column) -> Column:
        double = p["digit"] * 2
        return F.when(p["place"] % 2 == 0, p["digit"]).otherwise(F.when(double > 9, double - 9).otherwise(double))

    total = F.aggregate(places, F.lit(0), lambda acc, p: acc + weight(p))
    return F.when(c.rlike("^[0-9]+$"), (10 - total % 10) % 10)


def sellable_key(key: Column | str, sku: Column | str, sep: str = "-") -> Column:
    """Three leading parts of the key, the check digit of the sku, then the last
    part cut into colour (2) and size (3)."""
    key, sku = col(key), col(sku)
    last = F.substring_index(key, sep, -1)
    prefix = F.regexp_extract(key, f"^([^{sep}]+{sep}[^{sep}]+{sep}[^{sep}]+)", 1)
    digit = check_digit(F.regexp_replace(sku, sep, "")).cast("string")
    # concat, not concat_ws: a sku without a check digit has no sellable key
    dash = F.lit(sep)
    return F.concat(prefix, dash, digit, dash, F.substring(last, 1, 2), dash, F.substring(last, 3, 3))


def sku_with_check_digit(sku: Column | str, sep: str = "-") -> Column:
    """Put the check digit into a four-part numeric sku; other skus stay as they are."""
    sku = col(sku)
    part = [F.split_part(sku, F.lit(sep), F.lit(i)) for i in range(1, 5)]
    colour = F.substring(part[3], 1, 2)
    size = F.substr(part[3], F.lit(3))
    digit = check_digit(F.concat(part[0], part[1], part[2], colour)).cast("string")
    numeric = sku.rlike(f"^[0-9]+({sep}[0-9]+){{3}}$") & (F.length(part[3]) >= 2)
    return F.when(F.trim(sku) != "",
                  F.when(numeric, F.concat_ws(sep, part[0], part[1], part[2], digit, colour, size)).otherwise(sku))
