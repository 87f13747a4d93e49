"""Text, safe-conversion, time and JSON-path expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Empty or all-blank text becomes null; other text is kept as it is."""
    c = col(c)
    return F.when(F.trim(c) != "", c)


def trimmed_lower(c: Column | str) -> Column:
    return F.lower(F.trim(col(c)))


def trimmed_upper(c: Column | str) -> Column:
    return F.upper(F.trim(col(c)))


def normalise(df: DataFrame, lower: Iterable[str] = (), upper: Iterable[str] = (),
              trim: Iterable[str] = ()) -> DataFrame:
    """Trim the named text columns and fold their case, in one projection."""
    changed = {c: trimmed_lower(c) for c in lower}
    changed |= {c: trimmed_upper(c) for c in upper}
    changed |= {c: F.trim(F.col(c)) for c in trim}
    return df.withColumns(changed)


def store_key(c: Column | str, width: int = 5) -> Column:
    """Store numbers compare as zero-padded text."""
    return F.lpad(col(c), width, "0")


def leading_parts(c: Column | str, parts: int, sep: str = "-") -> Column:
    return F.substring_index(col(c), sep, parts)


def between_marks(c: Column | str, mark: str = "_") -> Column:
    """The text between the first and the last ``mark``; null where there is none."""
    found = F.regexp_extract(col(c), f"{mark}(.+){mark}", 1)
    return F.when(found != "", found)


def safe_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    c = col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def safe_number(c: Column | str, kind: str = "decimal(38,0)") -> Column:
    return col(c).try_cast(kind)


def status_or_null(c: Column | str) -> Column:
    """A status number, also from text such as ``3000.000``; null where it is none."""
    return col(c).cast("string").try_cast("decimal(38,3)").cast("int")


def safe_json(c: Column | str) -> Column:
    """The text where it is valid JSON, else null."""
    c = col(c)
    return F.when(F.try_parse_json(c).isNotNull(), c)


def iso_text(c: Column | str, tail: str = "") -> Column:
    """ISO text to the millisecond, with a fixed tail such as ``000000Z``."""
    text = F.date_format(col(c), ISO_MILLIS)
    return F.concat(text, F.lit(tail)) if tail else text


def json_field(c: Column | str, name: str, kind: str = "string") -> Column:
    """One field of a JSON text column. Names may hold dots, colons and dashes."""
    value = F.get_json_object(col(c), f"$['{name}']")
    return value if kind == "string" else value.try_cast(kind)


def flag_text(c: Column | str) -> Column:
    """1/0 to 'true'/'false'; anything else is null."""
    c = col(c)
    return F.when(c == 1, F.lit("true")).when(c == 0, F.lit("false"))


def true_or_null(c: Column) -> Column:
    return F.when(c, F.lit("true"))


def true_or_false(c: Column) -> Column:
    return F.when(c, F.lit("true")).otherwise(F.lit("false"))
