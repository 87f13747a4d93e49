"""Fan-out of nested messages into rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def fan_out(df: DataFrame, levels: Sequence[tuple[str, str]], keep_empty: bool = True) -> DataFrame:
    """Explode one array after another: each level is (array path, name of the element).

    With ``keep_empty`` a parent without elements stays, with a null element.
    """
    explode = F.explode_outer if keep_empty else F.explode
    for path, name in levels:
        df = df.select("*", explode(path).alias(name))
    return df


def zip_rows(df: DataFrame, keep: Sequence[Column | str], **arrays: str) -> DataFrame:
    """One row per position of several arrays; a shorter array gives nulls, and a row
    that lacks one of the arrays altogether gives no rows."""
    zipped = F.arrays_zip(*[F.col(path).alias(name) for name, path in arrays.items()])
    return df.select(*keep, F.inline(zipped).alias(*arrays))


def field_of_each(array: Column | str, field: str) -> Column:
    """One field of every element, as an array."""
    array = F.col(array) if isinstance(array, str) else array
    return array.getField(field)


def add_to_each(array: Column | str, **fields: Column) -> Column:
    """Set fields on every element of an array of structs."""
    def extend(element: Column) -> Column:
        for name, value in fields.items():
            element = element.withField(name, value)
        return element

    return F.transform(array, extend)


def json_array(text: Column | str, schema: str) -> Column:
    """JSON text to array; missing text gives an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    return F.from_json(F.coalesce(text, F.lit("[]")), schema)


def with_json_fields(df: DataFrame, column: str, spec: Mapping[str, tuple[str, str]],
                     under: str = "Fields") -> DataFrame:
    """Fields of one object inside a JSON column: target name to (field, type).

    The text is parsed once per row; a value that does not fit its type is null.
    """
    inner = StructType([StructField(field, StringType()) for field, _ in spec.values()])
    parsed = df.withColumn("_json", F.from_json(column, StructType([StructField(under, inner)])))
    root = F.col("_json").getField(under)
    return parsed.withColumns({
        name: root.getField(field) if kind == "string" else root.getField(field).try_cast(kind)
        for name, (field, kind) in spec.items()}).drop("_json")
