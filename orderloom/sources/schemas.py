"""Schemas of sinks that grow: recorded, checked before a write, applied at a read."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StructField, StructType)

# each type may be read as any that follows it in its row
WIDER = ((ByteType(), ShortType(), IntegerType(), LongType()), (FloatType(), DoubleType()))


class SchemaConflict(ValueError):
    """A column has come with a type that the sink cannot take."""


def wider_type(old: DataType, new: DataType) -> DataType | None:
    """The type that holds both, or None."""
    if old == new:
        return old
    for row in WIDER:
        if old in row and new in row:
            return row[max(row.index(old), row.index(new))]
    if isinstance(old, DecimalType) and isinstance(new, DecimalType) and old.scale == new.scale:
        return old if old.precision >= new.precision else new
    return None


def evolved(known: StructType, coming: StructType) -> StructType:
    """``known`` with the new columns at its end and wider types where they came; every column may be null."""
    fields = {f.name: f for f in known.fields}
    for f in coming.fields:
        if f.name not in fields:
            fields[f.name] = f
            continue
        kind = wider_type(fields[f.name].dataType, f.dataType)
        if kind is None:
            raise SchemaConflict(
                f"{f.name} is {fields[f.name].dataType.simpleString()} and came as {f.dataType.simpleString()}")
        fields[f.name] = StructField(f.name, kind, True, f.metadata)
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in fields.values()])


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in order; missing ones are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


class RecordedSink:
    """Appended files below date or other partition folders, with the schema kept beside them.

    A write adds its new columns to the record before its files appear; older files give null for them. The record of
    a write that failed later only names columns that are null everywhere.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def recorded(self) -> StructType | None:
        """The newest record; records are numbered and never written again."""
        fs, folder = self._fs(f"{self.path}/_schemas")
        if not fs.exists(folder):
            return None
        newest = max(s.getPath().getName() for s in fs.listStatus(folder))
        source = fs.open(self._fs(f"{self.path}/_schemas/{newest}")[1])
        try:
            return StructType.fromJson(json.loads(bytes(source.readAllBytes()).decode()))
        finally:
            source.close()

    def admit(self, coming: StructType) -> StructType:
        """Check the columns of a write and record them; SchemaConflict where one does not fit."""
        known = self.recorded()
        schema = evolved(known, coming) if known is not None else evolved(StructType(), coming)
        if known == schema:
            return schema
        fs, folder = self._fs(f"{self.path}/_schemas")
        number = len(fs.listStatus(folder)) if fs.exists(folder) else 0
        # without overwriting: of two writers that both add columns the second fails and runs again
        out = fs.create(self._fs(f"{self.path}/_schemas/{number:010d}")[1], False)
        out.write(schema.json().encode())
        out.close()
        return schema

    def read(self) -> DataFrame:
        schema = self.recorded()
        if schema is None:
            raise ValueError(f"nothing recorded at {self.path}")
        return self.spark.read.schema(schema).parquet(self.path)
