"""Data-quality rules over tables, and value search.

All row rules of a table are counted in a single scan of it, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import drop_matching

RESULT = ("rule_id", "rule_type", "group_id", "table_name", "column_name", "severity", "failing_rows")


@dataclass(frozen=True)
class Rule:
    """What must hold. ``columns`` are the checked ones, ``keys`` name a failing row."""
    rule_id: str
    table: str
    columns: tuple[str, ...]
    keys: tuple[str, ...] = ()
    group_id: str = ""
    severity: str = "HIGH"
    rule_type: str = ""

    def fails(self) -> Column:
        raise NotImplementedError

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Keys of the failing rows."""
        return tables[self.table].filter(self.fails()).select(*self.keys)


@dataclass(frozen=True)
class NotNull(Rule):
    rule_type: str = "Not Null"

    def fails(self) -> Column:
        return F.col(self.columns[0]).isNull()


@dataclass(frozen=True)
class FixedLength(Rule):
    length: int = 0
    rule_type: str = "Attribute length Check"

    def fails(self) -> Column:
        return F.coalesce(F.length(F.col(self.columns[0]).cast("string")) != self.length, F.lit(False))


@dataclass(frozen=True)
class InRange(Rule):
    low: str = "0"
    high: str = "0"
    rule_type: str = "Attribute With in Range Check"

    def fails(self) -> Column:
        value = F.col(self.columns[0])
        number = value.cast("string").try_cast("decimal(38,6)")
        inside = number.between(F.lit(self.low).cast("decimal(38,6)"), F.lit(self.high).cast("decimal(38,6)"))
        return value.isNotNull() & ~F.coalesce(inside, F.lit(False))


@dataclass(frozen=True)
class NeededWith(Rule):
    """The first column is needed wherever ``other`` is set."""
    other: str = ""
    rule_type: str = "Conditional Null Check"

    def fails(self) -> Column:
        return F.col(self.columns[0]).isNull() & F.col(self.other).isNotNull()


@dataclass(frozen=True)
class References(Rule):
    """The columns must occur in the parent's columns; a null reference is no failure."""
    parent: str = ""
    parent_columns: tuple[str, ...] = ()
    rule_type: str = "Referential Integrity Check"

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        child = tables[self.table].filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns]))
        parent = tables[self.parent].select(
            *[F.col(p).alias(c) for p, c in zip(self.parent_columns, self.columns, strict=True)])
        return drop_matching(child, parent, self.columns).select(*self.keys)


@dataclass(frozen=True)
class UniqueKey(Rule):
    """The columns must be unique among the active rows."""
    active_flag: str | None = "active_flg"
    rule_type: str = "Unique Key"

    def failing(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        rows = tables[self.table]
        if self.active_flag:
            rows = rows.filter(F.col(self.active_flag) == "Y")
        return rows.groupBy(*self.columns).count().filter("count > 1").select(*self.columns)


def _labels(rule: Rule) -> list[Column]:
    values = (rule.rule_id, rule.rule_type, rule.group_id, rule.table, ",".join(rule.columns), rule.severity)
    return [F.lit(v).alias(n) for n, v in zip(RESULT, values)]


def run_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its number of failures (zero included)."""
    results = []
    row_rules: dict[str, list[Rule]] = {}
    for rule in rules:
        if isinstance(rule, (References, UniqueKey)):
            counted = rule.failing(tables).agg(F.count(F.lit(1)).alias("failing_rows"))
            results.append(counted.select(*_labels(rule), "failing_rows"))
        else:
            row_rules.setdefault(rule.table, []).append(rule)
    for table, group in row_rules.items():
        counts = tables[table].agg(*[F.count(F.when(r.fails(), 1)).alias(f"r{i}") for i, r in enumerate(group)])
        entries = F.array(*[F.struct(*_labels(r), F.col(f"r{i}").alias("failing_rows"))
                            for i, r in enumerate(group)])
        results.append(counts.select(F.inline(entries)))
    return reduce(lambda a, b: a.unionByName(b), results)


RULE_ROWS = ("rule_id string, rule_type string, group_id string, table_name string, columns array<string>, "
             "keys array<string>, severity string, parameters map<string, string>, active_flg string")
MOST_RULES = 10_000


class QualityStop(RuntimeError):
    """Rules of a severity that stops the load have failed."""


def rules_from_rows(rows: DataFrame) -> list[Rule]:
    """Rules kept as rows of RULE_ROWS. Rows that are not active are left out; an unknown kind is an error."""
    kinds = {cls.rule_type: cls for cls in (NotNull, FixedLength, InRange, NeededWith, References, UniqueKey)}
    found = rows.filter("active_flg = 'Y'").orderBy("rule_id", "table_name").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    rules = []
    for r in found:
        if r["rule_type"] not in kinds:
            raise ValueError(f"rule {r['rule_id']} has the unknown kind {r['rule_type']}")
        more: dict = dict(r["parameters"] or {})
        if "length" in more:
            more["length"] = int(more["length"])
        if "parent_columns" in more:
            more["parent_columns"] = tuple(more["parent_columns"].split(","))
        if more.get("active_flag") == "":
            more["active_flag"] = None
        rules.append(kinds[r["rule_type"]](r["rule_id"], r["table_name"], tuple(r["columns"]), tuple(r["keys"] or ()),
                                           r["group_id"] or "", r["severity"] or "HIGH", **more))
    return rules


def gate(results: DataFrame, stops: Sequence[str] = ("HIGH",)) -> DataFrame:
    """The results, or QualityStop where a rule of one of these severities has failures. There is a row per rule."""
    failed = results.filter((F.col("failing_rows") > 0) & F.col("severity").isin(*stops)).orderBy("rule_id").collect()
    if failed:
        raise QualityStop(", ".join(f"{r['rule_id']} on {r['table_name']}: {r['failing_rows']}" for r in failed))
    return results


def search_values(tables: Mapping[str, DataFrame], text: str) -> DataFrame:
    """Number of rows per text column that hold ``text`` (any case), where there are any.

    One scan per table counts all of its text columns.
    """
    found = []
    for name, df in tables.items():
        columns = [c for c, kind in df.dtypes if kind == "string" or kind.startswith(("varchar", "char"))]
        if not columns:
            continue
        hit = [F.count(F.when(F.contains(F.lower(F.col(c)), F.lit(text.lower())), 1)).alias(c) for c in columns]
        entries = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                                     F.col(c).alias("matching_rows")) for c in columns])
        found.append(df.agg(*hit).select(F.inline(entries)))
    result = reduce(lambda a, b: a.unionByName(b), found)
    return result.filter("matching_rows > 0").select(F.lit(text).alias("search_value"), "*")
