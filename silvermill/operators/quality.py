"""Quality gate: all row rules in one aggregate, key uniqueness in one grouped count."""

from __future__ import annotations

import functools
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

REPORT_SCHEMA = "rule string, columns string, severity string, value bigint, passed boolean"


class QualityError(ValueError):
    """One or more error rules failed; nothing was published."""


@dataclass(frozen=True)
class Rule:
    """A counter over the whole frame. It passes at zero, except ``not_empty``, which needs a row."""

    kind: str  # not_empty | not_null | not_blank | not_negative | unique | known
    columns: tuple[str, ...] = ()
    severity: str = "error"  # error | warn | info


def rules_for(
    required: Sequence[str] = (),
    not_blank: Sequence[str] = (),
    not_negative: Sequence[str] = (),
    unique: Sequence[str] = (),
    known: Sequence[str] = (),
    empty: str = "error",
) -> list[Rule]:
    """The usual gate: emptiness, required columns, metrics, publish key and lookup misses."""
    rules = [Rule("not_empty", (), empty)]
    rules += [Rule("not_null", (c,)) for c in required]
    rules += [Rule("not_blank", (c,)) for c in not_blank]
    if not_negative:
        rules.append(Rule("not_negative", tuple(not_negative)))
    if unique:
        rules.append(Rule("unique", tuple(unique)))
    return rules + [Rule("known", (c,), "info") for c in known]


def any_negative(columns: Sequence[str]) -> Column:
    """True where at least one column is below zero; nulls beside it do not hide it."""
    return functools.reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the number of key groups with more than one row. Null keys group together."""
    return df.groupBy(*keys).count().filter("count > 1").agg(F.count("*").alias("value"))


def _counter(rule: Rule) -> Column:
    if rule.kind == "not_empty":
        return F.count("*")
    if rule.kind in ("not_null", "known"):
        return F.count_if(F.col(rule.columns[0]).isNull())
    if rule.kind == "not_blank":
        return F.count_if(F.trim(rule.columns[0]) == "")
    if rule.kind == "not_negative":
        return F.count_if(any_negative(rule.columns))
    raise ValueError(f"unknown rule {rule.kind}")


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report with one row per rule: rule, columns, severity, value, passed."""
    row_rules = [r for r in rules if r.kind != "unique"]
    counted = df.agg(*[_counter(r).alias(f"_{i}") for i, r in enumerate(row_rules)])
    report = counted.select(
        F.inline(F.array(*[_line(r, F.col(f"_{i}")) for i, r in enumerate(row_rules)]))
    )
    for rule in rules:
        if rule.kind == "unique":
            groups = duplicate_groups(df, rule.columns)
            report = report.unionByName(groups.select(F.inline(F.array(_line(rule, F.col("value"))))))
    return report


def _line(rule: Rule, value: Column) -> Column:
    passed = value > 0 if rule.kind == "not_empty" else value == 0
    return F.struct(
        F.lit(rule.kind).alias("rule"),
        F.lit(",".join(rule.columns)).alias("columns"),
        F.lit(rule.severity).alias("severity"),
        value.alias("value"),
        passed.alias("passed"),
    )


@dataclass(frozen=True)
class Line:
    """One rule's result, as the report's rows have it."""

    rule: str
    columns: str
    severity: str
    value: int
    passed: bool


class Observed:
    """The row rules as metrics of a write, so that its rows need not be read for them.

    Uniqueness on ``publish_keys`` follows without a count where rows are unique on ``proven`` and the columns
    that only ``proven`` has are the same in all rows, which the write measures as well."""

    def __init__(self, rules: Sequence[Rule], proven: Sequence[str] = ()):
        self.rules = list(rules)
        self.row_rules = [r for r in rules if r.kind != "unique"]
        self.proven = set(proven)
        self.alone = sorted({c for r in rules if r.kind == "unique" for c in self.proven - set(r.columns)})
        self.observation = Observation()

    @property
    def metrics(self) -> list[Column]:
        counters = [_counter(r).alias(f"_{i}") for i, r in enumerate(self.row_rules)]
        for i, column in enumerate(self.alone):
            c = F.col(f"`{column}`")
            counters += [F.min(c).alias(f"_least_{i}"), F.max(c).alias(f"_most_{i}"), F.count_if(c.isNull()).alias(f"_null_{i}")]
        return [F.count("*").alias("_rows"), *counters]

    @property
    def rows(self) -> int:
        return self.observation.get["_rows"]

    def _unique(self, rule: Rule, found: dict) -> bool:
        """Whether what was measured shows that no key is repeated."""
        same = {
            c
            for i, c in enumerate(self.alone)
            if found[f"_null_{i}"] == found["_rows"] or found[f"_null_{i}"] == 0 and found[f"_least_{i}"] == found[f"_most_{i}"]
        }
        return bool(self.proven) and self.proven - set(rule.columns) <= same

    def lines(self, written: DataFrame) -> list[Line]:
        """The report, once ``written`` has been written: its rows are read only to count groups of keys that the
        measures leave open."""
        found = self.observation.get
        lines, at = [], 0
        for rule in self.rules:
            if rule.kind != "unique":
                value, at = found[f"_{at}"], at + 1
            else:
                value = 0 if self._unique(rule, found) else duplicate_groups(written, rule.columns).first()["value"]
            passed = value > 0 if rule.kind == "not_empty" else value == 0
            lines.append(Line(rule.kind, ",".join(rule.columns), rule.severity, value, passed))
        return lines


def enforce(report: DataFrame, table: str = "") -> int:
    """Log the report (one row per rule), raise if an error rule failed, return the row count."""
    return judge([Line(**row.asDict()) for row in report.collect()], table)


def judge(lines: Sequence[Line], table: str = "") -> int:
    rows = next((line.value for line in lines if line.rule == "not_empty"), 0)
    failed = []
    for line in lines:
        log.info("table=%s %s(%s)=%s passed=%s", table, line.rule, line.columns, line.value, line.passed)
        if line.passed:
            continue
        if line.severity == "error":
            failed.append(f"{line.rule}({line.columns})={line.value}")
        elif line.severity == "warn":
            log.warning("table=%s failed %s(%s)=%s", table, line.rule, line.columns, line.value)
    if failed:
        raise QualityError(f"{table}: " + "; ".join(failed))
    return rows
