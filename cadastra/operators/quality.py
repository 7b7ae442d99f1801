"""Data-quality rules: a report of failures, a gate, and the rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_RULES = ("not_null", "accepted_values", "accepted_range")


@dataclass(frozen=True)
class Rule:
    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    where: str | None = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(column: str, severity: str = "error") -> Rule:
    return Rule("not_null", (column,), severity)


def unique(*columns: str, severity: str = "error") -> Rule:
    kind = "unique" if len(columns) == 1 else "unique_combination"
    return Rule(kind, columns, severity)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Rule:
    return Rule("accepted_values", (column,), severity, values=tuple(values))


def accepted_range(
    column: str, low: float | None = None, high: float | None = None,
    where: str | None = None, severity: str = "error",
) -> Rule:
    return Rule("accepted_range", (column,), severity, low=low, high=high, where=where)


def relationship(column: str, parent: str, parent_column: str, severity: str = "error") -> Rule:
    return Rule("relationship", (column,), severity, parent=parent, parent_column=parent_column)


def violation(rule: Rule) -> Column:
    """Whether a row breaks a row rule (never NULL). NULL values break only ``not_null``."""
    col = F.col(rule.columns[0])
    if rule.kind == "not_null":
        bad = col.isNull()
    elif rule.kind == "accepted_values":
        bad = col.isNotNull() & ~col.isin(*rule.values)
    else:
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (col < rule.low)
        if rule.high is not None:
            bad = bad | (col > rule.high)
    if rule.where:
        bad = bad & F.expr(rule.where)
    return F.coalesce(bad, F.lit(False))


def _line(rule: Rule, failures: Column) -> Column:
    return F.struct(
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.label).alias("column"),
        F.lit(rule.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def report(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per rule with its number of failures.

    All row rules share one scan and one aggregate. Uniqueness counts repeated keys, a
    relationship counts child rows without a parent; both fold to distinct keys before they
    shuffle.
    """
    parents = parents or {}
    lines: list[DataFrame] = []
    per_row = [r for r in rules if r.kind in ROW_RULES]
    if per_row:
        counts = df.agg(*[F.count_if(violation(r)).alias(f"f{i}") for i, r in enumerate(per_row)])
        lines.append(
            counts.select(
                F.inline(F.array(*[_line(r, F.col(f"f{i}")) for i, r in enumerate(per_row)]))
            )
        )
    for rule in rules:
        if rule.kind in ROW_RULES:
            continue
        keys = [F.col(c) for c in rule.columns]
        # Equal combinations count even if a part is NULL; a single NULL is not a value.
        known = F.lit(True) if len(keys) > 1 else keys[0].isNotNull()
        folded = df.filter(known).groupBy(*rule.columns).agg(F.count("*").alias("n"))
        if rule.kind == "relationship":
            child = rule.columns[0]
            parent = parents[rule.parent].select(F.col(rule.parent_column).alias(child)).distinct()
            failed = folded.join(parent, child, "left_anti").agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("f")
            )
        else:
            failed = folded.filter("n > 1").agg(F.count("*").alias("f"))
        lines.append(failed.select(F.inline(F.array(_line(rule, F.col("f"))))))
    return reduce(lambda a, b: a.unionByName(b), lines)


def gate(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The report; raises if an error-level rule has failures (the report has a row per rule)."""
    result = report(df, rules, parents)
    broken = result.filter("severity = 'error' and failures > 0").collect()
    if broken:
        raise ValueError(
            "; ".join(f"{r['rule']}({r['column']}): {r['failures']}" for r in broken)
        )
    return result


def split_rejected(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all error-level row rules, and the others with the rules they break."""
    errors = [r for r in rules if r.kind in ROW_RULES and r.severity == "error"]
    names = F.filter(
        F.array(
            *[F.when(violation(r), F.lit(f"{r.kind}({r.label})")) for r in errors]
        ),
        lambda n: n.isNotNull(),
    )
    marked = df.withColumn("rejected_by", names)
    clean = marked.filter(F.size("rejected_by") == 0).drop("rejected_by")
    return clean, marked.filter(F.size("rejected_by") > 0)
