"""Data-quality rules, report and quarantine (Q1-Q5)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    kind: str  # "not_null" | "in_set"
    values: tuple = ()

    def unexpected(self):
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "in_set":  # nulls are ignored, as in the expectation suite
            return c.isNotNull() & ~c.isin(list(self.values))
        raise ValueError(self.kind)


def expect_not_null(column: str) -> Rule:
    """Q1."""
    return Rule(f"expect_column_values_to_not_be_null({column})", column, "not_null")


def expect_in_set(column: str, values) -> Rule:
    """Q2."""
    return Rule(f"expect_column_values_to_be_in_set({column})", column, "in_set", tuple(values))


def validation_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules in one aggregate (one scan), then one row per rule (Q3)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, r in enumerate(rules):
        aggs.append(F.count_if(r.unexpected()).alias(f"_u{i}"))
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                              F.col("_n").alias("element_count"),
                              F.col(f"_u{i}").alias("unexpected_count"))
                     for i, r in enumerate(rules)])
    return (counts.select(F.inline(rows))
            .withColumn("success", F.col("unexpected_count") == 0))


def schema_checks(df: DataFrame, required_columns, min_rows: int = 1) -> DataFrame:
    """Column-exists checks (metadata only) and a row-count check (Q4)."""
    present = set(df.columns)
    rows = [F.struct(F.lit(f"column_exists({c})").alias("check"),
                     F.lit(c in present).alias("passed")) for c in required_columns]
    counted = df.agg(F.count(F.lit(1)).alias("_n"))
    rows.append(F.struct(F.lit(f"row_count>={min_rows}").alias("check"),
                         (F.col("_n") >= min_rows).alias("passed")))
    return counted.select(F.inline(F.array(*rows)))


def quarantine_split(df: DataFrame, checks: list[tuple[str, object]]):
    """Split rows into (good, bad); bad rows carry the first failing reason (Q5).

    ``checks`` is a list of ``(reason, failing_condition)``; a NULL condition
    counts as passing.  Both outputs come from one tagged projection, so a
    caller that writes both should persist the tagged frame first.
    """
    tagged = tag_quarantine(df, checks)
    good = tagged.filter(F.col("reason").isNull()).drop("reason")
    bad = tagged.filter(F.col("reason").isNotNull())
    return good, bad


def tag_quarantine(df: DataFrame, checks: list[tuple[str, object]]) -> DataFrame:
    """Add ``reason`` = first failing check's name, NULL when the row is good."""
    expr = None
    for reason, cond in checks:
        c = F.coalesce(cond, F.lit(False))
        expr = F.when(c, reason) if expr is None else expr.when(c, reason)
    return df.withColumn("reason", expr)
