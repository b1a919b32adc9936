"""Row rules (F1-F8, F16) and the rows each rule removes.

A rule is a named boolean ``Column``; a row passes when the predicate is
TRUE, so a null comparison removes the row exactly like ``filter`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics import fixed

Rule = tuple[str, Column]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def catalogue_rules(
    installs: str = "Installs",
    min_installs: str = "Minimum Installs",
    rating_count: str = "Rating Count",
    released: str = "Released",
    updated: str = "Last Updated",
    size: str = "Size",
) -> list[Rule]:
    """F1-F4 over typed catalogue columns, in their original order."""
    return [
        ("installs_at_least_minimum", _c(installs) >= _c(min_installs)),
        ("rating_count_at_most_installs", _c(rating_count) <= _c(installs)),
        ("updated_not_before_release", _c(updated) >= _c(released)),
        ("size_not_zero", _c(size) != F.lit(fixed.SIZE_ZERO)),
    ]


def enforce_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep rows passing every rule (Catalyst folds the filters into one)."""
    for _, pred in rules:
        df = df.where(pred)
    return df


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows before and after each rule, applied in order: one aggregation.

    A row is lost at rule i when it passed rules 1..i-1 and rule i is not
    TRUE for it.  Result: (step, rule, rows_before, rows_lost, rows_after).
    """
    passed = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("r0")]
    for i, (_, pred) in enumerate(rules, start=1):
        passed = passed & F.coalesce(pred, F.lit(False))
        aggs.append(F.count_if(passed).alias(f"r{i}"))
    counts = df.agg(*aggs)
    steps = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(name).alias("rule"),
            F.col(f"r{i - 1}").alias("rows_before"),
            (F.col(f"r{i - 1}") - F.col(f"r{i}")).alias("rows_lost"),
            F.col(f"r{i}").alias("rows_after"),
        )
        for i, (name, _) in enumerate(rules, start=1)
    ]
    return counts.select(F.inline(F.array(*steps)))


def require_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """drop rows where any of ``columns`` is null."""
    for c in columns:
        df = df.where(_c(c).isNotNull())
    return df
