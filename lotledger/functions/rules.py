"""Declarative field rules: an ordered list of Column functions per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Rule = Callable[[Column], Column]


def apply_rules(df: DataFrame, rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """Fold every rule list over its column; columns without rules pass through."""
    return df.select(
        *[reduce(lambda c, rule: rule(c), rules.get(name, ()), F.col(name)).alias(name) for name in df.columns]
    )
