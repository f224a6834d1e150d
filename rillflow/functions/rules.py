"""Single-stage event rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition on one event.

    Conditions fold from left to right, so
    ``Rule("start").where(a).where(b).or_(c)`` means ``(a AND b) OR c``.
    """

    name: str
    condition: Column | None = None

    def where(self, condition: Column) -> Rule:
        if self.condition is None:
            return Rule(self.name, condition)
        return Rule(self.name, self.condition & condition)

    def or_(self, condition: Column) -> Rule:
        if self.condition is None:
            return Rule(self.name, condition)
        return Rule(self.name, self.condition | condition)

    def matching(self, df: DataFrame) -> DataFrame:
        """Rows that satisfy the rule; a rule without conditions takes every row."""
        return df if self.condition is None else df.where(self.condition)

    def matches(self, df: DataFrame) -> DataFrame:
        """One row per match: ``match`` maps the rule's name to the matched events."""
        event = F.struct(*[F.col(c) for c in df.columns])
        return self.matching(df).select(
            F.create_map(F.lit(self.name), F.array(event)).alias("match")
        )
