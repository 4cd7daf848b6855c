"""Rules that limit the rows a user sees, as one condition.

A regular rule holds for the users that have one of its roles, a base rule for all that have none of
them. Of the rules that hold, those with the same group key are alternatives, and all groups must
agree; a rule without a group key is a group of its own. Clauses are SQL conditions on the rows' columns.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    clause: str
    roles: frozenset[str]
    base: bool = False
    group: str | None = None

    def holds(self, roles: frozenset[str]) -> bool:
        return bool(self.roles & roles) != self.base


def condition(rules: Iterable[Rule], roles: Iterable[str]) -> Column:
    """What a row must meet to be seen by a user with these roles; a clause that is neither true nor
    false does not let it through. Without a rule that holds all rows are seen."""
    own = frozenset(roles)
    groups: dict[object, Column] = {}
    for number, rule in enumerate(rules):
        if rule.holds(own):
            key = ("own", number) if rule.group is None else ("group", rule.group)
            clause = F.coalesce(F.expr(f"({rule.clause})").cast("boolean"), F.lit(False))
            groups[key] = groups[key] | clause if key in groups else clause
    met = F.lit(True)
    for clause in groups.values():
        met = met & clause
    return met


def visible(df: DataFrame, rules: Iterable[Rule], roles: Iterable[str]) -> DataFrame:
    """The rows that a user with these roles may see; the condition reaches the scan."""
    return df.filter(condition(rules, roles))
