"""The scoring rules as data: each is written once and drives every table that needs it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderrisk.functions import text


@dataclass(frozen=True)
class Rule:
    """A rule fires where its condition is true; a condition that is null does not fire."""

    name: str
    points: int
    condition: str

    @property
    def score(self) -> str:
        return f"case when {self.condition} then {self.points} else 0 end"

    @property
    def hits(self) -> str:
        return f"count_if({self.condition})"


_HIGH_AMOUNT = Rule("high_amount", 20, "order_amount >= 150")
_COUNTRY = Rule("country_mismatch", 25, "country_mismatch")
_VELOCITY = Rule("high_velocity", 20, "high_velocity")
_NEW_HIGH = Rule("new_customer_high_amount", 20, "is_new_customer and order_amount >= 100")
_LATE = Rule("late_night", 10, "order_hour between 1 and 5")
_IP = Rule("ip_mismatch", 25, "ip_mismatch")

MART_RULES = [
    _HIGH_AMOUNT,
    _COUNTRY,
    _VELOCITY,
    Rule("travel", 15, "product_category = 'Travel'"),
    _NEW_HIGH,
    _LATE,
    _IP,
    Rule("new_account", 30, "account_age_days < 30"),
]

VARIANT_RULES = [
    _HIGH_AMOUNT,
    _COUNTRY,
    _VELOCITY,
    Rule("gift_cards", 15, "product_category = 'gift_cards'"),
    _NEW_HIGH,
    _LATE,
    _IP,
    Rule("new_customer_crypto", 30, "is_new_customer and payment_method = 'crypto'"),
]


def total_score(rules: list[Rule]) -> Column:
    return F.expr(" + ".join(f"({rule.score})" for rule in rules))


def by_name(rules: list[Rule]) -> dict[str, Rule]:
    return {rule.name: rule for rule in rules}


def hits_as_rows(df: DataFrame, rules: list[Rule], labels: dict[str, str]) -> DataFrame:
    """(rule, hits) rows from one scan of ``df``."""
    named = by_name(rules)
    hits = df.selectExpr(*[f"{named[name].hits} as {name}" for name in labels])
    return hits.selectExpr(
        text.rows([{"rule": text.literal(label), "hits": name} for name, label in labels.items()])
    )


def rule_coverage(df: DataFrame, rules: list[Rule], labels: dict[str, str]) -> DataFrame:
    """Per rule: does it fire at least once in ``df``?"""
    return hits_as_rows(df, rules, labels).selectExpr("rule", "hits > 0 as fires")


def rule_points_long(df: DataFrame, rules: list[Rule], key: str = "order_id") -> DataFrame:
    """(order, rule, points): the score taken apart, row by row."""
    lines = [{"rule": text.literal(r.name), "points": r.score} for r in rules]
    return df.selectExpr(key, text.rows(lines))


def rule_attribution(df: DataFrame, rules: list[Rule], key: str = "order_id") -> DataFrame:
    """Points of each rule less its mean points: the exact Shapley value of an additive score.

    The attributions of an order add up to its score minus the mean score. The means are one row,
    computed once as a scalar subquery.
    """
    fields = ", ".join(
        f"{r.hits} * {r.points} / nullif(count(1), 0) as {r.name}" for r in rules
    )
    means = df.selectExpr(f"struct({fields}) as means")
    scored = df.selectExpr(key, *[f"{r.score} as {r.name}" for r in rules])
    lines = [
        {"rule": text.literal(r.name), "points": r.name, "attribution": f"{r.name} - _means.{r.name}"}
        for r in rules
    ]
    return scored.withColumn("_means", means.scalar()).selectExpr(key, text.rows(lines))
