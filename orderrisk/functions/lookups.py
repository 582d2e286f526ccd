"""Small dictionary lookups as column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import literal


def from_dict(key: str, entries: dict, default) -> Column:
    """Value of the key column in ``entries``; ``default`` for null and unknown keys."""
    pairs = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in entries.items())
    return F.expr(f"coalesce(try_element_at(map({pairs}), {key}), {literal(default)})")


def email_country(domain: str) -> Column:
    """Country of a mail domain: known US domains and nulls first, then the first fitting suffix.

    Every listed suffix ends in a label that alone decides the country, so the last label is looked
    up once instead of trying the suffixes one by one.
    """
    us = ", ".join(literal(word) for word in fixed.US_EMAIL_DOMAINS)
    labels = {
        suffix.rsplit(".", 1)[1]: country for suffix, country in fixed.COUNTRY_BY_EMAIL_SUFFIX.items()
    }
    pairs = ", ".join(f"{literal(label)}, {literal(country)}" for label, country in labels.items())
    home = literal(fixed.DEFAULT_COUNTRY)
    return F.expr(
        f"case when {domain} is null or {domain} in ({us}) or instr({domain}, '.') = 0 then {home}"
        f" else coalesce(try_element_at(map({pairs}), substring_index({domain}, '.', -1)), {home}) end"
    )
