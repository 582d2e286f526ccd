"""SQL text of literals, for expressions that are built from tables of words."""

from __future__ import annotations


def literal(value) -> str:
    """A constant as SQL text."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def name(column: str) -> str:
    """A column name as SQL text."""
    return f"`{column}`"


def rows(fields: list[dict[str, str]]) -> str:
    """An ``inline`` expression: one output row per dict of column name to SQL text."""
    structs = [
        "struct(" + ", ".join(f"{sql} as {name(column)}" for column, sql in row.items()) + ")"
        for row in fields
    ]
    return f"inline(array({', '.join(structs)}))"
