"""Small helpers for writing SQL expressions."""

from __future__ import annotations

from collections.abc import Iterable


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values: Iterable[str]) -> str:
    return ", ".join(text(value) for value in values)


def name(column: str) -> str:
    """A quoted column name."""
    return f"`{column}`"


def names(columns: Iterable[str]) -> list[str]:
    return [name(column) for column in columns]
