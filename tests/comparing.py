"""Order-insensitive comparison of results."""

from __future__ import annotations

from decimal import Decimal


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def bag(df, columns=None):
    columns = sorted(columns or df.columns)
    return sorted([plain(row[c]) for c in columns] for row in df.select(*columns).collect())
