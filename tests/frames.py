"""Helpers that several test modules share."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
