"""Registered queries by theme."""

from __future__ import annotations

from importlib import import_module

THEMES = ["rows", "columns", "regression", "classification", "text", "machines", "stored"]


def all_queries():
    from millrace.queries.common import Registry

    merged = Registry()
    for theme in THEMES:
        merged.merge(import_module(f"millrace.queries.{theme}").registry)
    return merged
