"""Operators bound to the test tables, each beside the SQL that checks it."""

from __future__ import annotations

from importlib import import_module

MODULES = ["relational", "statements", "reports", "learning", "storage", "live"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(import_module(f"slowtide.plans.{name}"), attribute))
    return out


def all_queries() -> dict:
    return _merged("QUERIES")


def all_checks() -> dict:
    return _merged("CHECKS")
