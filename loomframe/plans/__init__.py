"""Queries over the driver tables, one per operator."""

from __future__ import annotations

from importlib import import_module

from loomframe.plans.registry import ORACLES, QUERIES, Query

MODULES = ("text", "chats", "scores", "runs", "streams")


def all_queries() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        import_module(f"loomframe.plans.{module}")
    return dict(QUERIES), dict(ORACLES)
