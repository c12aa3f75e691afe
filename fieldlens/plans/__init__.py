"""Registered queries over the test tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ["q_standings", "q_plays", "q_grouping", "q_text", "q_news", "q_rules", "q_datasets", "q_sources"]


def all_queries() -> tuple[dict, dict]:
    for name in MODULES:
        import_module(f"fieldlens.plans.{name}")
    from fieldlens.plans.registry import ORACLE, QUERIES

    return QUERIES, ORACLE
