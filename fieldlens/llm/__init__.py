"""Operators for preparing large text corpora; nothing else in the package imports this one."""

from importlib import import_module

MODULES = ["sharding", "ann", "near_dedup", "language", "packing", "toxicity", "decontaminate", "license_scan", "url_rules", "quality", "simhash", "codes", "whitening"]


def registry() -> tuple[dict, dict]:
    """Queries and their SQL, from the modules of this subpackage."""
    queries, oracle = {}, {}
    for name in MODULES:
        module = import_module(f"fieldlens.llm.{name}")
        queries |= module.QUERIES
        oracle |= module.ORACLE
    return queries, oracle
