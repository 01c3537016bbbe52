"""The subpackage's queries and their SQL, gathered for the driver's contract."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("decontam", "exact_dedup", "html_main", "jaccard", "langid", "mixing", "sharding", "substring", "toxicity", "url_filter")


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in import_module(f"{__package__}.{m}").QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in _MODULES for k, s in import_module(f"{__package__}.{m}").ORACLE.items()}
