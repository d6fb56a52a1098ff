"""Registered queries, composed from the operators and paired with SQL."""

from importlib import import_module

from gristmill.plans.registry import ORACLES, QUERIES

_MODULES = ("sampling_queries", "text_queries", "retrieval_queries", "sweep_queries",
            "tabular_queries", "flow_queries", "edge_queries", "file_queries")


def _load() -> None:
    for name in _MODULES:
        import_module(f"gristmill.plans.{name}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
