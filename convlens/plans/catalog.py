"""All registered queries and their SQL oracles."""

from __future__ import annotations

from convlens.plans import q_ingest  # noqa: F401  (registers queries)
from convlens.plans.registry import ORACLE, QUERIES

_LOADED = False


def _load() -> None:
    global _LOADED
    if _LOADED:
        return
    import importlib

    for mod in ("q_eda", "q_association", "q_features", "q_evaluation", "q_models", "q_stream"):
        try:
            importlib.import_module(f"convlens.plans.{mod}")
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != f"convlens.plans.{mod}":
                raise
    _LOADED = True


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load()
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
