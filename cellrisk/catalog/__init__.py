"""Named queries by family, and the SQL that states the same results."""

from __future__ import annotations

import importlib

from cellrisk.catalog.registry import ORACLES, QUERIES, Query

_FAMILIES = ["features", "evaluation", "risk", "profiling", "monitoring", "spatial", "files", "learning", "streams", "pipelines"]


def _load() -> None:
    for name in _FAMILIES:
        importlib.import_module(f"cellrisk.catalog.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
