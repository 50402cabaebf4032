"""All queries of the reference's operators, family by family."""

from __future__ import annotations

from vellum.plans import closure, corpora, depths, fragments, layouts, nested, older, registry, statutes  # noqa: F401


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
