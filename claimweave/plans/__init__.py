"""Jobs (members, encounters, service lines) and the registered query catalogue."""

from claimweave.plans.registry import REGISTRY, Query, runner

__all__ = ["REGISTRY", "Query", "runner", "load_catalog"]


def load_catalog() -> dict[str, Query]:
    """Import every module that registers queries, then return the registry."""
    from claimweave.plans import catalog, extract_queries, storage_queries  # noqa: F401
    return REGISTRY
