"""Ready-made queries over the driver tables, each with the SQL that must agree with it."""

from kinetable.plans.registry import ORACLES, QUERIES


def load_all() -> None:
    """Import every plan module, which fills the registries."""
    import importlib

    for name in MODULES:
        importlib.import_module(f"kinetable.plans.{name}")


MODULES: list[str] = ["timing", "vectors", "frames", "paths", "stats", "catalog", "sources"]

__all__ = ["ORACLES", "QUERIES", "load_all"]
