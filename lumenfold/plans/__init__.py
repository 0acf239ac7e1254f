"""Query definitions; load_all() imports the modules, and so registers their queries."""

from importlib import import_module

MODULES = ("tpch", "relational", "aggregates", "scalars", "files", "streams", "similarity")


def load_all() -> None:
    for name in MODULES:
        import_module(f"lumenfold.plans.{name}")
