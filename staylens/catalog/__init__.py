"""Every operator as a query on the benchmark tables, each with its plain-SQL twin."""

from importlib import import_module

MODULES = ("scalar_queries", "frame_queries", "star_queries", "io_queries", "stream_queries")


def load() -> None:
    """Import the query modules, which register themselves."""
    for module in MODULES:
        import_module(f"staylens.catalog.{module}")
