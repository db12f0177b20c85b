"""Queries over the test tables and their reference SQL."""

import importlib


def load_all() -> None:
    """Import every module that registers queries."""
    for name in ("tables", "records", "scalars", "relational", "history", "planning", "streams", "stored"):
        importlib.import_module(f"workload.{name}")
