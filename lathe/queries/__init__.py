"""Registered queries, one module per operator group."""

import importlib
import pkgutil

from .registry import ENTRIES


def load():
    """All entries; importing the modules registers them."""
    for m in pkgutil.iter_modules(__path__):
        if m.name != "registry":
            importlib.import_module(f"{__name__}.{m.name}")
    return ENTRIES
