"""Registered queries. Importing a family fills the registry."""

import importlib

from gridpanel.catalog import common

FAMILIES = ("tables", "relations", "series", "models", "known")


def _load() -> None:
    for name in FAMILIES:
        importlib.import_module(f"gridpanel.catalog.{name}")


def all_queries() -> dict:
    _load()
    return dict(common.QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(common.ORACLES)
