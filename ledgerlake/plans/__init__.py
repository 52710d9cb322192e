"""Named query plans: the catalog (``catalog.load_all``) and its SQL oracle."""

from .catalog import CATALOG, Query, load_all

__all__ = ["CATALOG", "Query", "load_all"]
