"""Every query by name, with the SQL another engine must agree with."""

from .registry import ORACLE, QUERIES

from . import checks, cleaning, files, reports, search, streams, warehouse  # noqa: F401,E402  (registration)

__all__ = ["ORACLE", "QUERIES"]
