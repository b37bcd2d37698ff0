"""All registered queries (``queries()``) and their DuckDB checks (``oracle_sql()``).

Each query reads the driver tables (through the stand-ins) and runs one operator or job of
the library over them; the matching SQL computes the same result independently in DuckDB.
"""

from __future__ import annotations

from encore.registry.common import DAY, Registry


def build() -> Registry:
    from encore.registry import dims, io, ops, songs, warehouse

    reg = Registry()
    for mod in (songs, dims, ops, io, warehouse):
        reg.merge(mod.R)
    return reg


__all__ = ["DAY", "build"]
