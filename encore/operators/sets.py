"""Set and merge steps: key universe, except, anti join, snapshot merge, aligned unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_universe(frames: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Distinct keys found in any of ``frames`` (UNION then DISTINCT)."""
    keys = [key] if isinstance(key, str) else list(key)
    out = frames[0].select(*keys)
    for f in frames[1:]:
        out = out.unionByName(f.select(*keys))
    return out.distinct()


def set_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a EXCEPT b`` (distinct rows of ``a`` not in ``b``); planned as an anti join."""
    return a.subtract(b)


def anti_join(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key has no match in ``b``."""
    return a.join(b, on, "left_anti")


def snapshot_merge(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """New rows win; old rows are kept for keys absent from ``new``.  Rows with a NULL key
    are dropped from both sides first."""
    new = new.where(F.col(key).isNotNull())
    kept = old.where(F.col(key).isNotNull()).join(new.select(key), key, "left_anti")
    return kept.select(*new.columns).unionByName(new)


def union_aligned(frames: Sequence[DataFrame], columns: Sequence[tuple[str, str]],
                  fill: Mapping[int, Mapping[str, Column]] | None = None) -> DataFrame:
    """UNION ALL of ``frames`` projected onto ``columns`` ``[(name, type)]``.

    A column missing from a frame becomes a typed NULL (or ``fill[i][name]`` if given), so
    the branches line up by name and type instead of by position."""
    fill = fill or {}
    out = None
    for i, f in enumerate(frames):
        have = set(c.lower() for c in f.columns)
        if i in fill:
            f = f.withColumns({f"__fill_{k}": v for k, v in fill[i].items()})
        sel = []
        for name, typ in columns:
            if name in fill.get(i, {}):
                src = f"`__fill_{name}`"
            elif name.lower() in have:
                src = f"`{name}`"
            else:
                src = "NULL"
            sel.append(f"CAST({src} AS {typ}) AS `{name}`")
        part = f.selectExpr(*sel)       # one call per column instead of three
        out = part if out is None else out.unionByName(part)
    return out
