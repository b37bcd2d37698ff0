"""Joins with an explicit broadcast policy.

A side is broadcast only after its rows and bytes have been checked against a bound (summed
by all tasks, partial sums first); otherwise the join is left to the planner, where
AQE may still switch to a broadcast once the shuffle has measured the real size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lookups (provinces, cities, areas, stores) are bounded by geography, far below this.
LOOKUP_MAX_ROWS = 1_000_000
# All lookups of one plan together.
LOOKUP_MAX_BYTES = 128 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = LOOKUP_MAX_ROWS, max_bytes: int = LOOKUP_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` is within both bounds, else ``df`` unchanged."""
    return broadcast_all_if_small([df], max_rows, max_bytes)[0]


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes: text by its length, nested values as JSON, 8 bytes for all others."""
    sizes = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8)
        elif kind.startswith(("array", "map", "struct")):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8)
        else:
            sizes.append(F.lit(8))
    return reduce(lambda x, y: x + y, sizes, F.lit(0))


def broadcast_all_if_small(frames: list[DataFrame], max_rows: int = LOOKUP_MAX_ROWS,
                           max_bytes: int = LOOKUP_MAX_BYTES) -> list[DataFrame]:
    """``broadcast`` for those frames that have at most ``max_rows`` rows, smallest first, as
    long as they hold at most ``max_bytes`` together.  One partially aggregated job measures them all."""
    probes = [f.select(F.lit(i).alias("_i"), _row_bytes(f).alias("_b")) for i, f in enumerate(frames)]
    sizes = {r["_i"]: (r["b"], r["n"]) for r in reduce(lambda a, b: a.unionByName(b), probes)
             .groupBy("_i").agg(F.count(F.lit(1)).alias("n"), F.sum("_b").alias("b")).collect()}
    out, left = list(frames), max_bytes
    for size, rows, i in sorted((*sizes.get(i, (0, 0)), i) for i in range(len(frames))):
        if rows <= max_rows and size <= left:
            out[i], left = F.broadcast(frames[i]), left - size
    return out


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
             max_rows: int | None = None) -> DataFrame:
    """Fact-to-dimension join.  With ``max_rows`` the dimension is broadcast behind a
    size check; without it the planner (and AQE at run time) chooses."""
    if max_rows is not None:
        dim = broadcast_if_small(dim, max_rows)
    return fact.join(dim, on, how)


def left_chain(base: DataFrame, others: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """``base LEFT JOIN o1 USING (on) LEFT JOIN o2 ...`` - all on the same key, so the
    inputs, once hash-partitioned on it, join without further shuffles."""
    out = base
    for o in others:
        out = out.join(o, on, "left")
    return out
