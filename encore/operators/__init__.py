"""Reusable relational operators."""

from encore.operators.batches import map_in_batches, register_udfs
from encore.operators.joins import broadcast_if_small, join_dim, left_chain
from encore.operators.sets import anti_join, key_universe, set_except, snapshot_merge, union_aligned
from encore.operators.windows import global_row_number, top1_by, top_n, trailing_windows

__all__ = [
    "anti_join", "broadcast_if_small", "global_row_number", "join_dim", "key_universe", "left_chain",
    "map_in_batches", "register_udfs", "set_except", "snapshot_merge", "top1_by", "top_n",
    "trailing_windows", "union_aligned",
]
