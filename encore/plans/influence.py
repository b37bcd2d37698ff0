"""Song (J4) and singer (J5) influence scores, their per-period ranking, and the top-n
extract for export (J14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.scores import influence_columns
from encore.operators.windows import global_row_number, top_n


# Period labels (strings) and the export size.
PERIODS = ("1", "7", "30")
TOP_EXPORT = 30
# Scores are ranked after rounding to this many decimals, then by id, so that ranks do
# not depend on the last bits of a floating-point log.
RANK_DIGITS = 9
SINGER_SUM_COLUMNS = [
    "sing_cnt", "supp_cnt", "rct_7_sing_cnt", "rct_7_supp_cnt", "rct_7_top_sing_cnt", "rct_7_top_supp_cnt",
    "rct_30_sing_cnt", "rct_30_supp_cnt", "rct_30_top_sing_cnt", "rct_30_top_supp_cnt",
]


def with_scores(features: DataFrame) -> DataFrame:
    """Add ``rsi_1d``, ``rsi_7d``, ``rsi_30d``."""
    return features.withColumns(influence_columns())


def stack_periods(scored: DataFrame, id_cols: Sequence[str], periods: Sequence[str] = PERIODS) -> DataFrame:
    """One row per (period, id) with the period's score (unpivot, no self-union)."""
    if not set(periods) <= set(PERIODS):
        raise ValueError(f"periods must be among {PERIODS}")
    args = ", ".join(f"'{p}', rsi_{p}d" for p in periods)
    return (scored.selectExpr(f"stack({len(periods)}, {args}) AS (period, rsi)", *[f"`{c}`" for c in id_cols])
                  .select("period", *id_cols, "rsi"))


def rank_order(id_cols: Sequence[str]) -> list[Column]:
    """Score (rounded) descending, then the ids ascending (NULLs first): a total order."""
    return [F.round("rsi", RANK_DIGITS).desc()] + [F.col(c).asc_nulls_first() for c in id_cols]


def rank_periods(stacked: DataFrame, id_cols: Sequence[str], name: str = "rsi_rank") -> DataFrame:
    """Full ranking inside each period, spread over many tasks (see ``global_row_number``)."""
    return global_row_number(stacked, ["period"], rank_order(id_cols), name=name)


def song_influence(features: DataFrame, periods: Sequence[str] = PERIODS) -> DataFrame:
    """``period, nbr, name, rsi, rsi_rank`` for every song of the day's feature table."""
    stacked = stack_periods(with_scores(features), ["nbr", "name"], periods)
    return rank_periods(stacked, ["nbr"]).select("period", "nbr", "name", "rsi", "rsi_rank")


def singer_features(features: DataFrame) -> DataFrame:
    """Sum the song features per first singer (id, name); the second singer is ignored.
    Partial aggregation keeps a blank/unknown singer holding many songs cheap."""
    return features.groupBy("singer1id", "singer1").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in SINGER_SUM_COLUMNS])


def singer_influence(features: DataFrame, periods: Sequence[str] = PERIODS) -> DataFrame:
    """``period, singer1id, singer1, rsi, rsi_rank`` per first singer."""
    stacked = stack_periods(with_scores(singer_features(features)), ["singer1id", "singer1"], periods)
    return rank_periods(stacked, ["singer1id", "singer1"]).select("period", "singer1id", "singer1", "rsi", "rsi_rank")


def top_influence(features: DataFrame, id_cols: Sequence[str] = ("nbr", "name"), n: int = TOP_EXPORT,
                  singer: bool = False) -> DataFrame:
    """Top ``n`` per period without ranking everything: the window is planned as
    ``WindowGroupLimit``, so each task forwards at most ``n`` rows per period."""
    scored = with_scores(singer_features(features) if singer else features)
    stacked = stack_periods(scored, list(id_cols))
    out = top_n(stacked, ["period"], rank_order(id_cols), n, name="rsi_rank")
    return out.select("period", *id_cols, "rsi", "rsi_rank")
