"""Influence scores for songs and singers (natural log; plays weigh 0.8, likes 0.2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's weights).
W_PLAY = 0.8
W_LIKE = 0.2
W_AVG = 0.63   # weight of the per-day average over the period
W_TOP = 0.37   # weight of the best single day in the period
SCALE = 10.0


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def score_1d(sing: Column | str, supp: Column | str) -> Column:
    """``10 * (0.63*0.8*ln(sing+1) + 0.63*0.2*ln(supp+1))^2``."""
    s, p = _c(sing), _c(supp)
    inner = F.log(s / 1 + 1) * W_AVG * W_PLAY + F.log(p / 1 + 1) * W_AVG * W_LIKE
    return F.pow(inner, 2) * SCALE


def score_period(n: int, sing: Column | str, top_sing: Column | str,
                 supp: Column | str, top_supp: Column | str) -> Column:
    """``10 * (0.8*(0.63*ln(sing/n+1) + 0.37*ln(top_sing+1)) + 0.2*(0.63*ln(supp/n+1) + 0.37*ln(top_supp+1)))^2``."""
    s, ts, p, tp = _c(sing), _c(top_sing), _c(supp), _c(top_supp)
    plays = F.log(s / n + 1) * W_AVG + F.log(ts + 1) * W_TOP
    likes = F.log(p / n + 1) * W_AVG + F.log(tp + 1) * W_TOP
    return F.pow(plays * W_PLAY + likes * W_LIKE, 2) * SCALE


def influence_columns(prefix_7: str = "rct_7_", prefix_30: str = "rct_30_") -> dict[str, Column]:
    """The three scores over the feature columns of the song/singer feature table."""
    return {
        "rsi_1d": score_1d("sing_cnt", "supp_cnt"),
        "rsi_7d": score_period(7, f"{prefix_7}sing_cnt", f"{prefix_7}top_sing_cnt",
                               f"{prefix_7}supp_cnt", f"{prefix_7}top_supp_cnt"),
        "rsi_30d": score_period(30, f"{prefix_30}sing_cnt", f"{prefix_30}top_sing_cnt",
                                f"{prefix_30}supp_cnt", f"{prefix_30}top_supp_cnt"),
    }
