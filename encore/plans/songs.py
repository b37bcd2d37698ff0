"""Song dimension (J2) and song daily features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.dates import check_day, day_minus, release_time
from encore.functions.text import album_name, auth_company, product_types, singer_field
from encore.operators.joins import join_dim
from encore.operators.windows import trailing_windows, windows_from_state

# Column order of the song dimension (43 columns).
SONG_DIM_COLUMNS = [
    "nbr", "name", "source", "album", "prdct", "lang", "video_format", "dur", "singer1", "singer2",
    "singer1id", "singer2id", "mac_time", "post_time", "pinyin_fst", "pinyin", "sing_type", "ori_singer",
    "lyricist", "composer", "bpm_val", "star_level", "video_qlty", "video_mk", "video_ftur", "lyric_ftur",
    "img_qlty", "subtitles_type", "audio_fmt", "ori_sound_qlty", "ori_trk", "ori_trk_vol", "acc_ver",
    "acc_qlty", "acc_trk_vol", "acc_trk", "width", "height", "video_rsvl", "song_ver", "auth_co", "state",
    "prdct_type",
]

# Dimension columns carried into the feature table, in output order.
FEATURE_DIM_COLUMNS = ["name", "source", "album", "prdct", "lang", "video_format", "dur", "singer1",
                       "singer2", "singer1id", "singer2id", "mac_time"]
FEATURE_COUNT_COLUMNS = [
    "sing_cnt", "supp_cnt", "usr_cnt", "ordr_cnt",
    "rct_7_sing_cnt", "rct_7_supp_cnt", "rct_7_top_sing_cnt", "rct_7_top_supp_cnt", "rct_7_usr_cnt",
    "rct_7_ordr_cnt",
    "rct_30_sing_cnt", "rct_30_supp_cnt", "rct_30_top_sing_cnt", "rct_30_top_supp_cnt", "rct_30_usr_cnt",
    "rct_30_ordr_cnt",
]
SONG_FEATURE_COLUMNS = ["nbr"] + FEATURE_DIM_COLUMNS + FEATURE_COUNT_COLUMNS


def song_dim(raw: DataFrame) -> DataFrame:
    """Clean the raw song source into the 43-column dimension; rows with an empty id are dropped."""
    exprs = {
        "name": F.coalesce(F.col("name"), F.col("other_name")),
        "album": album_name("album"),
        "singer1": singer_field("singer_info", 0, "name"),
        "singer2": singer_field("singer_info", 1, "name"),
        "singer1id": singer_field("singer_info", 0, "id"),
        "singer2id": singer_field("singer_info", 1, "id"),
        "mac_time": F.lit(0),
        "post_time": release_time("post_time"),
        "auth_co": auth_company("auth_co"),
    }
    types = product_types("prdct_type")
    exprs["prdct_type"] = F.when(F.size(types) == 0, F.lit(None).cast("array<int>")).otherwise(types)
    cols = [exprs.get(c, F.col(c)).alias(c) for c in SONG_DIM_COLUMNS]
    return raw.where(F.col("nbr") != "").select(*cols)


def song_day_counts(plays: DataFrame, day: str, key: str = "song_id") -> DataFrame:
    """Per song on ``day``: plays, likes (always 0), distinct users, distinct orders.

    Two distinct counts in one ``groupBy`` would make Catalyst copy every row once per
    distinct column (``Expand``) and shuffle the copies; ``trailing_windows`` makes three
    keyed rows of each play, which are partially aggregated before the shuffle."""
    check_day(day)
    return trailing_windows(plays, day, key=key, spans=(), out_key="nbr").select(
        "nbr", "sing_cnt", F.lit(0).cast("bigint").alias("supp_cnt"), "usr_cnt", "ordr_cnt")


def _features(tw: DataFrame, songs: DataFrame, dim_max_rows: int | None) -> DataFrame:
    tw = tw.where(F.col("sing_cnt") > 0)
    zero = F.lit(0).cast("bigint")
    feats = tw.select(
        "nbr", "sing_cnt", zero.alias("supp_cnt"), "usr_cnt", "ordr_cnt",
        "rct_7_sing_cnt", zero.alias("rct_7_supp_cnt"), "rct_7_top_sing_cnt", zero.alias("rct_7_top_supp_cnt"),
        "rct_7_usr_cnt", "rct_7_ordr_cnt",
        "rct_30_sing_cnt", zero.alias("rct_30_supp_cnt"), "rct_30_top_sing_cnt",
        zero.alias("rct_30_top_supp_cnt"), "rct_30_usr_cnt", "rct_30_ordr_cnt")
    dim = songs.select("nbr", *FEATURE_DIM_COLUMNS)
    return join_dim(feats, dim, "nbr", "inner", max_rows=dim_max_rows).select(*SONG_FEATURE_COLUMNS)


def song_features(plays: DataFrame, songs: DataFrame, day: str, key: str = "song_id",
                  dim_max_rows: int | None = None) -> DataFrame:
    """Songs played on ``day`` that exist in the dimension, with day / 7-day / 30-day
    counts and best days (29 columns).  Likes are not logged and stay 0.

    "7 days" is ``[day-7, day]`` and "30 days" ``[day-30, day]``; best days come from the
    days before ``day`` (``[day-7, day-1]`` and ``[day-30, day-1]``), 0 when none.
    """
    return _features(trailing_windows(plays, day, key=key, out_key="nbr"), songs, dim_max_rows)


def song_features_from_state(state: DataFrame, songs: DataFrame, day: str,
                             dim_max_rows: int | None = None) -> DataFrame:
    """``song_features`` from a kept window state (see ``operators.windows.advance_window_state``)."""
    return _features(windows_from_state(state, day, out_key="nbr"), songs, dim_max_rows)


def features_from_windows(windows: DataFrame, songs: DataFrame, dim_max_rows: int | None = None) -> DataFrame:
    """``song_features`` from any form of the trailing windows (key column ``nbr``)."""
    return _features(windows, songs, dim_max_rows)


def history_best_day(plays: DataFrame, day: str, key: str = "song_id") -> DataFrame:
    """Best single-day play count per song in ``[day-7, day-1]`` and ``[day-30, day-1]``
    (likes are not logged: 0).  Songs with no play in ``[day-30, day-1]`` are absent."""
    check_day(day)
    lo7, lo30, prev = day_minus(day, 7), day_minus(day, 30), day_minus(day, 1)
    daily = (plays.where(F.col("data_dt").between(lo30, prev))
                  .groupBy(F.col(key).alias("nbr"), "data_dt").agg(F.count(F.lit(1)).alias("n")))
    zero = F.lit(0).cast("bigint")
    return daily.groupBy("nbr").agg(
        F.max(F.when(F.col("data_dt") >= lo7, F.col("n")).otherwise(0)).cast("bigint").alias("rct_7_top_sing_cnt"),
        zero.alias("rct_7_top_supp_cnt"),
        F.max("n").alias("rct_30_top_sing_cnt"),
        zero.alias("rct_30_top_supp_cnt"))
