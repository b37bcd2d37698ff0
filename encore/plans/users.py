"""Active users (J9) and newly active users."""

from __future__ import annotations

import re
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.dates import check_day, day_minus, split_timestamp
from encore.operators.joins import LOOKUP_MAX_ROWS, broadcast_if_small
from encore.operators.sets import union_aligned
from encore.session import ensure_checkpoint_dir

# Sign-up channel codes, their labels, gender labels, default user type.
CHANNEL_WECHAT, CHANNEL_ALIPAY, CHANNEL_QQ, CHANNEL_APP = "1", "2", "3", "4"
CHANNEL_LABELS = {"1": "微信", "2": "支付宝", "3": "QQ", "4": "APP"}
CHANNEL_UNKNOWN = "未知"
GENDER_LABELS = {"0": "不明", "1": "男", "2": "女"}
GENDER_UNKNOWN = ""
DEFAULT_USER_TYPE = "2"

USER_COLUMNS = ["uid", "reg_mid", "reg_chnl", "ref_uid", "gdr", "birthday", "msisdn", "loc_id", "log_mde", "reg_dt",
                "reg_tm", "usr_exp", "score", "level", "usr_type", "is_cert", "is_stdnt"]
NEW_USER_COLUMNS = ["uid", "reg_chnl", "ref_uid", "gnr", "birthday", "msisdn", "reg_dt", "level"]


def _channel(df: DataFrame, code: str, id_col: str, usr_type: Column, has_log_mode: bool = True,
             has_score: bool = True) -> DataFrame:
    reg_dt, reg_tm = split_timestamp("reg_tm")
    return df.withColumns({
        "reg_chnl": F.lit(code), "ref_uid": F.col(id_col), "reg_dt": reg_dt, "reg_tm": reg_tm,
        "log_mde": F.col("log_mde") if has_log_mode else F.lit(None).cast("string"),
        "score": F.col("score") if has_score else F.lit(0), "usr_type": usr_type,
        "is_cert": F.lit(None).cast("string"), "is_stdnt": F.lit(None).cast("string")})


def channel_union(wx: DataFrame, ali: DataFrame, qq: DataFrame, app: DataFrame) -> DataFrame:
    """The four sign-up channels as one 17-column user table (UNION ALL by name; columns a
    channel lacks are typed NULLs, the APP channel has score 0)."""
    parts = [
        _channel(wx, CHANNEL_WECHAT, "wx_id", F.lit(DEFAULT_USER_TYPE)),
        _channel(ali, CHANNEL_ALIPAY, "aly_id", F.coalesce(F.col("usr_type"), F.lit(DEFAULT_USER_TYPE))),
        _channel(qq, CHANNEL_QQ, "qqid", F.lit(DEFAULT_USER_TYPE)),
        _channel(app, CHANNEL_APP, "app_id", F.lit(DEFAULT_USER_TYPE), has_log_mode=False, has_score=False),
    ]
    types = dict(parts[0].dtypes)
    types.update({"log_mde": "string", "is_cert": "string", "is_stdnt": "string"})
    return union_aligned(parts, [(c, types[c]) for c in USER_COLUMNS])


def with_profiles(seen: DataFrame, users: DataFrame, ids_max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """``seen`` with the profiles of its users.  While the distinct ids are at most
    ``ids_max_rows`` they are broadcast, and the user tables are cut down to them as they are
    scanned, before the join; beyond that both sides are joined by uid.  Same rows.

    ``seen`` is computed once, into the checkpoint folder: it is measured, cuts the users and
    is joined."""
    ensure_checkpoint_dir(seen.sparkSession)
    seen = seen.checkpoint(eager=True)
    ids = seen.select("uid").distinct()
    small = broadcast_if_small(ids, ids_max_rows)
    if small is not ids:
        users = users.join(small, "uid", "left_semi")
    return seen.join(users, "uid", "left")


def active_users(logins: DataFrame, users: DataFrame, day: str, ids_max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """Distinct users who logged in on ``day`` with their profile (NULLs when there is
    none; a user registered in two channels yields two rows)."""
    check_day(day)
    seen = logins.where(F.col("data_dt") == day).select("uid").distinct()
    return with_profiles(seen, users, ids_max_rows).select(*USER_COLUMNS)


def store_profiles(users: DataFrame, table: str, buckets: int) -> None:
    """Keep the user profiles as a table bucketed and sorted by uid, under the view ``table``.

    Each call writes a table of its own and then points the view at it, so readers have the old
    profiles or the new ones; the table before the last is dropped.  Take ``buckets`` so that a
    bucket fits in a task, and a multiple of the shuffle partitions."""
    spark = users.sparkSession
    stored = f"{table}_b{buckets}_{time.time_ns():x}"
    users.write.format("parquet").bucketBy(buckets, "uid").sortBy("uid").saveAsTable(stored)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {stored}")
    name = table.split(".")[-1].lower()
    database = table.split(".")[0] if "." in table else spark.catalog.currentDatabase()
    for old in sorted(t.name for t in spark.catalog.listTables(database) if re.fullmatch(rf"{re.escape(name)}_b\d+_[0-9a-f]+", t.name))[:-2]:
        spark.sql(f"DROP TABLE {database}.{old}")


def active_users_bucketed(logins: DataFrame, profiles: DataFrame, day: str) -> DataFrame:
    """``active_users`` against profiles that ``store_profiles`` keeps: the day's distinct ids are
    shuffled to the profiles' buckets, the profiles stay where they are, at any number of ids."""
    check_day(day)
    uid = profiles.schema["uid"].dataType
    seen = logins.where(F.col("data_dt") == day).select(F.col("uid").cast(uid).alias("uid")).distinct()
    return seen.join(profiles.hint("merge"), "uid", "left").select(*USER_COLUMNS)


def active_users_range(logins: DataFrame, users: DataFrame, start: str, end: str) -> DataFrame:
    """``active_users`` for every day of ``[start, end]`` at once, with ``data_dt``."""
    seen = logins.where(F.col("data_dt").between(check_day(start), check_day(end))).select("uid", "data_dt").distinct()
    return with_profiles(seen, users).select(*USER_COLUMNS, "data_dt")


def decode(c: Column | str, labels: dict[str, str], default: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in labels.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default))


def seen_once(active: DataFrame, day: str, days: int = 7) -> DataFrame:
    """Users with exactly one active row in ``[day-days, day]``."""
    lo = day_minus(day, days)
    return (active.where(F.col("data_dt").between(lo, day))
                  .groupBy("uid").agg(F.count(F.lit(1)).alias("c"))
                  .where(F.col("c") == 1).select("uid"))


def newly_active_users(active: DataFrame, day: str, days: int = 7) -> DataFrame:
    """Users active on ``day`` with no other active row in ``[day-days, day]``, channel and
    gender decoded to labels."""
    once = seen_once(active, day, days)
    today = active.where(F.col("data_dt") == check_day(day))
    j = once.join(today, "uid", "inner")
    return j.select("uid", decode("reg_chnl", CHANNEL_LABELS, CHANNEL_UNKNOWN).alias("reg_chnl"), "ref_uid",
                    decode("gdr", GENDER_LABELS, GENDER_UNKNOWN).alias("gnr"), "birthday", "msisdn", "reg_dt",
                    "level")
