"""Registered queries: play-log scans, song windows, song features, influence ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions.dates import day_minus, day_minus_col
from encore.operators.joins import left_chain
from encore.operators.windows import advance_window_state, trailing_windows, window_state, windows_from_state
from encore.plans.influence import (singer_features, singer_influence, song_influence, stack_periods,
                                    top_influence, with_scores)
from encore.plans.songs import history_best_day, song_day_counts, song_features, song_features_from_state
from encore.registry.common import D1, D7, D30, DAY, S, Registry, sql_with
from encore.sources.scans import scan_day, scan_day_range, scan_table
from encore.sources.sinks import stamp_date

R = Registry()
PLAY_COLS = "song_id, mid, operate_type, uid, order_id, dur_time, data_dt"

# ---------------------------------------------------------------- scans and filters

R.add("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")(
    lambda spark, d: scan_table(spark, f"{d}/orders.parquet")
    .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))

R.add("scan_day", sql_with(["plays"], f"SELECT {PLAY_COLS} FROM plays WHERE data_dt = '{DAY}'"))(
    lambda spark, d: scan_day(S(spark, d, "plays"), DAY))

R.add("scan_day_range", sql_with(["plays"], f"SELECT {PLAY_COLS} FROM plays WHERE data_dt BETWEEN '{D7}' AND '{DAY}'"))(
    lambda spark, d: scan_day_range(S(spark, d, "plays"), D7, DAY))

R.add("filter_eq", sql_with(["plays"], f"SELECT {PLAY_COLS} FROM plays WHERE operate_type = 'click' AND mid = 3"))(
    lambda spark, d: S(spark, d, "plays").where((F.col("operate_type") == "click") & (F.col("mid") == 3)))

R.add("filter_range", sql_with(["plays"], f"""SELECT {PLAY_COLS} FROM plays
    WHERE '{D30}' <= data_dt AND data_dt <= '{DAY}' AND dur_time BETWEEN 10 AND 20"""))(
    lambda spark, d: S(spark, d, "plays").where(
        (F.col("data_dt") >= D30) & (F.col("data_dt") <= DAY) & F.col("dur_time").between(10, 20)))

R.add("distinct_keys", sql_with(["plays"], f"""SELECT DISTINCT uid, mid FROM plays
    WHERE data_dt BETWEEN '{D30}' AND '{DAY}'"""))(
    lambda spark, d: scan_day_range(S(spark, d, "plays"), D30, DAY).select("uid", "mid").distinct())

R.add("day_minus", sql_with(["plays"], """SELECT DISTINCT data_dt,
    strftime(strptime(data_dt, '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d') AS minus_1,
    strftime(strptime(data_dt, '%Y%m%d') - INTERVAL 7 DAY, '%Y%m%d') AS minus_7,
    strftime(strptime(data_dt, '%Y%m%d') - INTERVAL 30 DAY, '%Y%m%d') AS minus_30 FROM plays"""))(
    lambda spark, d: S(spark, d, "plays").select("data_dt").distinct().select(
        "data_dt", day_minus_col("data_dt", 1).alias("minus_1"), day_minus_col("data_dt", 7).alias("minus_7"),
        day_minus_col("data_dt", 30).alias("minus_30")))

R.add("const_columns", sql_with(["songs"], """SELECT nbr, 0 AS mac_time, 2 AS prdct_typ, '1' AS reg_chnl,
    1 AS coin_cnt, CAST(0 AS BIGINT) AS supp_cnt FROM songs"""))(
    lambda spark, d: S(spark, d, "songs").select(
        "nbr", F.lit(0).alias("mac_time"), F.lit(2).alias("prdct_typ"), F.lit("1").alias("reg_chnl"),
        F.lit(1).alias("coin_cnt"), F.lit(0).cast("bigint").alias("supp_cnt")))

# ---------------------------------------------------------------- song windows

SQL_DAY_COUNTS = f"""SELECT song_id AS nbr, count(*) AS sing_cnt, CAST(0 AS BIGINT) AS supp_cnt,
    count(DISTINCT uid) AS usr_cnt, count(DISTINCT order_id) AS ordr_cnt
    FROM plays WHERE data_dt = '{DAY}' GROUP BY song_id"""


def _range_counts(lo: str, prefix: str) -> str:
    return f"""SELECT song_id AS nbr, count(*) AS {prefix}sing_cnt, count(DISTINCT uid) AS {prefix}usr_cnt,
        count(DISTINCT order_id) AS {prefix}ordr_cnt
        FROM plays WHERE data_dt BETWEEN '{lo}' AND '{DAY}' GROUP BY song_id"""


SQL_BEST = f"""SELECT nbr, max(CASE WHEN data_dt BETWEEN '{D7}' AND '{D1}' THEN n ELSE 0 END) AS rct_7_top_sing_cnt,
        CAST(0 AS BIGINT) AS rct_7_top_supp_cnt, max(n) AS rct_30_top_sing_cnt, CAST(0 AS BIGINT) AS rct_30_top_supp_cnt
    FROM (SELECT song_id AS nbr, data_dt, count(*) AS n FROM plays
          WHERE data_dt BETWEEN '{D30}' AND '{D1}' GROUP BY song_id, data_dt) daily
    GROUP BY nbr"""

WINDOW_CTES = f"""a AS ({SQL_DAY_COUNTS}),
c AS ({_range_counts(D7, 'rct_7_')}),
dd AS ({_range_counts(D30, 'rct_30_')}),
e AS ({SQL_BEST})"""

R.add("agg_song_window", sql_with(["plays"], SQL_DAY_COUNTS))(
    lambda spark, d: song_day_counts(S(spark, d, "plays"), DAY))

R.add("history_best_day", sql_with(["plays"], SQL_BEST))(
    lambda spark, d: history_best_day(S(spark, d, "plays"), DAY))

R.add("trailing_windows", sql_with(["plays"], f""", {WINDOW_CTES}
    SELECT dd.nbr, coalesce(a.sing_cnt, 0) AS sing_cnt, coalesce(a.usr_cnt, 0) AS usr_cnt,
        coalesce(a.ordr_cnt, 0) AS ordr_cnt,
        coalesce(c.rct_7_sing_cnt, 0) AS rct_7_sing_cnt, coalesce(c.rct_7_usr_cnt, 0) AS rct_7_usr_cnt,
        coalesce(c.rct_7_ordr_cnt, 0) AS rct_7_ordr_cnt, coalesce(e.rct_7_top_sing_cnt, 0) AS rct_7_top_sing_cnt,
        dd.rct_30_sing_cnt, dd.rct_30_usr_cnt, dd.rct_30_ordr_cnt,
        coalesce(e.rct_30_top_sing_cnt, 0) AS rct_30_top_sing_cnt
    FROM dd LEFT JOIN a ON dd.nbr IS NOT DISTINCT FROM a.nbr
            LEFT JOIN c ON dd.nbr IS NOT DISTINCT FROM c.nbr
            LEFT JOIN e ON dd.nbr IS NOT DISTINCT FROM e.nbr"""))(
    lambda spark, d: trailing_windows(S(spark, d, "plays"), DAY, out_key="nbr"))



def _incremental_state(spark, d):
    """Yesterday's state built from its own window, then advanced by today's plays only."""
    plays = S(spark, d, "plays")
    yesterday = window_state(plays, day_minus(D1, 30), D1)
    return advance_window_state(yesterday, plays, DAY)


R.add("trailing_windows_incremental", R.oracle["trailing_windows"])(
    lambda spark, d: windows_from_state(_incremental_state(spark, d), DAY, out_key="nbr"))

R.add("join_inner", sql_with(["plays", "songs"], f""", a AS ({SQL_DAY_COUNTS})
    SELECT a.nbr, b.name, b.singer1, a.sing_cnt, a.usr_cnt, a.ordr_cnt FROM a JOIN songs b ON a.nbr = b.nbr"""))(
    lambda spark, d: song_day_counts(S(spark, d, "plays"), DAY)
    .join(S(spark, d, "songs"), "nbr", "inner").select("nbr", "name", "singer1", "sing_cnt", "usr_cnt", "ordr_cnt"))

R.add("null_default", sql_with(["plays", "songs"], f""", a AS ({SQL_DAY_COUNTS})
    SELECT b.nbr, b.name, coalesce(a.sing_cnt, 0) AS sing_cnt FROM songs b LEFT JOIN a ON a.nbr = b.nbr"""))(
    lambda spark, d: S(spark, d, "songs").join(song_day_counts(S(spark, d, "plays"), DAY), "nbr", "left")
    .select("nbr", "name", F.coalesce("sing_cnt", F.lit(0)).alias("sing_cnt")))

R.add("stamp_date", sql_with(["plays"], f"""SELECT '{DAY}' AS data_dt, * FROM ({SQL_DAY_COUNTS}) a"""))(
    lambda spark, d: stamp_date(song_day_counts(S(spark, d, "plays"), DAY), DAY))


def _left_chain(spark, d):
    plays = S(spark, d, "plays")

    def rng(lo: str, p: str):
        return (scan_day_range(plays, lo, DAY).groupBy(F.col("song_id").alias("nbr"))
                .agg(F.count(F.lit(1)).alias(f"{p}sing_cnt")))

    chained = left_chain(song_day_counts(plays, DAY).select("nbr", "sing_cnt"),
                         [rng(D7, "rct_7_"), rng(D30, "rct_30_"),
                          history_best_day(plays, DAY).select("nbr", "rct_7_top_sing_cnt", "rct_30_top_sing_cnt")],
                         "nbr")
    return chained.select("nbr", "sing_cnt", *[F.coalesce(c, F.lit(0)).alias(c) for c in (
        "rct_7_sing_cnt", "rct_30_sing_cnt", "rct_7_top_sing_cnt", "rct_30_top_sing_cnt")])


R.add("join_left_chain", sql_with(["plays"], f""", {WINDOW_CTES}
    SELECT a.nbr, a.sing_cnt, coalesce(c.rct_7_sing_cnt, 0) AS rct_7_sing_cnt,
        coalesce(dd.rct_30_sing_cnt, 0) AS rct_30_sing_cnt, coalesce(e.rct_7_top_sing_cnt, 0) AS rct_7_top_sing_cnt,
        coalesce(e.rct_30_top_sing_cnt, 0) AS rct_30_top_sing_cnt
    FROM a LEFT JOIN c ON a.nbr = c.nbr LEFT JOIN dd ON a.nbr = dd.nbr LEFT JOIN e ON a.nbr = e.nbr"""))(_left_chain)

# ---------------------------------------------------------------- song features

SQL_FEATURES = f"""SELECT a.nbr, b.name, b.source, b.album, b.prdct, b.lang, b.video_format, b.dur,
    b.singer1, b.singer2, b.singer1id, b.singer2id, b.mac_time,
    a.sing_cnt, a.supp_cnt, a.usr_cnt, a.ordr_cnt,
    coalesce(c.rct_7_sing_cnt, 0) AS rct_7_sing_cnt, CAST(0 AS BIGINT) AS rct_7_supp_cnt,
    coalesce(e.rct_7_top_sing_cnt, 0) AS rct_7_top_sing_cnt, CAST(0 AS BIGINT) AS rct_7_top_supp_cnt,
    coalesce(c.rct_7_usr_cnt, 0) AS rct_7_usr_cnt, coalesce(c.rct_7_ordr_cnt, 0) AS rct_7_ordr_cnt,
    coalesce(dd.rct_30_sing_cnt, 0) AS rct_30_sing_cnt, CAST(0 AS BIGINT) AS rct_30_supp_cnt,
    coalesce(e.rct_30_top_sing_cnt, 0) AS rct_30_top_sing_cnt, CAST(0 AS BIGINT) AS rct_30_top_supp_cnt,
    coalesce(dd.rct_30_usr_cnt, 0) AS rct_30_usr_cnt, coalesce(dd.rct_30_ordr_cnt, 0) AS rct_30_ordr_cnt
FROM a JOIN songs b ON a.nbr = b.nbr
    LEFT JOIN c ON a.nbr = c.nbr LEFT JOIN dd ON a.nbr = dd.nbr LEFT JOIN e ON a.nbr = e.nbr"""

FEATURE_CTES = f"{WINDOW_CTES},\nfeat AS ({SQL_FEATURES})"


def features(spark, d):
    return song_features(S(spark, d, "plays"), S(spark, d, "songs"), DAY)


R.add("song_features", sql_with(["plays", "songs"], f", {FEATURE_CTES} SELECT * FROM feat"))(features)

R.add("song_features_incremental", sql_with(["plays", "songs"], f", {FEATURE_CTES} SELECT * FROM feat"))(
    lambda spark, d: song_features_from_state(_incremental_state(spark, d), S(spark, d, "songs"), DAY))

# ---------------------------------------------------------------- influence


def _score_sql(src: str) -> str:
    def per(n: int, p: str) -> str:
        return (f"10 * pow((ln({p}sing_cnt / {n} + 1) * 0.63 + ln({p}top_sing_cnt + 1) * 0.37) * 0.8"
                f" + (ln({p}supp_cnt / {n} + 1) * 0.63 + ln({p}top_supp_cnt + 1) * 0.37) * 0.2, 2)")
    return (f"SELECT *, 10 * pow(ln(sing_cnt / 1 + 1) * 0.63 * 0.8 + ln(supp_cnt / 1 + 1) * 0.63 * 0.2, 2) AS rsi_1d, "
            f"{per(7, 'rct_7_')} AS rsi_7d, {per(30, 'rct_30_')} AS rsi_30d FROM {src}")


def _stack_sql(src: str, ids: str) -> str:
    return " UNION ALL ".join(f"SELECT '{p}' AS period, {ids}, rsi_{p}d AS rsi FROM {src}" for p in ("1", "7", "30"))


def _rank_sql(src: str, ids: list[str], where: str = "") -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ids)
    inner = (f"SELECT period, {', '.join(ids)}, rsi, row_number() OVER (PARTITION BY period "
             f"ORDER BY round(rsi, 9) DESC, {order}) AS rsi_rank FROM {src}")
    return f"SELECT period, {', '.join(ids)}, round(rsi, 6) AS rsi, rsi_rank FROM ({inner}) r {where}"


SINGER_SUMS = ["sing_cnt", "supp_cnt", "rct_7_sing_cnt", "rct_7_supp_cnt", "rct_7_top_sing_cnt",
               "rct_7_top_supp_cnt", "rct_30_sing_cnt", "rct_30_supp_cnt", "rct_30_top_sing_cnt", "rct_30_top_supp_cnt"]
SQL_SINGER = ("SELECT singer1id, singer1, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in SINGER_SUMS)
              + " FROM feat GROUP BY singer1id, singer1")

INFLUENCE_CTES = f"""{FEATURE_CTES},
scored AS ({_score_sql('feat')}),
stacked AS ({_stack_sql('scored', 'nbr, name')}),
singer AS ({SQL_SINGER}),
sscored AS ({_score_sql('singer')}),
sstacked AS ({_stack_sql('sscored', 'singer1id, singer1')})"""


def _r6(df):
    return df.withColumn("rsi", F.round("rsi", 6))


R.add("influence_score", sql_with(["plays", "songs"], f""", {INFLUENCE_CTES}
    SELECT nbr, name, round(rsi_1d, 6) AS rsi_1d, round(rsi_7d, 6) AS rsi_7d, round(rsi_30d, 6) AS rsi_30d FROM scored"""))(
    lambda spark, d: with_scores(features(spark, d)).select(
        "nbr", "name", *[F.round(c, 6).alias(c) for c in ("rsi_1d", "rsi_7d", "rsi_30d")]))

R.add("rank_influence", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} "
                                  + _rank_sql("stacked", ["nbr", "name"], "WHERE period = '1'")))(
    lambda spark, d: _r6(song_influence(features(spark, d), periods=("1",))))

R.add("song_influence", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} " + _rank_sql("stacked", ["nbr", "name"])))(
    lambda spark, d: _r6(song_influence(features(spark, d))))

R.add("agg_singer", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} SELECT * FROM singer"))(
    lambda spark, d: singer_features(features(spark, d)))

R.add("singer_influence", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} "
                                    + _rank_sql("sstacked", ["singer1id", "singer1"])))(
    lambda spark, d: _r6(singer_influence(features(spark, d))))

R.add("top_influence", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} "
                                 + _rank_sql("stacked", ["nbr", "name"], "WHERE rsi_rank <= 30")))(
    lambda spark, d: _r6(top_influence(features(spark, d))))

R.add("top_singer_influence", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} "
                                        + _rank_sql("sstacked", ["singer1id", "singer1"], "WHERE rsi_rank <= 30")))(
    lambda spark, d: _r6(top_influence(features(spark, d), ("singer1id", "singer1"), singer=True)))

R.add("stack_periods", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} SELECT period, nbr, name, round(rsi, 6) AS rsi FROM stacked"))(
    lambda spark, d: _r6(stack_periods(with_scores(features(spark, d)), ["nbr", "name"])))
