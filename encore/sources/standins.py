"""Stand-in source tables built from the driver's parquet tables.

The reference ships no data, so each of its source tables is rebuilt as one SELECT over
the driver tables.  Every block is plain SQL that runs unchanged in Spark SQL and in
DuckDB; table names are placeholders (``{events}``) filled with ``parquet.`path``` for
Spark and with the registered view name for DuckDB.  This keeps the *inputs* of a Spark
query and of its independent SQL check identical by construction.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import scratch_path

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Day of an event: two events in three are moved back 12 or 24 days, so that the log
# reaches past the lower end of the 30-day window and every bound has rows beyond it.
_EVENT_DAY = "replace(CAST(CAST(ts AS DATE) - CAST(event_id % 3 * 12 AS INT) AS STRING), '-', '')"
# Machine of an event: ten machines for every fifteen users, as many as there are suppliers.
_EVENT_MID = "CAST(floor(user_id / 15) AS BIGINT) * 10 + event_id % 10"

STANDINS: dict[str, str] = {}

# Play log: one row per play; props.k (0-99) and the user's group of 75 give the song.
STANDINS["plays"] = f"""
SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) + 100 * CAST(floor(user_id / 75) AS BIGINT) AS song_id,
       {_EVENT_MID} AS mid, event_type AS operate_type, user_id AS uid,
       CAST(floor(event_id / 3) AS BIGINT) AS order_id, value AS dur_time,
       {_EVENT_DAY} AS data_dt
FROM {{events}}
"""

# Song dimension (the columns the feature job reads).
STANDINS["songs"] = """
SELECT p_partkey AS nbr, p_name AS name, 'catalog' AS source, p_type AS album, p_brand AS prdct,
       p_type AS lang, 'mv' AS video_format, p_size AS dur,
       p_brand AS singer1, CASE WHEN p_partkey % 2 = 0 THEN concat(p_brand, '-duet') END AS singer2,
       p_brand AS singer1id, CASE WHEN p_partkey % 2 = 0 THEN concat(p_brand, '-d') END AS singer2id,
       0 AS mac_time
FROM {part}
"""

# Raw song source with JSON / bracket / epoch / list text columns (good, missing, malformed).
STANDINS["songs_raw"] = """
SELECT CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS nbr,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_name END AS name,
       concat(p_name, ' (alt)') AS other_name, 'catalog' AS source,
       CASE WHEN p_partkey % 3 = 0 THEN concat('专辑《', p_name, '》')
            WHEN p_partkey % 3 = 1 AND p_partkey % 2 = 0 THEN concat('[{"name":"', p_brand, '"}]')
            ELSE p_name END AS album,
       p_brand AS prdct, p_type AS lang, 'mv' AS video_format, CAST(p_size AS STRING) AS dur,
       CASE WHEN p_partkey % 4 = 0 THEN 'bad'
            WHEN p_partkey % 4 = 1 THEN concat('[{"name":"', p_brand, '","id":"', CAST(p_size AS STRING),
                                               '"},{"name":"', p_type, '","id":"', CAST(p_partkey AS STRING), '"}]')
            WHEN p_partkey % 4 = 2 THEN concat('[{"name":"', p_brand, '"}]')
            ELSE concat('[{"name":"', p_brand, '","id":"', CAST(p_size AS STRING), '"}]') END AS singer_info,
       CASE WHEN p_partkey % 2 = 0 THEN '2020-01-02 03:04:05'
            WHEN p_partkey % 3 = 0 THEN '1577145600000'
            WHEN p_partkey % 5 = 0 THEN '2021-12-31 23:59:58 extra' ELSE 'x' END AS post_time,
       substr(p_name, 1, 1) AS pinyin_fst, p_name AS pinyin, CAST(p_size % 3 AS STRING) AS sing_type,
       p_brand AS ori_singer, p_brand AS lyricist, p_brand AS composer, CAST(p_size AS STRING) AS bpm_val,
       CAST(p_size % 5 AS STRING) AS star_level, 'hd' AS video_qlty, 'mk' AS video_mk, 'ft' AS video_ftur,
       'lf' AS lyric_ftur, 'iq' AS img_qlty, 'st' AS subtitles_type, 'mp4' AS audio_fmt, 'oq' AS ori_sound_qlty,
       'ot' AS ori_trk, '50' AS ori_trk_vol, 'v1' AS acc_ver, 'aq' AS acc_qlty, '50' AS acc_trk_vol,
       'at' AS acc_trk, '1920' AS width, '1080' AS height, '1080p' AS video_rsvl, 'v1' AS song_ver,
       CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN '{"id":"7"}'
            ELSE concat('{"name":"', p_type, '"}') END AS auth_co,
       CAST(p_partkey % 2 AS STRING) AS state,
       CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN '[]'
            ELSE concat('[', CAST(p_size AS STRING), '.0,9.0]') END AS prdct_type
FROM {part}
"""

# Raw client log lines: 6 '&'-separated fields, field 2 the event name, field 3 JSON.
# Every 11th line has a field too many and every 7th ends in empty fields; some payloads are
# cut off, no JSON at all, or a list; each optional key is missing from some.
STANDINS["client_log"] = f"""
SELECT concat(CAST(event_id AS STRING), '&', event_type, '&',
              CASE WHEN event_type = 'error' THEN 'OTHER_EVENT' ELSE 'SONG_PLAY' END, '&',
              CASE WHEN event_id % 13 = 0 THEN 'no payload'
                   WHEN event_id % 17 = 0 THEN concat('{{"songid":"', CAST(event_id AS STRING))
                   WHEN event_id % 19 = 0 THEN concat('[{{"songid":"', CAST(event_id AS STRING), '"}}]')
                   ELSE concat(
              '{{"songid":"', regexp_extract(props, '([0-9]+)', 1), '","mid":"', CAST({_EVENT_MID} AS STRING),
              '","optrate_type":"', event_type, '","uid":"', CAST(user_id AS STRING), '"',
              CASE WHEN event_id % 2 = 0 THEN ',"consume_type":"coin","pkg_id":"p 1"' ELSE '' END,
              CASE WHEN event_id % 3 > 0 THEN concat(',"play_time":"', replace(CAST(CAST(ts AS DATE) AS STRING), '-', ''), '"') ELSE '' END,
              CASE WHEN event_id % 5 > 0 THEN concat(',"session_id":"s', CAST(user_id AS STRING), '","songname":"n', event_type, '"') ELSE '' END,
              CASE WHEN event_id % 4 > 0 THEN concat(',"dur_time":"', CAST(event_id % 300 AS STRING), '"') ELSE '' END,
              CASE WHEN event_id % 6 > 0 THEN concat(',"order_id":"', CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING), '"') ELSE '' END,
              '}}') END,
              '&v1&end', CASE WHEN event_id % 11 = 0 THEN '&extra' WHEN event_id % 7 = 0 THEN '&&' ELSE '' END) AS line
FROM {{events}}
"""

# Machine system A (booth hardware).  Machines that other systems lack carry another id.
STANDINS["mac_a"] = """
SELECT CASE WHEN s_acctbal >= 1000 THEN s_suppkey ELSE s_suppkey + 1000000 END AS mid, concat('SRL', CAST(s_suppkey AS STRING)) AS srl_id,
       concat('HW', CAST(s_nationkey AS STRING)) AS hard_id,
       concat('w', CAST(s_suppkey % 3 AS STRING)) AS song_whse_ver, 'e1' AS exec_ver, 'u1' AS ui_ver,
       CASE WHEN s_suppkey % 2 = 0 THEN '1' END AS sts, '20240130101010' AS cur_login_tm,
       CASE WHEN s_suppkey % 3 = 0 THEN '1' END AS pay_sw, '1' AS is_online
FROM {supplier}
"""

# Machine system B (contracts, shares, scene).
STANDINS["mac_b"] = """
SELECT CASE WHEN s_acctbal < 5000 THEN s_suppkey ELSE s_suppkey + 2000000 END AS mid, 2 AS prdct_type, s_name AS mac_nm,
       CASE WHEN s_suppkey % 5 = 0 THEN '联营版' ELSE 'std' END AS pkg_nm,
       CAST(CASE WHEN s_suppkey % 3 = 0 THEN 100.0 WHEN s_suppkey % 3 = 1 THEN 40.0 END AS DOUBLE) AS inv_rate,
       CAST(CASE WHEN s_suppkey % 2 = 0 THEN 20.0 END AS DOUBLE) AS age_rate,
       CAST(10.0 AS DOUBLE) AS com_rate, CAST(CASE WHEN s_suppkey % 7 = 0 THEN 5.0 END AS DOUBLE) AS par_rate,
       '0' AS is_actv,
       CASE WHEN s_suppkey % 4 = 0 THEN '20200101' WHEN s_suppkey % 4 = 1 THEN '20200101120000' ELSE '2020' END AS actv_tm,
       CASE WHEN s_suppkey % 2 = 0 THEN '20210101' END AS order_tm,
       '0' AS had_mpay_func, n_regionkey AS scene_prvc_id, s_nationkey AS scene_cty_id,
       n_regionkey AS scene_area_id,
       CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE concat(n_name, ' road ') END AS scene_addr, s_name AS ground_nm
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# Machine address rows; text 'null' marks a missing province/city.
STANDINS["mac_addr"] = """
SELECT s_suppkey AS mid,
       CASE CAST(floor(s_suppkey / 12) AS BIGINT) % 3 WHEN 0 THEN r_name ELSE 'null' END AS prvc,
       CASE CAST(floor(s_suppkey / 12) AS BIGINT) % 3 WHEN 0 THEN n_name WHEN 1 THEN 'null' ELSE n_name END AS cty,
       CASE s_suppkey % 12
            WHEN 0 THEN concat('内蒙古自治区', n_name, '市')
            WHEN 1 THEN concat('宁夏回族自治区', n_name, '市某区')
            WHEN 2 THEN concat('西藏自治区', n_name, '市')
            WHEN 3 THEN concat('广西壮族自治区', n_name, '县')
            WHEN 4 THEN concat('新疆维吾尔自治区', n_name, '区', r_name, '区')
            WHEN 5 THEN concat('新疆维吾尔自治区', n_name, '州')
            WHEN 6 THEN concat('北京市', n_name, '区')
            WHEN 7 THEN concat('上海市', n_name)
            WHEN 8 THEN concat('重庆市', n_name, '县')
            WHEN 9 THEN concat('天津市', n_name, '区')
            WHEN 10 THEN concat(r_name, '省', n_name, '市')
            ELSE concat(r_name, '省', n_name, '白族自治州') END AS addr,
       concat(r_name, ' ', n_name) AS addr_fmt,
       CASE WHEN s_suppkey % 2 = 0 THEN '20230101' ELSE '20230101080000' END AS rev_tm,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE '2022' END AS sale_tm
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

STANDINS["prvc_lookup"] = "SELECT r_regionkey AS prvc_id, r_name AS prvc FROM {region}"
STANDINS["cty_lookup"] = "SELECT n_nationkey AS cty_id, n_name AS cty FROM {nation}"
STANDINS["area_lookup"] = "SELECT r_regionkey AS area_id, concat(r_name, ' area') AS area FROM {region}"
STANDINS["store_map"] = """
SELECT CASE WHEN s_acctbal >= 2000 THEN s_suppkey ELSE s_suppkey + 3000000 END AS mid, s_nationkey AS store_id
FROM {supplier}
"""
STANDINS["store"] = """
SELECT n_nationkey AS id, concat('store ', n_name) AS ground_nm, concat('tag', CAST(n_regionkey AS STRING)) AS tag_nm,
       'subtag' AS sub_tag_nm, 'catgy' AS sub_scene_catgy_nm, 'scene' AS sub_scene_nm,
       concat('brand', CAST(n_nationkey % 3 AS STRING)) AS brnd_nm, 'sub' AS sub_brnd_nm
FROM {nation}
"""

# Machines with agent and shares (machine-dimension columns used by the statistics job).
STANDINS["machines"] = """
SELECT s_suppkey AS mid, s_name AS mac_nm, r_name AS prvc, n_name AS cty,
       concat(r_name, '省', n_name, '市') AS addr, n_name AS agent_id,
       CASE WHEN s_suppkey % 5 = 0 THEN '联营版' ELSE 'std' END AS pkg_nm,
       CAST(CASE WHEN s_suppkey % 3 = 0 THEN 100.0 WHEN s_suppkey % 3 = 1 THEN 40.0 END AS DOUBLE) AS inv_rate,
       CAST(CASE WHEN s_suppkey % 2 = 0 THEN 20.0 END AS DOUBLE) AS age_rate,
       CASE WHEN s_suppkey % 4 = 0 THEN '20200101' WHEN s_suppkey % 4 = 1 THEN '20200101120000' ELSE '2020' END AS actv_tm
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

# Consumption source: one row per order line over the last 30 days; amounts may be negative.
_LINE_DAY = "replace(CAST(CAST('2024-01-30' AS DATE) - CAST(l_orderkey % 30 AS INT) AS STRING), '-', '')"
STANDINS["cnsm"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS id, CAST(NULL AS STRING) AS trd_id,
       o_custkey AS uid, l_suppkey AS mid, l_linestatus AS prdcd_type, l_returnflag AS pay_type,
       concat({_LINE_DAY}, '120000') AS act_tm, l_linenumber AS pkg_id,
       CASE WHEN l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END AS amt,
       l_orderkey AS ordr_id, CAST(NULL AS STRING) AS actv_nm, l_extendedprice AS pkg_prc,
       l_discount AS pkg_dscnt, CAST(NULL AS STRING) AS cpn_type, 1 + l_partkey % 4 AS ordr_type,
       {_LINE_DAY} AS data_dt
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

# Registered users, one sign-up channel per market segment.
STANDINS["users"] = """
SELECT c_custkey AS uid, CAST(floor(c_custkey / 15) AS BIGINT) AS reg_mid, c_name AS ref_uid,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '1' WHEN 'MACHINERY' THEN '2' WHEN 'FURNITURE' THEN '3' ELSE '4' END AS channel,
       CAST(c_nationkey % 4 AS STRING) AS gdr, '19900101' AS birthday,
       concat('138', CAST(c_custkey AS STRING)) AS msisdn, CAST(c_nationkey AS STRING) AS loc_id,
       c_mktsegment AS log_mde,
       CASE WHEN c_custkey % 3 = 0 THEN '20240130101112' ELSE '20240102030405' END AS reg_tm,
       CAST(c_custkey % 100 AS STRING) AS usr_exp, c_custkey % 50 AS score,
       CAST(c_nationkey % 5 AS STRING) AS level,
       CASE WHEN c_custkey % 2 = 0 THEN '1' END AS usr_type
FROM {customer}
"""

# Users seen per day; every login user stands for ten registered ones, so that "seen once
# in 8 days" keeps some of them.
STANDINS["logins"] = f"""
SELECT DISTINCT user_id * 10 + event_id % 10 AS uid, {_EVENT_DAY} AS data_dt FROM {{events}}
"""

# Location reports; about one in twenty is blank, and some positions are not in the lookup.
STANDINS["loc_reports"] = f"""
SELECT user_id AS uid, {_EVENT_MID} AS mid,
       CASE WHEN event_id % 10 = 7 AND user_id % 2 = 0 THEN '' ELSE CAST(33 - user_id % 4 AS STRING) END AS lat,
       CASE WHEN event_id % 10 = 7 AND user_id % 2 = 0 THEN '' ELSE CAST(120 + user_id % 8 AS STRING) END AS lng,
       {_EVENT_DAY} AS data_dt
FROM {{events}}
"""

# Location lookup keyed by (lat, lng) - unique per nation - with the address fields a
# geocoder would return.
STANDINS["loc_lookup"] = """
SELECT CAST(30 + n_nationkey % 4 AS STRING) AS x, CAST(120 + CAST(floor(n_nationkey / 4) AS BIGINT) AS STRING) AS y,
       concat(r_name, ' ', n_name, ' road 1') AS addr, r_name AS prvc, n_name AS cty,
       CAST(n_nationkey AS STRING) AS cty_cd, concat(n_name, ' district') AS district,
       CAST(100000 + n_nationkey AS STRING) AS ad_cd, concat(n_name, ' town') AS town_ship,
       CAST(200000 + n_nationkey AS STRING) AS town_cd,
       CASE WHEN n_nationkey % 2 = 0 THEN concat(n_name, ' park') END AS nb_nm,
       CASE WHEN n_nationkey % 2 = 0 THEN 'park' END AS nb_tp, '' AS bd_nm, '' AS bd_tp,
       concat(n_name, ' street') AS street, CAST(n_nationkey AS STRING) AS street_nb,
       concat(CAST(120 + CAST(floor(n_nationkey / 4) AS BIGINT) AS STRING), ',', CAST(30 + n_nationkey % 4 AS STRING)) AS street_loc,
       'north' AS street_drction, '10' AS street_dstance, CAST(NULL AS STRING) AS bus_info
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def tables_of(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(STANDINS[name])))


def standin_sql(name: str, spark_dir: str | None = None) -> str:
    """SQL text of a stand-in; with ``spark_dir`` the tables read parquet files directly."""
    sql = STANDINS[name]
    if spark_dir is None:
        return _PLACEHOLDER.sub(lambda m: m.group(1), sql)
    return _PLACEHOLDER.sub(lambda m: f"parquet.`{spark_dir.rstrip('/')}/{m.group(1)}.parquet`", sql)


# Stand-ins stored like the reference's day-partitioned source tables.
DAY_PARTITIONED = {"plays", "logins", "loc_reports", "cnsm"}
DAY_FILES = 2      # files per day: a large day is written by more than one task
# Their join or distinct has spread the rows over tasks already: each task writes its own part of
# every day, and the rows are not shuffled a second time.
SPREAD = {"cnsm", "logins"}
_STORED: dict[tuple[str, str, str], DataFrame] = {}
_LOCK = threading.Lock()


def standin_query(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in as a lazy Spark SQL query over the driver's parquet files."""
    return spark.sql(standin_sql(name, sf_dir))


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table, stored once per application as parquet under the shared
    checkpoint folder (day-partitioned where the source table is) and read back with its
    declared schema, so scans see a real table: partition pruning, pushed filters,
    plain columns."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        hit = _STORED.get(key)
        if hit is None:
            df = standin_query(spark, sf_dir, name)
            path = scratch_path(spark, f"standin-{name}")
            # Stored like a real table: many files (one per day in a day partition), so
            # scans get one task per file instead of one task for a single source file.
            parts = spark.sparkContext.defaultParallelism
            if name in DAY_PARTITIONED:
                if name not in SPREAD:
                    bucket = F.pmod(F.xxhash64(*[c for c in df.columns if c != "data_dt"]), F.lit(DAY_FILES))
                    df = df.repartition(F.col("data_dt"), bucket)
                writer = df.write.mode("overwrite").option("compression", "zstd").partitionBy("data_dt")
            else:
                writer = df.repartition(parts).write.mode("overwrite")
            writer.parquet(path)
            # One DataFrame per stored table: its file listing is done once and reused.
            hit = spark.read.schema(df.schema).parquet(path)
            _STORED[key] = hit
    return hit


def with_standins(names: list[str], body: str) -> str:
    """``WITH <stand-ins> <body>`` for the DuckDB check (tables are registered views)."""
    ctes = ",\n".join(f"{n} AS ({standin_sql(n)})" for n in names)
    return f"WITH {ctes}\n{body}"


def build_warehouse(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Lay the stand-ins out as the daily jobs' source tables under ``root`` (the folder
    names of ``encore.jobs``), so the job runner can be exercised on the driver data."""
    from encore import jobs as J

    def S(n: str) -> DataFrame:
        return standin(spark, sf_dir, n)

    def path(t: str) -> str:
        return f"{root.rstrip('/')}/{t}"

    plays = S("plays").select(
        F.col("song_id").cast("string").alias("songid"), F.col("mid").cast("string").alias("mid"),
        F.col("operate_type").alias("optrate_type"), F.col("uid").cast("string").alias("uid"),
        *[F.lit(None).cast("string").alias(c) for c in ("consume_type", "play_time")],
        F.col("dur_time").cast("string").alias("dur_time"),
        *[F.lit(None).cast("string").alias(c) for c in ("session_id", "songname", "pkg_id")],
        F.col("order_id").cast("string").alias("order_id"), "data_dt")
    plays.write.mode("overwrite").partitionBy("data_dt").parquet(path(J.PLAYS))
    for name, table in [("songs_raw", J.SONG_SRC), ("mac_a", J.MAC_A), ("mac_b", J.MAC_B), ("mac_addr", J.MAC_ADDR),
                        ("prvc_lookup", J.PRVC), ("cty_lookup", J.CITY), ("area_lookup", J.AREA),
                        ("store_map", J.STORE_MAP), ("store", J.STORE), ("loc_lookup", J.LOC_LOOKUP)]:
        S(name).write.mode("overwrite").parquet(path(table))
    for name, table in [("loc_reports", J.LOC_REPORTS), ("logins", J.LOGINS), ("cnsm", J.CNSM)]:
        S(name).write.mode("overwrite").partitionBy("data_dt").parquet(path(table))
    users = S("users")
    for code, id_col, table in [("1", "wx_id", J.USR_WX), ("2", "aly_id", J.USR_ALI), ("3", "qqid", J.USR_QQ),
                                ("4", "app_id", J.USR_APP)]:
        (users.where(F.col("channel") == code).withColumnRenamed("ref_uid", id_col)
              .write.mode("overwrite").parquet(path(table)))
