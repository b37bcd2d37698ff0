"""Registered queries: song dimension rules (J2) and machine dimension."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions.address import city_from_address, province_from_address
from encore.functions.dates import normalise_time14, release_time
from encore.functions.text import (album_name, auth_company, blank_if_null, join_ints, product_types,
                                   singer_field, string_length)
from encore.operators.batches import register_udfs
from encore.operators.sets import key_universe
from encore.plans.machines import business_mode, machine_dim, machine_locations, machine_scene, newest_per_machine
from encore.plans.songs import SONG_DIM_COLUMNS, song_dim
from encore.registry.common import S, Registry, sql_with

R = Registry()

# ---------------------------------------------------------------- DuckDB forms of the rules


def sql_json_elem_field(col: str, i: int, field: str, default: str) -> str:
    return (f"CASE WHEN json_valid({col}) THEN (CASE WHEN ltrim({col}) LIKE '[%' AND json_type({col}, '$[{i}]') = 'OBJECT' "
            f"THEN json_extract_string({col}, '$[{i}].{field}') ELSE {default} END) ELSE {default} END")


def sql_album(col: str) -> str:
    bracket = "'^[^《》]*《([^》]*)》'"
    is_obj = f"(CASE WHEN json_valid({col}) THEN ltrim({col}) LIKE '[%' AND json_type({col}, '$[0]') = 'OBJECT' END)"
    return (f"CASE WHEN {is_obj} THEN json_extract_string({col}, '$[0].name') "
            f"WHEN strpos({col}, '《') > 0 AND strpos({col}, '》') > strpos({col}, '《') "
            f"THEN substr({col}, strpos({col}, '《') + 1, strpos({col}, '》') - strpos({col}, '《') - 1) "
            f"ELSE '暂无专辑' END")


def sql_release(col: str) -> str:
    prefix = rf"regexp_extract({col}, '^(\d{{1,4}}-\d{{1,2}}-\d{{1,2}} \d{{1,2}}:\d{{1,2}}:\d{{1,2}})', 1)"
    ts = f"try_strptime({prefix}, '%Y-%m-%d %H:%M:%S')"
    ms = f"CAST(trunc(TRY_CAST({col} AS DOUBLE)) AS BIGINT)"
    return (f"CASE WHEN {ts} IS NOT NULL THEN strftime({ts}, '%Y-%m-%d %H:%M:%S') "
            f"WHEN TRY_CAST({col} AS DOUBLE) IS NOT NULL THEN strftime(make_timestamp({ms} * 1000), '%Y-%m-%d %H:%M:%S') "
            f"ELSE '' END")


def sql_company(col: str) -> str:
    return (f"CASE WHEN (CASE WHEN json_valid({col}) THEN json_type({col}) = 'OBJECT' END) "
            f"THEN json_extract_string({col}, '$.name') ELSE '乐心曲库' END")


def sql_types_text(col: str) -> str:
    stripped = rf"regexp_replace(regexp_replace(regexp_replace({col}, '^\[', ''), '\]$', ''), ',+$', '')"
    items = (f"list_transform(string_split({stripped}, ','), lambda x: coalesce("
             f"CAST(TRY_CAST(trunc(TRY_CAST(x AS DOUBLE)) AS INTEGER) AS VARCHAR), 'null'))")
    return (f"CASE WHEN {col} IS NULL OR trim({col}) = '' OR trim({stripped}) = '' THEN NULL "
            f"ELSE array_to_string({items}, ',') END")


def sql_time14(col: str) -> str:
    return (f"CASE WHEN length({col}) = 14 THEN {col} WHEN length({col}) = 8 THEN {col} || '000000' "
            f"ELSE '19700101000000' END")


def sql_province(a: str) -> str:
    marks = [("内蒙古自治区", "内蒙古"), ("宁夏回族自治区", "宁夏"), ("西藏自治区", "西藏"), ("广西壮族自治区", "广西"),
             ("新疆维吾尔自治区", "新疆"), ("北京市", "北京"), ("上海市", "上海"), ("重庆市", "重庆"), ("天津市", "天津")]
    whens = " ".join(f"WHEN strpos({a}, '{m}') > 0 THEN '{v}'" for m, v in marks)
    return f"CASE {whens} WHEN strpos({a}, '省') > 0 THEN substr({a}, 1, strpos({a}, '省') - 1) ELSE '' END"


def _cut(a: str, start: str, end: str) -> str:
    """substring between the first ``start`` and the first ``end`` (positions from the
    beginning), '' when that range is empty-invalid."""
    i, j = f"strpos({a}, '{start}')", f"strpos({a}, '{end}')"
    return f"CASE WHEN {i} > 0 AND {j} > {i} THEN substr({a}, {i} + 1, {j} - {i} - 1) ELSE '' END"


def sql_city(a: str) -> str:
    rest_q = f"substr({a}, strpos({a}, '区') + 1)"
    xj = (f"CASE WHEN strpos({a}, '市') > strpos({a}, '区') THEN {_cut(a, '区', '市')} "
          f"WHEN strpos({rest_q}, '区') > 0 THEN substr({rest_q}, 1, strpos({rest_q}, '区') - 1) "
          f"WHEN strpos({rest_q}, '州') > 0 THEN substr({rest_q}, 1, strpos({rest_q}, '州') - 1) ELSE '' END")
    rest_s = f"substr({a}, strpos({a}, '市') + 1)"
    cq = (f"CASE WHEN strpos({rest_s}, '区') > 0 THEN {_cut(a, '市', '区')} "
          f"WHEN strpos({rest_s}, '县') > 0 THEN {_cut(a, '市', '县')} ELSE '' END")
    rest_p = f"substr({a}, strpos({a}, '省') + 1)"
    pv = (f"CASE WHEN strpos({rest_p}, '市') > 0 THEN {_cut(a, '省', '市')} "
          f"WHEN strpos({rest_p}, '州') > 0 THEN substr({rest_p}, 1, strpos({rest_p}, '州') - 1) ELSE '' END")
    return (f"CASE WHEN strpos({a}, '内蒙古自治区') > 0 OR strpos({a}, '宁夏回族自治区') > 0 "
            f"OR strpos({a}, '广西壮族自治区') > 0 THEN {_cut(a, '区', '市')} "
            f"WHEN strpos({a}, '新疆维吾尔自治区') > 0 THEN {xj} "
            f"WHEN strpos({a}, '北京市') > 0 OR strpos({a}, '上海市') > 0 THEN {_cut(a, '市', '区')} "
            f"WHEN strpos({a}, '重庆市') > 0 THEN {cq} "
            f"WHEN strpos({a}, '天津市') > 0 THEN {_cut(a, '市', '区')} "
            f"WHEN strpos({a}, '省') > 0 THEN {pv} ELSE '' END")


# ---------------------------------------------------------------- song dimension rules

R.add("album_name", sql_with(["songs_raw"], f"SELECT nbr, album, {sql_album('album')} AS album_name FROM songs_raw"))(
    lambda spark, d: S(spark, d, "songs_raw").select("nbr", "album", album_name("album").alias("album_name")))

R.add("release_time", sql_with(["songs_raw"],
                               f"SELECT nbr, post_time, {sql_release('post_time')} AS release_time FROM songs_raw"))(
    lambda spark, d: S(spark, d, "songs_raw").select("nbr", "post_time",
                                                    release_time("post_time").alias("release_time")))

R.add("singer_fields", sql_with(["songs_raw"], f"""SELECT nbr,
    {sql_json_elem_field('singer_info', 0, 'name', "''")} AS singer1,
    {sql_json_elem_field('singer_info', 0, 'id', "''")} AS singer1id,
    {sql_json_elem_field('singer_info', 1, 'name', "''")} AS singer2,
    {sql_json_elem_field('singer_info', 1, 'id', "''")} AS singer2id FROM songs_raw"""))(
    lambda spark, d: S(spark, d, "songs_raw").select(
        "nbr", singer_field("singer_info", 0, "name").alias("singer1"),
        singer_field("singer_info", 0, "id").alias("singer1id"),
        singer_field("singer_info", 1, "name").alias("singer2"),
        singer_field("singer_info", 1, "id").alias("singer2id")))

R.add("auth_company", sql_with(["songs_raw"], f"SELECT nbr, auth_co, {sql_company('auth_co')} AS company FROM songs_raw"))(
    lambda spark, d: S(spark, d, "songs_raw").select("nbr", "auth_co", auth_company("auth_co").alias("company")))

def sql_types_count(col: str) -> str:
    stripped = rf"regexp_replace(regexp_replace(regexp_replace({col}, '^\[', ''), '\]$', ''), ',+$', '')"
    return (f"CASE WHEN {col} IS NULL OR trim({col}) = '' OR trim({stripped}) = '' THEN NULL "
            f"ELSE CAST(len(string_split({stripped}, ',')) AS INTEGER) END")


R.add("product_types", sql_with(["songs_raw"], f"""SELECT nbr, prdct_type, {sql_types_text('prdct_type')} AS types,
    {sql_types_count('prdct_type')} AS n_types FROM songs_raw"""))(
    lambda spark, d: S(spark, d, "songs_raw").select(
        "nbr", "prdct_type", join_ints(product_types("prdct_type")).alias("types"),
        F.size(product_types("prdct_type")).alias("n_types")))

R.add("filter_nonempty", sql_with(["songs_raw"], "SELECT nbr, name FROM songs_raw WHERE nbr <> ''"))(
    lambda spark, d: S(spark, d, "songs_raw").where(F.col("nbr") != "").select("nbr", "name"))

R.add("blank_if_null", sql_with(["songs_raw"], "SELECT nbr, coalesce(name, '') AS name FROM songs_raw"))(
    lambda spark, d: S(spark, d, "songs_raw").select("nbr", blank_if_null("name").alias("name")))

R.add("string_length", sql_with(["songs_raw"], "SELECT nbr, CAST(length(other_name) AS INTEGER) AS name_len FROM songs_raw"))(
    lambda spark, d: S(spark, d, "songs_raw").select("nbr", string_length("other_name").alias("name_len")))


def _registered_udf(spark, d):
    register_udfs(spark)
    return S(spark, d, "songs_raw").selectExpr("nbr", "name_length(other_name) AS name_len")


R.add("registered_udf", sql_with(["songs_raw"],
                                 "SELECT nbr, CAST(length(other_name) AS INTEGER) AS name_len FROM songs_raw"))(_registered_udf)

_DIM_SQL_COLS = {
    "name": "coalesce(name, other_name)",
    "album": sql_album("album"),
    "singer1": sql_json_elem_field("singer_info", 0, "name", "''"),
    "singer2": sql_json_elem_field("singer_info", 1, "name", "''"),
    "singer1id": sql_json_elem_field("singer_info", 0, "id", "''"),
    "singer2id": sql_json_elem_field("singer_info", 1, "id", "''"),
    "mac_time": "0",
    "post_time": sql_release("post_time"),
    "auth_co": sql_company("auth_co"),
    "prdct_type": sql_types_text("prdct_type"),
}
R.add("song_dim", sql_with(["songs_raw"], "SELECT " + ", ".join(
    f"{_DIM_SQL_COLS.get(c, c)} AS {c}" for c in SONG_DIM_COLUMNS) + " FROM songs_raw WHERE nbr <> ''"))(
    lambda spark, d: song_dim(S(spark, d, "songs_raw")).withColumn("prdct_type", join_ints("prdct_type")))

# ---------------------------------------------------------------- machine dimension rules

R.add("province_from_address", sql_with(["mac_addr"], f"SELECT mid, addr, {sql_province('addr')} AS prvc FROM mac_addr"))(
    lambda spark, d: S(spark, d, "mac_addr").select("mid", "addr", province_from_address("addr").alias("prvc")))

R.add("city_from_address", sql_with(["mac_addr"], f"SELECT mid, addr, {sql_city('addr')} AS cty FROM mac_addr"))(
    lambda spark, d: S(spark, d, "mac_addr").select("mid", "addr", city_from_address("addr").alias("cty")))

R.add("normalise_time", sql_with(["mac_b"], f"""SELECT mid, actv_tm, {sql_time14('actv_tm')} AS actv_tm14,
    {sql_time14('order_tm')} AS order_tm14 FROM mac_b"""))(
    lambda spark, d: S(spark, d, "mac_b").select("mid", "actv_tm", normalise_time14("actv_tm").alias("actv_tm14"),
                                                 normalise_time14("order_tm").alias("order_tm14")))

R.add("business_mode", sql_with(["mac_b"], """SELECT mid, pkg_nm, inv_rate,
    CASE WHEN pkg_nm = '联营版' THEN '联营' WHEN inv_rate < 100 THEN '联营' ELSE '卖断' END AS bus_mode FROM mac_b"""))(
    lambda spark, d: S(spark, d, "mac_b").select("mid", "pkg_nm", "inv_rate",
                                                 business_mode("pkg_nm", "inv_rate").alias("bus_mode")))

R.add("concat_address", sql_with(["mac_b"], "SELECT mid, scene_addr || ground_nm AS addr FROM mac_b"))(
    lambda spark, d: S(spark, d, "mac_b").select("mid", F.concat("scene_addr", "ground_nm").alias("addr")))

R.add("project_rename", sql_with(["mac_b"], """SELECT mid, mac_nm AS machine_name, pkg_nm AS prdct_nm,
    ground_nm AS store_nm, ground_nm AS prtn_nm, inv_rate AS investor_rate FROM mac_b"""))(
    lambda spark, d: S(spark, d, "mac_b").select(
        "mid", F.col("mac_nm").alias("machine_name"), F.col("pkg_nm").alias("prdct_nm"),
        F.col("ground_nm").alias("store_nm"), F.col("ground_nm").alias("prtn_nm"),
        F.col("inv_rate").alias("investor_rate")))

R.add("key_universe", sql_with(["mac_a", "mac_b"], "SELECT mid FROM mac_a UNION SELECT mid FROM mac_b"))(
    lambda spark, d: key_universe([S(spark, d, "mac_a"), S(spark, d, "mac_b")], "mid"))

SQL_LOC = f"""loc AS (
  SELECT mid, prvc, cty, addr, addr_fmt, {sql_time14('rev_tm')} AS rev_tm, {sql_time14('sale_tm')} AS sale_tm FROM (
    SELECT mid, CASE WHEN addr IS NULL THEN '' ELSE {sql_province('addr')} END AS prvc,
           CASE WHEN addr IS NULL THEN '' ELSE {sql_city('addr')} END AS cty, addr, addr_fmt, rev_tm, sale_tm
      FROM mac_addr WHERE prvc = 'null' AND cty = 'null'
    UNION ALL
    SELECT mid, prvc, cty, addr, addr_fmt, rev_tm, sale_tm FROM mac_addr WHERE prvc <> 'null' AND cty <> 'null') u
  WHERE prvc <> '' AND cty <> '')"""

R.add("null_sentinel_split", sql_with(["mac_addr"], f", {SQL_LOC} SELECT * FROM loc"))(
    lambda spark, d: machine_locations(S(spark, d, "mac_addr")))

SQL_SCENE = f"""bn AS (SELECT * REPLACE ({sql_time14('actv_tm')} AS actv_tm, {sql_time14('order_tm')} AS order_tm) FROM mac_b),
ids AS (SELECT mid FROM mac_a UNION SELECT mid FROM bn),
ycbk AS (SELECT ids.mid, ma.mac_nm, ma.pkg_nm, ma.inv_rate, ma.age_rate, ma.com_rate, ma.par_rate, ma.is_actv,
        ma.actv_tm, ma.had_mpay_func AS b_pay_sw, p.prvc AS b_prvc, c.cty AS b_cty, ar.area AS b_area,
        ma.scene_addr || ma.ground_nm AS b_addr, st.ground_nm AS b_store_nm, st.tag_nm, st.sub_tag_nm,
        st.sub_scene_catgy_nm, st.sub_scene_nm, st.brnd_nm, st.sub_brnd_nm
    FROM ids LEFT JOIN bn ma ON ids.mid = ma.mid
    LEFT JOIN prvc_lookup p ON ma.scene_prvc_id = p.prvc_id
    LEFT JOIN cty_lookup c ON ma.scene_cty_id = c.cty_id
    LEFT JOIN area_lookup ar ON ma.scene_area_id = ar.area_id
    LEFT JOIN store_map sm ON ids.mid = sm.mid
    LEFT JOIN store st ON sm.store_id = st.id)"""

MACHINE_TABLES = ["mac_a", "mac_b", "mac_addr", "prvc_lookup", "cty_lookup", "area_lookup", "store_map", "store"]


def _scene(spark, d):
    b = S(spark, d, "mac_b").withColumn("actv_tm", normalise_time14("actv_tm")) \
        .withColumn("order_tm", normalise_time14("order_tm"))
    ids = key_universe([S(spark, d, "mac_a"), b], "mid")
    return machine_scene(ids, b, *[S(spark, d, t) for t in MACHINE_TABLES[3:]])


R.add("join_star", sql_with(MACHINE_TABLES, f", {SQL_SCENE} SELECT * FROM ycbk"))(_scene)

SQL_MACHINE_DIM = f"""{SQL_LOC},
{SQL_SCENE},
ycak AS (SELECT ids.mid, a.srl_id, a.hard_id, a.song_whse_ver, a.exec_ver, a.ui_ver, a.sts, a.cur_login_tm, a.pay_sw,
        a.is_online, loc.prvc, loc.cty, loc.addr_fmt, loc.rev_tm, loc.sale_tm
    FROM ids LEFT JOIN mac_a a ON ids.mid = a.mid LEFT JOIN loc ON ids.mid = loc.mid),
mdim AS (SELECT y.mid, b.mac_nm, y.song_whse_ver, y.exec_ver, y.ui_ver, y.hard_id, y.sale_tm, y.rev_tm,
        b.b_store_nm AS oper_nm, coalesce(y.prvc, b.b_prvc) AS prvc, coalesce(y.cty, b.b_cty) AS cty, b.b_area AS area,
        coalesce(y.addr_fmt, b.b_addr) AS addr, b.b_store_nm AS store_nm, b.tag_nm AS scence_catgy,
        b.sub_scene_catgy_nm AS sub_scence_catgy, b.sub_tag_nm AS scene, b.sub_scene_nm AS sub_scene,
        b.brnd_nm AS brnd, b.sub_brnd_nm AS sub_brnd, b.pkg_nm AS prdct_nm, 2 AS prdct_typ,
        CASE WHEN b.pkg_nm = '联营版' THEN '联营' WHEN b.inv_rate < 100 THEN '联营' ELSE '卖断' END AS bus_mode,
        b.inv_rate, b.age_rate, b.com_rate, b.par_rate, coalesce(y.sts, b.is_actv) AS is_actv, b.actv_tm,
        coalesce(y.pay_sw, b.b_pay_sw) AS pay_sw, b.b_store_nm AS prtn_nm, y.cur_login_tm
    FROM ycak y LEFT JOIN ycbk b ON y.mid = b.mid)"""


def machines(spark, d):
    return machine_dim(*[S(spark, d, t) for t in MACHINE_TABLES])


R.add("machine_dim", sql_with(MACHINE_TABLES, f", {SQL_MACHINE_DIM} SELECT * FROM mdim"))(machines)

R.add("prefer_first_source", sql_with(MACHINE_TABLES, f""", {SQL_MACHINE_DIM}
    SELECT mid, prvc, cty, addr, is_actv, pay_sw FROM mdim"""))(
    lambda spark, d: machines(spark, d).select("mid", "prvc", "cty", "addr", "is_actv", "pay_sw"))

# Every third machine of system A is listed again with an older login and more columns, every
# fifth once more with the same login and an empty column: the newest counts, then the fullest.
_TWICE = """SELECT * FROM mac_a
    UNION ALL SELECT mid, srl_id, hard_id, 'older' AS song_whse_ver, exec_ver, ui_ver, '9' AS sts, '20230101000000' AS cur_login_tm, '9' AS pay_sw, is_online
        FROM mac_a WHERE mid % 3 = 0
    UNION ALL SELECT mid, NULL AS srl_id, hard_id, song_whse_ver, exec_ver, ui_ver, sts, cur_login_tm, pay_sw, is_online FROM mac_a WHERE mid % 5 = 0"""


def _newest(spark, d):
    a = S(spark, d, "mac_a")
    older = a.where(F.col("mid") % 3 == 0).withColumns({"song_whse_ver": F.lit("older"), "sts": F.lit("9"), "pay_sw": F.lit("9"),
                                                        "cur_login_tm": F.lit("20230101000000")})
    emptier = a.where(F.col("mid") % 5 == 0).withColumn("srl_id", F.lit(None).cast("string"))
    return newest_per_machine(a.unionByName(older).unionByName(emptier), "cur_login_tm")


R.add("newest_per_machine", sql_with(["mac_a"], f""", twice AS ({_TWICE}), ranked AS (SELECT *, row_number() OVER (PARTITION BY mid
        ORDER BY cur_login_tm DESC NULLS LAST, (CASE WHEN srl_id IS NULL THEN 0 ELSE 1 END) DESC) AS rk FROM twice)
    SELECT mid, srl_id, hard_id, song_whse_ver, exec_ver, ui_ver, sts, cur_login_tm, pay_sw, is_online FROM ranked WHERE rk = 1"""))(_newest)
