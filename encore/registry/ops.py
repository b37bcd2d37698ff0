"""Registered queries: machine location (J7), consumption and marts (J11, J8, J12, J13),
users (J9, J10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions.dates import day_minus, split_timestamp
from encore.operators.sets import anti_join, set_except, snapshot_merge
from encore.plans.location import (ADDRESS_FIELDS, geocode_batches, geocode_requests,
                                   flatten_geocode, location_votes, lookup_enricher, machine_location, top_location)
from encore.plans.money import (abs_amount, consumption_detail, machine_stats, merchant_share, order_type_code,
                                region_stats, revenue_by_package)
from encore.plans.users import (CHANNEL_LABELS, GENDER_LABELS, active_users, active_users_range, channel_union, decode,
                                newly_active_users, seen_once)
from encore.registry.common import D1, D7, DAY, S, Registry, shared, sql_with
from encore.registry.dims import MACHINE_TABLES, SQL_MACHINE_DIM, machines

R = Registry()


def money4(df, *cols):
    """Double money sums rounded to 4 places (summation order only moves the last bits)."""
    return df.withColumns({c: F.round(c, 4) for c in cols})


def r4(expr: str) -> str:
    return f"round({expr}, 4)"

# ---------------------------------------------------------------- location

OLD_DAY = "20240115"      # snapshot day of the "old" side in the merge checks
GEO_BATCH = 4             # request batch size in the geocode checks (10 machines -> 3 batches)
FAILED_BATCH = 1          # the simulated service fails this batch


def sql_votes(name: str, day: str, days: int = 30, extra: str = "") -> str:
    lo = day_minus(day, days)
    return f"""{name}_votes AS (SELECT mid, lat AS x, lng AS y, count(*) AS cnt
    FROM (SELECT DISTINCT uid, mid, lat, lng FROM loc_reports WHERE data_dt BETWEEN '{lo}' AND '{day}' {extra}) t
    GROUP BY mid, lat, lng)"""


def sql_location(name: str, day: str, days: int = 30, extra: str = "") -> str:
    fields = ", ".join(f"coalesce(l.{c}, '') AS {c}" for c in ADDRESS_FIELDS)
    return f"""{sql_votes(name, day, days, extra)},
{name}_top AS (SELECT mid, x, y, cnt FROM (SELECT *, row_number() OVER (PARTITION BY mid
        ORDER BY cnt DESC, x ASC NULLS FIRST, y ASC NULLS FIRST) AS rk FROM {name}_votes) v
    WHERE rk = 1 AND x <> '' AND y <> ''),
{name}_loc AS (SELECT t.mid, t.x, t.y, t.cnt, {fields} FROM {name}_top t
    JOIN loc_lookup l ON t.x = l.x AND t.y = l.y)"""


def sql_merge(new: str, old: str) -> str:
    return (f"SELECT * FROM {old} o WHERE o.mid IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {new} n WHERE n.mid = o.mid) UNION ALL SELECT * FROM {new} WHERE mid IS NOT NULL")


LOC_T = ["loc_reports", "loc_lookup"]
MERGE_T = LOC_T + ["mac_b"]
# "new" side of the merge checks: later reports of machines known to system B.
NEW_FILTER = f"AND data_dt > '{OLD_DAY}' AND mid IN (SELECT mid FROM mac_b)"
MERGE_CTES = (sql_location("old", OLD_DAY) + ",\n"
              + sql_location("new", DAY, 14, NEW_FILTER))


def _enrich(spark, d):
    return lookup_enricher(S(spark, d, "loc_lookup"))


def _old(spark, d):
    return machine_location(S(spark, d, "loc_reports"), None, OLD_DAY, _enrich(spark, d))


def _new(spark, d):
    reports = (S(spark, d, "loc_reports").where(F.col("data_dt") > OLD_DAY)
               .join(S(spark, d, "mac_b").select("mid"), "mid", "left_semi"))
    return machine_location(reports, None, DAY, _enrich(spark, d), days=14)


R.add("location_votes", sql_with(["loc_reports"], f", {sql_votes('d', DAY)} SELECT * FROM d_votes"))(
    lambda spark, d: location_votes(S(spark, d, "loc_reports"), DAY))

R.add("top1_per_group", sql_with(LOC_T, f", {sql_location('d', DAY)} SELECT * FROM d_top"))(
    lambda spark, d: top_location(location_votes(S(spark, d, "loc_reports"), DAY)))

R.add("anti_join", sql_with(MERGE_T, f""", {MERGE_CTES}
    SELECT * FROM old_loc o WHERE NOT EXISTS (SELECT 1 FROM new_loc n WHERE n.mid = o.mid)"""))(
    lambda spark, d: anti_join(_old(spark, d), _new(spark, d).select("mid"), "mid"))

R.add("set_except", sql_with(MERGE_T, f", {MERGE_CTES} SELECT mid FROM old_loc EXCEPT SELECT mid FROM new_loc"))(
    lambda spark, d: set_except(_old(spark, d).select("mid"), _new(spark, d).select("mid")))

R.add("snapshot_merge", sql_with(MERGE_T, f", {MERGE_CTES} " + sql_merge("new_loc", "old_loc")))(
    lambda spark, d: snapshot_merge(_new(spark, d), _old(spark, d), "mid"))

LOCATION_CTES = sql_location("prev", D1) + ",\n" + sql_location("cur", DAY) + \
    f",\nmloc AS ({sql_merge('cur_loc', 'prev_loc')})"


def locations(spark, d):
    reports = S(spark, d, "loc_reports")
    prev = machine_location(reports, None, D1, _enrich(spark, d))
    return machine_location(reports, prev, DAY, _enrich(spark, d))


R.add("machine_location", sql_with(LOC_T, f", {LOCATION_CTES} SELECT * FROM mloc"))(locations)


def _locations_incremental(spark, d):
    """Today's votes from yesterday's kept report state advanced by today's reports only."""
    from encore.plans.location import advance_location_state, location_state, votes_from_state

    reports = S(spark, d, "loc_reports")
    prev = machine_location(reports, None, D1, _enrich(spark, d))
    state = advance_location_state(location_state(reports, day_minus(D1, 30), D1), reports, DAY)
    return machine_location(reports, prev, DAY, _enrich(spark, d), votes=votes_from_state(state))


R.add("machine_location_incremental", sql_with(LOC_T, f", {LOCATION_CTES} SELECT * FROM mloc"))(_locations_incremental)

LONG_DAYS = 700   # the long-window variant of the location job
LONG_CTES = sql_location("lprev", D1, LONG_DAYS) + ",\n" + sql_location("lcur", DAY, LONG_DAYS) + \
    f",\nlloc AS ({sql_merge('lcur_loc', 'lprev_loc')})"


def _locations_long(spark, d):
    reports = S(spark, d, "loc_reports")
    prev = machine_location(reports, None, D1, _enrich(spark, d), days=LONG_DAYS)
    return machine_location(reports, prev, DAY, _enrich(spark, d), days=LONG_DAYS)


R.add("machine_location_long", sql_with(LOC_T, f", {LONG_CTES} SELECT * FROM lloc"))(_locations_long)

SQL_REQUESTS = f"""req AS (SELECT mid, x, y, cnt, CAST(floor((rn - 1) / {GEO_BATCH}) AS BIGINT) AS batch_id,
        CAST((rn - 1) % {GEO_BATCH} AS INTEGER) AS pos
    FROM (SELECT *, row_number() OVER (ORDER BY mid ASC NULLS FIRST, x, y) AS rn FROM d_top) t)"""


def _requests(spark, d):
    return geocode_requests(top_location(location_votes(S(spark, d, "loc_reports"), DAY)), GEO_BATCH)


R.add("geocode_batches", sql_with(LOC_T, f""", {sql_location('d', DAY)}, {SQL_REQUESTS}
    SELECT batch_id, count(*) AS n, string_agg(y || ',' || x, '|' ORDER BY pos) AS location FROM req GROUP BY batch_id"""))(
    lambda spark, d: geocode_batches(_requests(spark, d)))


def _responses(spark, d):
    """Service responses as data: what a geocoder returns for each request batch, built
    from the location table (one batch answers with an error code)."""
    req = _requests(spark, d)
    look = S(spark, d, "loc_lookup")
    elem = F.struct(
        F.col("addr").alias("formatted_address"),
        F.struct(F.col("prvc").alias("province"), F.col("cty").alias("city"), F.col("cty_cd").alias("citycode"),
                 F.col("district"), F.col("ad_cd").alias("adcode"), F.col("town_ship").alias("township"),
                 F.col("town_cd").alias("towncode"),
                 F.struct(F.col("nb_nm").alias("name"), F.col("nb_tp").alias("type")).alias("neighborhood"),
                 F.struct(F.col("bd_nm").alias("name"), F.col("bd_tp").alias("type")).alias("building"),
                 F.struct(F.col("street"), F.col("street_nb").alias("number"), F.col("street_loc").alias("location"),
                          F.col("street_drction").alias("direction"),
                          F.col("street_dstance").alias("distance")).alias("streetNumber"),
                 F.col("bus_info").alias("businessAreas")).alias("addressComponent"))
    rows = req.join(look, ["x", "y"], "left").select("batch_id", "pos", elem.alias("e"))
    body = F.to_json(F.struct(
        F.when(F.col("batch_id") == FAILED_BATCH, F.lit("10001")).otherwise(F.lit("10000")).alias("infocode"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "e"))), lambda s: s["e"]).alias("regeocodes")))
    return rows.groupBy("batch_id").agg(body.alias("body")), req


def _flatten(spark, d):
    responses, req = _responses(spark, d)
    return flatten_geocode(responses, req)


R.add("geocode_flatten", sql_with(LOC_T, f""", {sql_location('d', DAY)}, {SQL_REQUESTS}
    SELECT r.mid, r.x, r.y, r.cnt, {', '.join(f"coalesce(l.{c}, '') AS {c}" for c in ADDRESS_FIELDS)}
    FROM req r LEFT JOIN loc_lookup l ON r.x = l.x AND r.y = l.y WHERE r.batch_id <> {FAILED_BATCH}"""))(_flatten)



def fake_geocoder(location: str) -> str:
    """Stand-in for the outside service: answers every position of a batch; a batch with a
    single position gets an error code (the job must drop its machine)."""
    import json

    pairs = [p.split(",") for p in location.split("|")]
    if len(pairs) == 1:
        return json.dumps({"infocode": "10003", "regeocodes": []})
    geo = [{"formatted_address": f"near {lng},{lat}",
            "addressComponent": {"province": f"P{lat}", "city": f"C{lng}", "citycode": lng,
                                 "neighborhood": {"name": f"N{lat}"}, "businessAreas": []}}
           for lng, lat in pairs]
    return json.dumps({"infocode": "10000", "regeocodes": geo})


def _service(spark, d):
    from encore.plans.location import service_enricher
    from encore.session import scratch_path

    enrich = service_enricher(fake_geocoder, scratch_path(spark, "geo-responses"), GEO_BATCH)
    return enrich(top_location(location_votes(S(spark, d, "loc_reports"), DAY)))


_SERVICE_FIELDS = {"addr": "'near ' || r.y || ',' || r.x", "prvc": "'P' || r.x", "cty": "'C' || r.y",
                   "cty_cd": "r.y", "nb_nm": "'N' || r.x", "bus_info": "'[]'"}
R.add("geocode_service", sql_with(LOC_T, f""", {sql_location('d', DAY)}, {SQL_REQUESTS},
    sizes AS (SELECT batch_id, count(*) AS n FROM req GROUP BY batch_id)
    SELECT r.mid, r.x, r.y, r.cnt, {', '.join(f"{_SERVICE_FIELDS.get(c, "''")} AS {c}" for c in ADDRESS_FIELDS)}
    FROM req r JOIN sizes s ON r.batch_id = s.batch_id WHERE s.n <> 1"""))(_service)

# ---------------------------------------------------------------- consumption and marts

SQL_BRIEF = """brief AS (SELECT id, trd_id, CAST(uid AS VARCHAR) AS uid, mid, prdcd_type, pay_type, act_tm, pkg_id,
    CASE WHEN amt < 0 THEN amt * -1 ELSE amt END AS coin_prc, 1 AS coin_cnt, act_tm AS update_tm, ordr_id, actv_nm,
    pkg_prc, pkg_dscnt, cpn_type,
    CASE WHEN ordr_type = 1 THEN 0 WHEN ordr_type = 2 THEN 1 WHEN ordr_type = 3 THEN 2 WHEN ordr_type = 4 THEN 2 END AS abn_typ
    FROM cnsm)"""


def _sql_rev(name: str, abn: int, users: str, amount: str, orders: str) -> str:
    return (f"{name} AS (SELECT mid, pkg_id, pay_type, count(DISTINCT uid) AS {users}, sum(coin_cnt * coin_prc) AS {amount}, "
            f"count(ordr_id) AS {orders} FROM brief WHERE abn_typ = {abn} GROUP BY mid, pkg_id, pay_type)")


SQL_REV = _sql_rev("rev", 0, "cnsm_usr_cnt", "tot_rev", "rev_ordr_cnt")
SQL_REF = _sql_rev("ref", 2, "ref_usr_cnt", "tot_ref", "ref_ordr_cnt")

R.add("consumption_detail", sql_with(["cnsm"], f", {SQL_BRIEF} SELECT * FROM brief"))(
    lambda spark, d: consumption_detail(S(spark, d, "cnsm")))

CNSM_DAY = "20240115"
R.add("consumption_day", sql_with(["cnsm"], f""", {SQL_BRIEF.replace('FROM cnsm)', f"FROM cnsm WHERE data_dt = '{CNSM_DAY}')")}
    SELECT * FROM brief"""))(lambda spark, d: consumption_detail(S(spark, d, "cnsm"), CNSM_DAY))

R.add("abs_amount", sql_with(["cnsm"], "SELECT id, amt, CASE WHEN amt < 0 THEN -amt ELSE amt END AS coin_prc FROM cnsm"))(
    lambda spark, d: S(spark, d, "cnsm").select("id", "amt", abs_amount("amt").alias("coin_prc")))

R.add("order_type_code", sql_with(["cnsm"], """SELECT id, ordr_type, CASE ordr_type WHEN 1 THEN 0 WHEN 2 THEN 1
    WHEN 3 THEN 2 WHEN 4 THEN 2 END AS abn_typ FROM cnsm"""))(
    lambda spark, d: S(spark, d, "cnsm").select("id", "ordr_type", order_type_code("ordr_type").alias("abn_typ")))

R.add("agg_revenue", sql_with(["cnsm"], f""", {SQL_BRIEF}, {SQL_REV}
    SELECT mid, pkg_id, pay_type, cnsm_usr_cnt, {r4('tot_rev')} AS tot_rev, rev_ordr_cnt FROM rev"""))(
    lambda spark, d: money4(revenue_by_package(consumption_detail(S(spark, d, "cnsm")), 0, "rev"), "tot_rev"))

R.add("join_composite", sql_with(["cnsm"], f""", {SQL_BRIEF}, {SQL_REV}, {SQL_REF}
    SELECT c.mid, c.pkg_id, c.pay_type, {r4('c.tot_rev')} AS tot_rev, {r4('d.tot_ref')} AS tot_ref, d.ref_ordr_cnt FROM rev c
    LEFT JOIN ref d ON c.mid = d.mid AND c.pkg_id = d.pkg_id AND c.pay_type = d.pay_type"""))(
    lambda spark, d: (lambda b: money4(revenue_by_package(b, 0, "rev").join(
        revenue_by_package(b, 2, "ref"), ["mid", "pkg_id", "pay_type"], "left")
        .select("mid", "pkg_id", "pay_type", "tot_rev", "tot_ref", "ref_ordr_cnt"), "tot_rev", "tot_ref"))(
            consumption_detail(S(spark, d, "cnsm"))))

# ---------------------------------------------------------------- users

USER_T = ["users", "logins"]


def _sql_channel(code: str, usr_type: str, log_mde: str = "log_mde", score: str = "score") -> str:
    return (f"SELECT uid, reg_mid, '{code}' AS reg_chnl, ref_uid, gdr, birthday, msisdn, loc_id, {log_mde} AS log_mde, "
            f"substr(reg_tm, 1, 8) AS reg_dt, substr(reg_tm, 9, 6) AS reg_tm, usr_exp, {score} AS score, level, "
            f"{usr_type} AS usr_type, CAST(NULL AS VARCHAR) AS is_cert, CAST(NULL AS VARCHAR) AS is_stdnt "
            f"FROM users WHERE channel = '{code}'")


SQL_UU = "uu AS (" + " UNION ALL ".join([
    _sql_channel("1", "'2'"), _sql_channel("2", "coalesce(usr_type, '2')"), _sql_channel("3", "'2'"),
    _sql_channel("4", "'2'", "CAST(NULL AS VARCHAR)", "CAST(0 AS BIGINT)")]) + ")"
UU_COLS = ("uu.reg_mid, uu.reg_chnl, uu.ref_uid, uu.gdr, uu.birthday, uu.msisdn, uu.loc_id, uu.log_mde, uu.reg_dt, "
           "uu.reg_tm, uu.usr_exp, uu.score, uu.level, uu.usr_type, uu.is_cert, uu.is_stdnt")
SQL_ACTIVE = f"""active AS (SELECT l.uid, {UU_COLS}
    FROM (SELECT DISTINCT uid FROM logins WHERE data_dt = '{DAY}') l LEFT JOIN uu ON l.uid = uu.uid)"""
SQL_ACTIVE_RANGE = f"""ar AS (SELECT l.uid, {UU_COLS}, l.data_dt
    FROM (SELECT DISTINCT uid, data_dt FROM logins WHERE data_dt BETWEEN '{D7}' AND '{DAY}') l LEFT JOIN uu ON l.uid = uu.uid)"""
SQL_ONCE = f"once AS (SELECT uid, count(*) AS c FROM ar WHERE data_dt BETWEEN '{D7}' AND '{DAY}' GROUP BY uid HAVING c = 1)"


def _chan_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in CHANNEL_LABELS.items()) + " ELSE '未知' END"


def _gdr_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in GENDER_LABELS.items()) + " ELSE '' END"


def users_union(spark, d):
    u = S(spark, d, "users")

    def ch(code, id_col):
        return u.where(F.col("channel") == code).withColumnRenamed("ref_uid", id_col)
    return channel_union(ch("1", "wx_id"), ch("2", "aly_id"), ch("3", "qqid"), ch("4", "app_id"))


def active_today(spark, d):
    return active_users(S(spark, d, "logins"), users_union(spark, d), DAY)


def active_week(spark, d):
    return active_users_range(S(spark, d, "logins"), users_union(spark, d), D7, DAY)


R.add("channel_union", sql_with(USER_T, f", {SQL_UU} SELECT * FROM uu"))(users_union)

R.add("split_timestamp", sql_with(["users"], """SELECT uid, reg_tm, substr(reg_tm, 1, 8) AS reg_dt,
    substr(reg_tm, 9, 6) AS reg_time FROM users"""))(
    lambda spark, d: (lambda u: u.select("uid", "reg_tm", split_timestamp("reg_tm")[0].alias("reg_dt"),
                                         split_timestamp("reg_tm")[1].alias("reg_time")))(S(spark, d, "users")))

R.add("decode_labels", sql_with(USER_T, f""", {SQL_UU}
    SELECT uid, {_chan_case('reg_chnl')} AS reg_chnl, {_gdr_case('gdr')} AS gnr FROM uu"""))(
    lambda spark, d: users_union(spark, d).select(
        "uid", decode("reg_chnl", CHANNEL_LABELS, "未知").alias("reg_chnl"), decode("gdr", GENDER_LABELS, "").alias("gnr")))

R.add("join_using", sql_with(USER_T, f"""SELECT l.uid, u.reg_mid, u.channel
    FROM (SELECT DISTINCT uid FROM logins WHERE data_dt = '{DAY}') l LEFT JOIN users u ON l.uid = u.uid"""))(
    lambda spark, d: S(spark, d, "logins").where(F.col("data_dt") == DAY).select("uid").distinct()
    .join(S(spark, d, "users"), "uid", "left").select("uid", "reg_mid", "channel"))

R.add("active_users", sql_with(USER_T, f", {SQL_UU}, {SQL_ACTIVE} SELECT * FROM active"))(active_today)

R.add("seen_once", sql_with(USER_T, f", {SQL_UU}, {SQL_ACTIVE_RANGE}, {SQL_ONCE} SELECT uid FROM once"))(
    lambda spark, d: seen_once(active_week(spark, d), DAY))

R.add("newly_active_users", sql_with(USER_T, f""", {SQL_UU}, {SQL_ACTIVE_RANGE}, {SQL_ONCE}
    SELECT a.uid, {_chan_case('b.reg_chnl')} AS reg_chnl, b.ref_uid, {_gdr_case('b.gdr')} AS gnr, b.birthday,
        b.msisdn, b.reg_dt, b.level
    FROM once a, ar b WHERE b.data_dt = '{DAY}' AND a.uid = b.uid"""))(
    lambda spark, d: newly_active_users(active_week(spark, d), DAY))

# ---------------------------------------------------------------- machine statistics and marts

STAT_T = sorted(set(MACHINE_TABLES + LOC_T + USER_T + ["cnsm"]))
SQL_STATS = f"""{SQL_MACHINE_DIM},
{LOCATION_CTES},
{SQL_BRIEF}, {SQL_REV}, {SQL_REF}, {SQL_UU}, {SQL_ACTIVE},
newu AS (SELECT reg_mid AS mid, count(uid) AS new_usr_cnt FROM active WHERE reg_dt = '{DAY}' GROUP BY reg_mid),
stats AS (SELECT a.mid, a.mac_nm, a.prdct_typ, a.store_nm, a.bus_mode, a.pay_sw, a.scence_catgy, a.sub_scence_catgy,
        a.scene, a.sub_scene, a.brnd, a.sub_brnd, coalesce(b.prvc, a.prvc) AS prvc, coalesce(b.cty, a.cty) AS cty,
        coalesce(b.district, a.area) AS area, a.prtn_nm AS age_id, a.inv_rate, a.age_rate, a.com_rate, a.par_rate,
        c.pkg_id, c.pay_type, coalesce(c.cnsm_usr_cnt, 0) AS cnsm_usr_cnt, coalesce(d.ref_usr_cnt, 0) AS ref_usr_cnt,
        coalesce(e.new_usr_cnt, 0) AS new_usr_cnt, coalesce(c.rev_ordr_cnt, 0) AS rev_ordr_cnt,
        coalesce(d.ref_ordr_cnt, 0) AS ref_ordr_cnt, coalesce(c.tot_rev, 0) AS tot_rev, coalesce(d.tot_ref, 0) AS tot_ref
    FROM mdim a LEFT JOIN mloc b ON a.mid = b.mid
    LEFT JOIN rev c ON a.mid = c.mid
    LEFT JOIN ref d ON a.mid = d.mid AND c.mid = d.mid AND c.pkg_id = d.pkg_id AND c.pay_type = d.pay_type
    LEFT JOIN newu e ON a.mid = e.mid)"""


def stats(spark, d):
    """Machine statistics over the stored dimension, locations and users of the day."""
    return machine_stats(shared(spark, d, "machine_dim", lambda: machines(spark, d)), shared(spark, d, "locations", lambda: locations(spark, d)),
                         consumption_detail(S(spark, d, "cnsm")), shared(spark, d, "active_users", lambda: active_today(spark, d)), DAY)


def stored_stats(spark, d):
    """The stored statistics, from which the marts are made."""
    return shared(spark, d, "machine_stats", lambda: stats(spark, d))


R.add("machine_stats", sql_with(STAT_T, f""", {SQL_STATS}
    SELECT * REPLACE ({r4('tot_rev')} AS tot_rev, {r4('tot_ref')} AS tot_ref) FROM stats"""))(
    lambda spark, d: money4(stats(spark, d), "tot_rev", "tot_ref"))


def _share_sql(base: str) -> str:
    sh = ", ".join(f"CAST(sum(CAST({base} AS DECIMAL(18,4)) * CAST(coalesce({r}, 0) AS DECIMAL(10,4))) AS DECIMAL(38,4)) AS tot_{n}_rev"
                   for r, n in (("inv_rate", "inv"), ("age_rate", "age"), ("com_rate", "com"), ("par_rate", "par")))
    return (f"SELECT age_id AS admin_id, pay_type, CAST(sum(rev_ordr_cnt) AS BIGINT) AS rev_ordr_cnt, "
            f"CAST(sum(ref_ordr_cnt) AS BIGINT) AS ref_ordr_cnt, {r4('CAST(sum(tot_rev) AS DOUBLE)')} AS tot_rev, "
            f"{r4('CAST(sum(tot_ref) AS DOUBLE)')} AS tot_ref, {sh} FROM stats GROUP BY age_id, pay_type")


R.add("merchant_share", sql_with(STAT_T, f", {SQL_STATS} " + _share_sql("tot_ref")))(
    lambda spark, d: money4(merchant_share(stored_stats(spark, d)), "tot_rev", "tot_ref"))

R.add("merchant_share_revenue", sql_with(STAT_T, f", {SQL_STATS} " + _share_sql("tot_rev")))(
    lambda spark, d: money4(merchant_share(stored_stats(spark, d), base="revenue"), "tot_rev", "tot_ref"))

SQL_REGION = """SELECT prvc, cty, count(mid) AS mac_cnt, CAST(sum(CAST(tot_rev AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS mac_rev,
    CAST(sum(CAST(tot_ref AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS mac_ref, CAST(sum(rev_ordr_cnt) AS BIGINT) AS mac_rev_ordr_cnt,
    CAST(sum(ref_ordr_cnt) AS BIGINT) AS mac_ref_ordr_cnt, CAST(sum(cnsm_usr_cnt) AS BIGINT) AS mac_cnsm_usr_cnt,
    CAST(sum(ref_usr_cnt) AS BIGINT) AS mac_ref_usr_cnt FROM stats GROUP BY prvc, cty"""

R.add("region_stats", sql_with(STAT_T, f", {SQL_STATS} " + SQL_REGION))(lambda spark, d: region_stats(stored_stats(spark, d)))

R.add("decimal_totals", sql_with(STAT_T, f""", {SQL_STATS}
    SELECT prvc, CAST(floor(sum(tot_rev)) / 1000 AS DECIMAL(38,4)) AS rev_k,
        CAST(sum(CAST(tot_ref AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS ref, round(CAST(sum(tot_rev) AS DOUBLE), 4) AS rev
    FROM stats GROUP BY prvc"""))(
    lambda spark, d: stored_stats(spark, d).groupBy("prvc").agg(
        (F.floor(F.sum("tot_rev")) / 1000).cast("decimal(38,4)").alias("rev_k"),
        F.sum(F.col("tot_ref").cast("decimal(18,4)")).cast("decimal(38,4)").alias("ref"),
        F.round(F.sum("tot_rev").cast("double"), 4).alias("rev")))
