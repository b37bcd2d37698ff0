"""Machine dimension (J6): two source systems merged on the machine id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.address import city_from_address, province_from_address
from encore.functions.dates import normalise_time14
from encore.operators.joins import LOOKUP_MAX_ROWS, broadcast_all_if_small
from encore.operators.sets import key_universe

# Fixed values (must equal the reference's labels).
JOINT_PACKAGE = "联营版"     # package name that always means a revenue-sharing machine
MODE_JOINT = "联营"          # revenue-sharing operation
MODE_SOLD = "卖断"           # sold outright
FULL_RATE = 100             # investor rate meaning "all revenue to the investor"
PRODUCT_TYPE = 2

MACHINE_DIM_COLUMNS = [
    "mid", "mac_nm", "song_whse_ver", "exec_ver", "ui_ver", "hard_id", "sale_tm", "rev_tm", "oper_nm", "prvc",
    "cty", "area", "addr", "store_nm", "scence_catgy", "sub_scence_catgy", "scene", "sub_scene", "brnd",
    "sub_brnd", "prdct_nm", "prdct_typ", "bus_mode", "inv_rate", "age_rate", "com_rate", "par_rate", "is_actv",
    "actv_tm", "pay_sw", "prtn_nm", "cur_login_tm",
]


def business_mode(pkg_nm: Column | str, inv_rate: Column | str) -> Column:
    """Joint package or investor rate below 100 -> joint operation; otherwise (NULL rate
    too) sold outright."""
    p = F.col(pkg_nm) if isinstance(pkg_nm, str) else pkg_nm
    r = F.col(inv_rate) if isinstance(inv_rate, str) else inv_rate
    return (F.when(p == JOINT_PACKAGE, F.lit(MODE_JOINT))
            .when(r < FULL_RATE, F.lit(MODE_JOINT))
            .otherwise(F.lit(MODE_SOLD)))


def machine_locations(addr_rows: DataFrame) -> DataFrame:
    """Address rows with usable province and city.

    Rows whose province and city are both given (not the text ``'null'``) are kept; rows
    where both are ``'null'`` get them from the address; mixed rows and SQL NULLs drop
    out; then both must be non-empty.  Times are normalised to 14 characters."""
    given = addr_rows.where((F.col("prvc") != "null") & (F.col("cty") != "null"))
    # Both are the text 'null' here: derive them from the address ('' when it is NULL).
    addr = F.coalesce(F.col("addr"), F.lit(""))
    derived = (addr_rows.where((F.col("prvc") == "null") & (F.col("cty") == "null"))
               .withColumn("prvc", province_from_address(addr))
               .withColumn("cty", city_from_address(addr)))
    return (derived.unionByName(given)
            .where((F.col("prvc") != "") & (F.col("cty") != ""))
            .withColumn("rev_tm", normalise_time14("rev_tm"))
            .withColumn("sale_tm", normalise_time14("sale_tm")))


def one_per_machine(df: DataFrame) -> DataFrame:
    """One row per ``mid``: the least of its rows, column by column (NULL first).  A partial
    aggregate, so a machine with many rows costs one per task."""
    rest = [c for c in df.columns if c != "mid"]
    return df.groupBy("mid").agg(F.min(F.struct(*rest)).alias("_row")).select("mid", "_row.*")


def newest_per_machine(df: DataFrame, time_col: str | None = None) -> DataFrame:
    """One row per ``mid``: the one with the latest ``time_col`` (NULL is oldest), of those the one
    with the most columns filled, of those the greatest.  A partial aggregate as well."""
    rest = [c for c in df.columns if c != "mid"]
    filled = sum((F.col(c).isNotNull().cast("int") for c in rest), F.lit(0))
    time = F.col(time_col) if time_col else F.lit(None).cast("string")
    best = F.max(F.struct(time.alias("_time"), filled.alias("_filled"), F.struct(*rest).alias("_row"))).alias("_best")
    return df.groupBy("mid").agg(best).select("mid", "_best._row.*")


def machine_dim(mac_a: DataFrame, mac_b: DataFrame, mac_addr: DataFrame, prvc: DataFrame, cty: DataFrame,
                area: DataFrame, store_map: DataFrame, store: DataFrame,
                lookup_max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """32-column machine dimension.

    The key universe is every machine id known to either system; each source is cut to one
    row per machine first, the newest and fullest, so a machine listed twice is not doubled.  System A's values win over
    system B's for province, city, address, active flag and payment switch.  The region
    and store lookups are broadcast only after a size check."""
    b = (mac_b.withColumn("actv_tm", normalise_time14("actv_tm"))
              .withColumn("order_tm", normalise_time14("order_tm")))
    ids = key_universe([mac_a, b], "mid")
    mac_a, b = newest_per_machine(mac_a, "cur_login_tm"), newest_per_machine(b, "order_tm")
    store_map, loc = newest_per_machine(store_map.select("mid", "store_id")), newest_per_machine(machine_locations(mac_addr), "rev_tm")

    ycak = (ids.join(mac_a, "mid", "left")
               .join(loc.select("mid", "prvc", "cty", "addr_fmt", "rev_tm", "sale_tm"), "mid", "left")
               .select("mid", "srl_id", "hard_id", "song_whse_ver", "exec_ver", "ui_ver", "sts", "cur_login_tm",
                       "pay_sw", "is_online", "prvc", "cty", "addr_fmt", "rev_tm", "sale_tm"))

    ycbk = machine_scene(ids, b, prvc, cty, area, store_map, store, lookup_max_rows)

    m = ycak.join(ycbk, "mid", "left")
    return m.select(
        "mid", "mac_nm", "song_whse_ver", "exec_ver", "ui_ver", "hard_id", "sale_tm", "rev_tm",
        F.col("b_store_nm").alias("oper_nm"),
        F.coalesce("prvc", "b_prvc").alias("prvc"),
        F.coalesce("cty", "b_cty").alias("cty"),
        F.col("b_area").alias("area"),
        F.coalesce("addr_fmt", "b_addr").alias("addr"),
        F.col("b_store_nm").alias("store_nm"),
        F.col("tag_nm").alias("scence_catgy"),
        F.col("sub_scene_catgy_nm").alias("sub_scence_catgy"),
        F.col("sub_tag_nm").alias("scene"),
        F.col("sub_scene_nm").alias("sub_scene"),
        F.col("brnd_nm").alias("brnd"),
        F.col("sub_brnd_nm").alias("sub_brnd"),
        F.col("pkg_nm").alias("prdct_nm"),
        F.lit(PRODUCT_TYPE).alias("prdct_typ"),
        business_mode("pkg_nm", "inv_rate").alias("bus_mode"),
        "inv_rate", "age_rate", "com_rate", "par_rate",
        F.coalesce("sts", "is_actv").alias("is_actv"),
        "actv_tm",
        F.coalesce("pay_sw", "b_pay_sw").alias("pay_sw"),
        F.col("b_store_nm").alias("prtn_nm"),
        "cur_login_tm")


def machine_scene(ids: DataFrame, mac_b: DataFrame, prvc: DataFrame, cty: DataFrame, area: DataFrame,
                  store_map: DataFrame, store: DataFrame, lookup_max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """System B's view of each machine: contract, scene region names (three lookups keyed
    from the contract row) and store (through the machine-store bridge)."""
    p, c, a, st = broadcast_all_if_small([
        prvc.select("prvc_id", F.col("prvc").alias("b_prvc")),
        cty.select("cty_id", F.col("cty").alias("b_cty")),
        area.select("area_id", F.col("area").alias("b_area")),
        store.select(F.col("id").alias("store_id"), F.col("ground_nm").alias("b_store_nm"), "tag_nm", "sub_tag_nm",
                     "sub_scene_catgy_nm", "sub_scene_nm", "brnd_nm", "sub_brnd_nm")], lookup_max_rows)
    return (ids.join(mac_b, "mid", "left")
               .join(p, F.col("scene_prvc_id") == F.col("prvc_id"), "left")
               .join(c, F.col("scene_cty_id") == F.col("cty_id"), "left")
               .join(a, F.col("scene_area_id") == F.col("area_id"), "left")
               .join(store_map.select("mid", "store_id"), "mid", "left")
               .join(st, "store_id", "left")
               .select("mid", "mac_nm", "pkg_nm", "inv_rate", "age_rate", "com_rate", "par_rate", "is_actv",
                       "actv_tm", F.col("had_mpay_func").alias("b_pay_sw"), "b_prvc", "b_cty", "b_area",
                       F.concat("scene_addr", "ground_nm").alias("b_addr"), "b_store_nm", "tag_nm", "sub_tag_nm",
                       "sub_scene_catgy_nm", "sub_scene_nm", "brnd_nm", "sub_brnd_nm"))
