"""Consumption detail (J11), machine statistics (J8), merchant shares (J12) and region
totals (J13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.dates import check_day

# Order type -> abnormality code (1 -> 0 normal, 2 -> 1, 3 and 4 -> 2 refund).
ORDER_TYPE_CODES = {1: 0, 2: 1, 3: 2, 4: 2}
ABN_NORMAL, ABN_REFUND = 0, 2
# Totals are exact decimal sums: wide enough for any total, where decimal(10,4) would turn
# everything from a million on into NULL.
AMOUNT, RATE, TOTAL = "decimal(18,4)", "decimal(10,4)", "decimal(38,4)"

CONSUMPTION_COLUMNS = ["id", "trd_id", "uid", "mid", "prdcd_type", "pay_type", "act_tm", "pkg_id", "coin_prc",
                       "coin_cnt", "update_tm", "ordr_id", "actv_nm", "pkg_prc", "pkg_dscnt", "cpn_type", "abn_typ"]
MACHINE_STAT_COLUMNS = [
    "mid", "mac_nm", "prdct_typ", "store_nm", "bus_mode", "pay_sw", "scence_catgy", "sub_scence_catgy", "scene",
    "sub_scene", "brnd", "sub_brnd", "prvc", "cty", "area", "age_id", "inv_rate", "age_rate", "com_rate", "par_rate",
    "pkg_id", "pay_type", "cnsm_usr_cnt", "ref_usr_cnt", "new_usr_cnt", "rev_ordr_cnt", "ref_ordr_cnt", "tot_rev",
    "tot_ref",
]


def order_type_code(ordr_type: Column | str) -> Column:
    c = F.col(ordr_type) if isinstance(ordr_type, str) else ordr_type
    out = None
    for k, v in ORDER_TYPE_CODES.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def abs_amount(amt: Column | str) -> Column:
    """Negative amounts made positive (NULL stays NULL)."""
    c = F.col(amt) if isinstance(amt, str) else amt
    return F.when(c < 0, -c).otherwise(c)


def consumption_detail(cnsm: DataFrame, day: str | None = None) -> DataFrame:
    """17-column consumption detail: one coin per order line at the absolute amount,
    order type mapped to the abnormality code.  Narrow: no shuffle.

    With ``day`` only that day's rows (``data_dt``) are read: one partition instead of a copy
    of the whole table."""
    if day is not None:
        cnsm = cnsm.where(F.col("data_dt") == check_day(day))
    return cnsm.select(
        "id", "trd_id", F.col("uid").cast("string").alias("uid"), "mid", "prdcd_type", "pay_type", "act_tm",
        "pkg_id", abs_amount("amt").alias("coin_prc"), F.lit(1).alias("coin_cnt"),
        F.col("act_tm").alias("update_tm"), "ordr_id", "actv_nm", "pkg_prc", "pkg_dscnt", "cpn_type",
        order_type_code("ordr_type").alias("abn_typ"))


def revenue_by_package(brief: DataFrame, abn_typ: int, prefix: str) -> DataFrame:
    """Per (machine, package, pay type) for one abnormality code: distinct users,
    amount, order lines.  ``prefix`` is ``cnsm``/``rev`` (revenue) or ``ref`` (refund)."""
    users, amount, orders = ("cnsm_usr_cnt", "tot_rev", "rev_ordr_cnt") if prefix == "rev" else \
        ("ref_usr_cnt", "tot_ref", "ref_ordr_cnt")
    return (brief.where(F.col("abn_typ") == abn_typ)
                 .groupBy("mid", "pkg_id", "pay_type")
                 .agg(F.count_distinct("uid").alias(users),
                      F.sum(F.col("coin_cnt") * F.col("coin_prc")).alias(amount),
                      F.count("ordr_id").alias(orders)))


def package_money(brief: DataFrame) -> DataFrame:
    """Revenue and refund per (machine, package, pay type) in ONE pass over the detail.

    Stage 1 groups by (keys, abnormality code, user) with a map-side partial aggregate;
    stage 2 folds users into distinct counts per key.  Only keys with revenue rows are
    returned (refunds without revenue drop, as a left join on the revenue keys does);
    refund columns are NULL when the key had no refund."""
    keys = ["mid", "pkg_id", "pay_type"]
    s1 = (brief.where(F.col("abn_typ").isin(ABN_NORMAL, ABN_REFUND))
               .groupBy(*keys, "abn_typ", "uid")
               .agg(F.sum(F.col("coin_cnt") * F.col("coin_prc")).alias("amt"), F.count("ordr_id").alias("n")))
    rev, ref = F.col("abn_typ") == ABN_NORMAL, F.col("abn_typ") == ABN_REFUND
    has_uid = F.col("uid").isNotNull()
    s2 = s1.groupBy(*keys).agg(
        F.max(rev.cast("int")).alias("_has_rev"), F.max(ref.cast("int")).alias("_has_ref"),
        F.count(F.when(rev & has_uid, 1)).alias("cnsm_usr_cnt"), F.sum(F.when(rev, F.col("amt"))).alias("tot_rev"),
        F.sum(F.when(rev, F.col("n"))).alias("rev_ordr_cnt"),
        F.count(F.when(ref & has_uid, 1)).alias("ref_usr_cnt"), F.sum(F.when(ref, F.col("amt"))).alias("tot_ref"),
        F.sum(F.when(ref, F.col("n"))).alias("ref_ordr_cnt"))
    # A refund matches only on non-NULL keys (equality with NULL never holds).
    keep_ref = (F.col("_has_ref") == 1) & F.col("mid").isNotNull() & F.col("pkg_id").isNotNull() \
        & F.col("pay_type").isNotNull()
    return s2.where(F.col("_has_rev") == 1).select(
        *keys, "cnsm_usr_cnt", "tot_rev", "rev_ordr_cnt",
        *[F.when(keep_ref, F.col(c)).alias(c) for c in ("ref_usr_cnt", "tot_ref", "ref_ordr_cnt")])


def new_users_by_machine(users_today: DataFrame, day: str) -> DataFrame:
    """Users registered on ``day``, counted by the machine they registered on."""
    check_day(day)
    return (users_today.where(F.col("reg_dt") == day)
                       .groupBy(F.col("reg_mid").alias("mid"))
                       .agg(F.count("uid").alias("new_usr_cnt")))


def machine_stats(machines: DataFrame, locations: DataFrame, brief: DataFrame, users_today: DataFrame,
                  day: str) -> DataFrame:
    """29 columns per machine x package x pay type.

    Refunds count only on the revenue rows' keys (a refund group without revenue is
    dropped; NULL keys never match - see ``package_money``).  The new-user count repeats
    on each package row of a machine, so it must not be summed later.  The location snapshot overrides province, city and
    area.  All joins are on the machine id of pre-aggregated inputs."""
    money = package_money(brief)
    loc = locations.select("mid", F.col("prvc").alias("l_prvc"), F.col("cty").alias("l_cty"),
                           F.col("district").alias("l_area"))
    out = (machines.join(loc, "mid", "left")
                   .join(money, "mid", "left")
                   .join(new_users_by_machine(users_today, day), "mid", "left"))
    return out.selectExpr(
        "mid", "mac_nm", "prdct_typ", "store_nm", "bus_mode", "pay_sw", "scence_catgy", "sub_scence_catgy", "scene",
        "sub_scene", "brnd", "sub_brnd",
        "coalesce(l_prvc, prvc) AS prvc", "coalesce(l_cty, cty) AS cty", "coalesce(l_area, area) AS area",
        "prtn_nm AS age_id", "inv_rate", "age_rate", "com_rate", "par_rate", "pkg_id", "pay_type",
        *[f"coalesce({c}, 0) AS {c}" for c in ("cnsm_usr_cnt", "ref_usr_cnt", "new_usr_cnt", "rev_ordr_cnt",
                                               "ref_ordr_cnt", "tot_rev", "tot_ref")])


def merchant_share(stats: DataFrame, base: str = "refund") -> DataFrame:
    """Per agent x pay type: order counts, revenue and refund, and the four share amounts
    (amount x rate, rates as stored - not divided by 100).

    ``base="refund"`` reproduces the reference (shares of the refund amount);
    ``base="revenue"`` computes shares of revenue."""
    if base not in ("refund", "revenue"):
        raise ValueError("base must be 'refund' or 'revenue'")
    amount = F.col("tot_ref") if base == "refund" else F.col("tot_rev")

    def share(rate: str) -> Column:
        return F.sum(amount.cast(AMOUNT) * F.coalesce(F.col(rate), F.lit(0)).cast(RATE)).cast(TOTAL)

    return stats.groupBy(F.col("age_id").alias("admin_id"), "pay_type").agg(
        F.sum("rev_ordr_cnt").alias("rev_ordr_cnt"), F.sum("ref_ordr_cnt").alias("ref_ordr_cnt"),
        F.sum("tot_rev").cast("double").alias("tot_rev"), F.sum("tot_ref").cast("double").alias("tot_ref"),
        share("inv_rate").alias("tot_inv_rev"), share("age_rate").alias("tot_age_rev"),
        share("com_rate").alias("tot_com_rev"), share("par_rate").alias("tot_par_rev"))


def region_stats(stats: DataFrame) -> DataFrame:
    """Seven totals per province x city.  ``mac_cnt`` counts statistic rows (machine x
    package x pay type), as the reference does, not distinct machines."""
    return stats.groupBy("prvc", "cty").agg(
        F.count("mid").alias("mac_cnt"),
        F.sum(F.col("tot_rev").cast(AMOUNT)).cast(TOTAL).alias("mac_rev"),
        F.sum(F.col("tot_ref").cast(AMOUNT)).cast(TOTAL).alias("mac_ref"),
        F.sum("rev_ordr_cnt").alias("mac_rev_ordr_cnt"), F.sum("ref_ordr_cnt").alias("mac_ref_ordr_cnt"),
        F.sum("cnsm_usr_cnt").alias("mac_cnsm_usr_cnt"), F.sum("ref_usr_cnt").alias("mac_ref_usr_cnt"))
