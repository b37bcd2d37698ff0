"""Operators against brute force on small fixtures."""

import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.functions import day_minus
from encore.operators import global_row_number, snapshot_merge, top1_by, top_n, trailing_windows


def test_global_row_number_matches_window(spark):
    random.seed(7)
    data = [(random.choice(["a", "b", None]), random.randint(0, 20), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, score int, id int")
    order = [F.col("score").desc(), F.col("id").asc()]
    got = global_row_number(df, ["g"], order, name="rn", partitions=7)
    auto = global_row_number(df, ["g"], order, name="rn")       # AQE-sized range partitions
    assert sorted(((r.g or ""), r.id, r.rn) for r in auto.collect()) == \
        sorted(((r.g or ""), r.id, r.rn) for r in got.collect())
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    a = sorted(((r.g or ""), r.id, r.rn) for r in got.collect())
    b = sorted(((r.g or ""), r.id, r.rn) for r in want.collect())
    assert a == b
    # ranks are 1..n without gaps inside each group
    for g in ("a", "b", ""):
        ranks = sorted(r[2] for r in a if r[0] == g)
        assert ranks == list(range(1, len(ranks) + 1))


def test_top_n_and_top1(spark):
    data = [("m1", "x1", "y", 3), ("m1", "x0", "y", 3), ("m1", "x2", "y", 1), ("m2", "", "", 5), ("m2", "a", "b", 2)]
    df = spark.createDataFrame(data, "mid string, x string, y string, cnt long")
    best = {r.mid: (r.x, r.cnt) for r in top1_by(df, ["mid"], "cnt", ["x", "y"]).collect()}
    assert best == {"m1": ("x0", 3), "m2": ("", 5)}
    t = top_n(df, ["mid"], [F.col("cnt").desc(), F.col("x")], 2, name="rk")
    assert sorted((r.mid, r.x, r.rk) for r in t.collect()) == [("m1", "x0", 1), ("m1", "x1", 2), ("m2", "", 1),
                                                                ("m2", "a", 2)]


def test_trailing_windows_brute_force(spark):
    random.seed(3)
    day = "20240130"
    days = [day_minus(day, k) for k in range(0, 35)]
    data = [(random.randint(1, 6), random.choice([1, 2, 3, None]), random.randint(1, 9), random.choice(days))
            for _ in range(800)]
    df = spark.createDataFrame(data, "song_id long, uid long, order_id long, data_dt string")
    got = {r.song_id: r.asDict() for r in trailing_windows(df, day).collect()}
    pdf = pd.DataFrame(data, columns=["song_id", "uid", "order_id", "data_dt"])
    lo7, lo30, prev = day_minus(day, 7), day_minus(day, 30), day_minus(day, 1)
    w30 = pdf[(pdf.data_dt >= lo30) & (pdf.data_dt <= day)]
    for song, g in w30.groupby("song_id"):
        r = got[song]
        d1, d7 = g[g.data_dt == day], g[g.data_dt >= lo7]
        assert r["sing_cnt"] == len(d1) and r["rct_7_sing_cnt"] == len(d7) and r["rct_30_sing_cnt"] == len(g)
        assert r["usr_cnt"] == d1.uid.nunique() and r["rct_7_usr_cnt"] == d7.uid.nunique()
        assert r["rct_30_usr_cnt"] == g.uid.nunique() and r["rct_30_ordr_cnt"] == g.order_id.nunique()
        hist = g[g.data_dt <= prev].groupby("data_dt").size()
        assert r["rct_30_top_sing_cnt"] == (hist.max() if len(hist) else 0)
        h7 = hist[hist.index >= lo7]
        assert r["rct_7_top_sing_cnt"] == (h7.max() if len(h7) else 0)
    assert set(got) == set(w30.song_id.unique())


def test_snapshot_merge_keeps_each_key_once(spark):
    old = spark.createDataFrame([(1, "o1"), (2, "o2"), (None, "on")], "mid int, v string")
    new = spark.createDataFrame([(2, "n2"), (3, "n3"), (None, "nn")], "mid int, v string")
    got = sorted((r.mid, r.v) for r in snapshot_merge(new, old, "mid").collect())
    assert got == [(1, "o1"), (2, "n2"), (3, "n3")]


def test_package_money_matches_join_form(spark):
    from encore.plans.money import package_money, revenue_by_package

    data = [("1", "u1", "m1", "p", "A", 5.0, 1, 0), ("2", "u2", "m1", "p", "A", 3.0, 1, 0),
            ("3", "u1", "m1", "p", "A", 2.0, 1, 2), ("4", "u3", "m1", "q", "B", 7.0, 1, 2),
            ("5", None, "m2", None, "A", 1.0, 1, 0), ("6", "u4", "m2", None, "A", 4.0, 1, 2),
            ("7", "u5", "m3", "p", "A", 6.0, 1, 1)]
    brief = spark.createDataFrame(data, "ordr_id string, uid string, mid string, pkg_id string, pay_type string, "
                                        "coin_prc double, coin_cnt int, abn_typ int")
    keys = ["mid", "pkg_id", "pay_type"]
    want = revenue_by_package(brief, 0, "rev").join(revenue_by_package(brief, 2, "ref"), keys, "left")
    cols = keys + ["cnsm_usr_cnt", "tot_rev", "rev_ordr_cnt", "ref_usr_cnt", "tot_ref", "ref_ordr_cnt"]
    got = package_money(brief).select(*cols)
    norm = lambda df: sorted(tuple("N" if v is None else v for v in r) for r in df.select(*cols).collect())
    assert norm(got) == norm(want)


def test_advancing_the_window_state_day_by_day_equals_a_fresh_scan(spark):
    from encore.operators.windows import advance_window_state, window_state, windows_from_state

    random.seed(11)
    days = [day_minus("20240130", k) for k in range(0, 40)]
    data = [(random.randint(1, 5), random.choice([1, 2, 3, 4, None]), random.randint(1, 30), random.choice(days))
            for _ in range(1500)]
    df = spark.createDataFrame(data, "song_id long, uid long, order_id long, data_dt string")
    start = "20240125"
    state = window_state(df, day_minus(start, 30), start)
    for day in ["20240126", "20240127", "20240128", "20240129", "20240130"]:
        state = advance_window_state(state, df, day)
    fresh = window_state(df, day_minus("20240130", 30), "20240130")
    key = lambda r: tuple((0, 0) if v is None else (1, v) for v in r)
    assert sorted(map(key, state.collect())) == sorted(map(key, fresh.select(*state.columns).collect()))
    a = sorted(map(key, windows_from_state(state, "20240130").collect()))
    b = sorted(map(key, trailing_windows(df, "20240130").collect()))
    assert a == b


def test_advancing_the_location_state_equals_a_fresh_scan(spark):
    from encore.plans.location import advance_location_state, location_state, votes_from_state

    random.seed(5)
    days = [day_minus("20240130", k) for k in range(0, 40)]
    data = [(random.randint(1, 20), random.randint(0, 4), random.choice(["", "30", "31"]), random.choice(["120", "121"]),
             random.choice(days)) for _ in range(800)]
    df = spark.createDataFrame(data, "uid long, mid long, lat string, lng string, data_dt string")
    state = location_state(df, day_minus("20240127", 30), "20240127")
    for day in ["20240128", "20240129", "20240130"]:
        state = advance_location_state(state, df, day)
    fresh = location_state(df, day_minus("20240130", 30), "20240130")
    assert sorted(state.collect()) == sorted(fresh.select(*state.columns).collect())
    assert sorted(votes_from_state(state).collect()) == sorted(votes_from_state(fresh).collect())


def test_broadcast_only_under_the_bound(spark):
    from encore.operators.joins import broadcast_all_if_small

    small = spark.range(5).withColumnRenamed("id", "k")
    big = spark.range(50).withColumnRenamed("id", "k")
    fact = spark.range(100).withColumnRenamed("id", "k")
    s, b = broadcast_all_if_small([small, big], max_rows=10)
    plan_s = fact.join(s, "k")._jdf.queryExecution().optimizedPlan().toString()
    plan_b = fact.join(b, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_s.lower()
    assert "broadcast" not in plan_b.lower()


def test_cluster_conf_sizes_shuffle_partitions():
    from encore.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40))              # 100 TiB shuffled
    assert int(conf["spark.sql.shuffle.partitions"]) == 200_000       # capped
    assert int(cluster_conf(10 << 30)["spark.sql.shuffle.partitions"]) == 200   # floor
    assert int(cluster_conf(1 << 40)["spark.sql.shuffle.partitions"]) == 4096
    assert conf["spark.sql.adaptive.enabled"] == "true"
