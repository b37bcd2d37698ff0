"""Money totals that cannot overflow, one row per machine, and the location job's states."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_CHECK
from encore import jobs as J
from encore.plans.location import lookup_enricher
from encore.plans.machines import one_per_machine
from encore.registry import build


@pytest.mark.parametrize("name, columns", [
    ("region_stats", ["mac_rev", "mac_ref"]),
    ("merchant_share", ["tot_inv_rev", "tot_age_rev", "tot_com_rev", "tot_par_rev"]),
    ("merchant_share_revenue", ["tot_inv_rev", "tot_age_rev", "tot_com_rev", "tot_par_rev"]),
    ("decimal_totals", ["rev_k", "ref"]),
])
def test_no_money_total_is_null(spark, name, columns):
    df = build().queries[name](spark, SF_CHECK)
    nulls = df.select(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]).first()
    assert set(nulls) == {0} and df.count()


def test_one_row_per_machine(spark):
    df = spark.createDataFrame([("m", 2, "b"), ("m", 1, "z"), ("n", None, "a"), ("n", 3, "c")], "mid string, x int, y string")
    assert sorted(map(tuple, one_per_machine(df).collect())) == [("m", 1, "z"), ("n", None, "a")]


def test_unknown_position_gives_no_row(spark):
    from encore.plans.location import ADDRESS_FIELDS

    top = spark.createDataFrame([("m", "1", "2", 3), ("n", "8", "9", 1)], "mid string, x string, y string, cnt long")
    fields = ", ".join(f"`{c}` string" for c in ADDRESS_FIELDS)
    look = spark.createDataFrame([("1", "2", *["a"] * len(ADDRESS_FIELDS))], f"x string, y string, {fields}")
    assert [r["mid"] for r in lookup_enricher(look)(top).collect()] == ["m"]


def test_missing_day_and_read_error(spark, tmp_path):
    wh = J.Warehouse(spark, str(tmp_path))
    assert J._day_or_none(wh, "t", "20240102") is None
    assert J._latest_before(wh, "t", "20240103") is None
    wh.write_day(spark.createDataFrame([(1,)], "v int"), "t", "20240101")
    assert J._day_or_none(wh, "t", "20240102") is None
    assert J._latest_before(wh, "t", "20240103").first()["v"] == 1  # two days back
    bad = tmp_path / "t" / "data_dt=20240102"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception) as e:
        J._day_or_none(wh, "t", "20240102")
    assert not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND"


def test_a_corrected_past_day_and_a_longer_window(spark, tmp_path):
    from encore.plans.location import combine_location_partials, location_state

    wh = J.Warehouse(spark, str(tmp_path))
    cols = "uid string, mid string, lat string, lng string, data_dt string"

    def reports(*rows):
        return spark.createDataFrame([(u, "m", "1", "2", d) for u, d in rows], cols)

    def users(source, day, days=30, changed=()):
        parts = J._partials(wh, J.LOC_STATE, source, location_state, day, days, changed)
        return sorted((r.uid, r["last"]) for r in combine_location_partials(parts).collect())

    first = reports(("a", "20231201"), ("b", "20240101"), ("c", "20240130"))
    assert users(first, "20240130") == [("b", 20240101), ("c", 20240130)]
    assert users(first, "20240131") == [("b", 20240101), ("c", 20240130)]      # [D-30, D]
    assert users(first, "20240201") == [("c", 20240130)]                       # b has left the window
    late = reports(("a", "20231201"), ("d", "20240130"))
    assert users(late, "20240131", changed=["20240130"]) == [("b", 20240101), ("d", 20240130)]
    gone = reports(("a", "20231201"))
    assert users(gone, "20240131", changed=["20240130"]) == [("b", 20240101)]
    assert users(gone, "20240131", days=61) == [("a", 20231201), ("b", 20240101)]


def test_gzip_log(spark, tmp_path):
    import gzip

    from encore.sources.scans import scan_text_log

    (tmp_path / "log").mkdir()
    with gzip.open(tmp_path / "log" / "a.gz", "wt") as f:
        f.write("one\ntwo\n")
    assert sorted(r[0] for r in scan_text_log(spark, str(tmp_path / "log")).collect()) == ["one", "two"]


def test_catalog_tables(spark, tmp_path):
    from encore.sources.scans import scan_table

    spark.sql(f"CREATE DATABASE IF NOT EXISTS booth LOCATION '{tmp_path}/db'")
    try:
        spark.range(3).write.saveAsTable("booth.machines", path=f"{tmp_path}/machines")
        assert scan_table(spark, "machines", "booth").count() == 3
        assert scan_table(spark, "booth.machines").count() == 3
        spark.sql("USE booth")                       # the current database
        assert scan_table(spark, "machines").count() == 3
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE booth CASCADE")


def test_play_table_stream_takes_the_day_from_the_folder(spark, tmp_path):
    from encore.streaming.client_log_stream import land_play_table

    for day, song in (("20240129", "1"), ("20240130", "2")):
        (tmp_path / "log" / day).mkdir(parents=True)
        (tmp_path / "log" / day / "a.txt").write_text(f'1&x&PLAY&{{"songid":"{song}"}}&v&end\n1&x&PLAY&[{{"songid":"9"}}]&v&end\n')
    land_play_table(spark, str(tmp_path / "log" / "*"), str(tmp_path / "out"), str(tmp_path / "ck"), "PLAY").awaitTermination()
    wh = J.Warehouse(spark, str(tmp_path))
    assert sorted((r.data_dt, r.songid) for r in wh.read("out").collect()) == [("20240129", "1"), ("20240130", "2")]
    assert wh.day("out", "20240130").first()["songid"] == "2"


@pytest.mark.parametrize("max_rows", [0, 10])
def test_profiles_with_and_without_the_broadcast(spark, max_rows):
    from encore.plans.users import with_profiles

    seen = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "1")], "uid string, data_dt string")
    users = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), (None, 4)], "uid string, n int")
    got = sorted(map(tuple, with_profiles(seen, users, max_rows).collect()), key=str)
    assert got == sorted([("a", "1", 1), ("a", "1", 2), ("a", "2", 1), ("a", "2", 2), ("b", "1", None), (None, "1", None)], key=str)


def test_broadcast_bounds_rows_and_bytes(spark):
    from encore.operators.joins import broadcast_all_if_small

    small = spark.range(3)
    wide = spark.range(3).select("id", F.lit("x" * 1000).alias("t"))
    many = spark.range(50)

    def hinted(max_rows, max_bytes):
        frames = [wide, small, many]
        return [a is not b for a, b in zip(broadcast_all_if_small(frames, max_rows, max_bytes), frames)]

    assert hinted(100, 1 << 20) == [True, True, True]
    assert hinted(10, 1 << 20) == [True, True, False]
    assert hinted(100, 1000) == [False, True, True]


def test_the_window_has_rows_on_both_sides_of_its_lower_bound(spark):
    from encore.functions.dates import day_minus
    from encore.operators.windows import trailing_windows
    from encore.sources.standins import standin

    plays = standin(spark, SF_CHECK, "plays")
    days = {r[0] for r in plays.select("data_dt").distinct().collect()}
    assert {day_minus("20240130", k) for k in (29, 30, 31)} <= days

    def total(start):
        return plays.where(F.col("data_dt").between(start, "20240130")).count()

    got = trailing_windows(plays, "20240130").agg(F.sum("rct_30_sing_cnt")).first()[0]
    assert total(day_minus("20240130", 29)) < got == total(day_minus("20240130", 30)) < total(day_minus("20240130", 31))


def test_the_day_of_consumption_is_one_pruned_partition(spark):
    from encore.plans.money import consumption_detail
    from encore.sources.standins import standin

    plan = consumption_detail(standin(spark, SF_CHECK, "cnsm"), "20240115")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_dt" in plan


def test_newest_then_fullest_row_of_a_machine(spark):
    from encore.plans.machines import newest_per_machine

    df = spark.createDataFrame([("m", None, "b", "20240101"), ("m", 1, "a", "20240102"), ("m", None, "z", "20240102"), ("n", None, "a", None),
                                ("n", 3, "c", None), ("n", 9, "d", ""), (None, 1, "x", "1")], "mid string, x int, y string, t string")
    got = sorted(map(tuple, newest_per_machine(df, "t").collect()), key=str)
    assert got == sorted([("m", 1, "a", "20240102"), ("n", 9, "d", ""), (None, 1, "x", "1")], key=str)
    assert newest_per_machine(df.drop("t")).where("mid = 'n'").first()[:] == ("n", 9, "d")
