"""The daily job runner over a warehouse folder built from the stand-in tables."""

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from encore import jobs as J
from encore.plans.influence import song_influence
from encore.plans.songs import song_dim, song_features
from encore.session import scratch_path
from encore.sources.standins import build_warehouse, standin

DAY, PREV = "20240130", "20240129"


@pytest.fixture(scope="module")
def warehouse(spark):
    root = scratch_path(spark, "warehouse")
    wh = J.Warehouse(spark, root)
    build_warehouse(spark, SF_SMALL, root)
    J.run_day(wh, PREV)
    J.run_day(wh, DAY)
    J.run_day(wh, DAY)          # a rerun replaces the day
    return wh


def test_song_rsi_matches_direct_plan(spark, warehouse):
    got = warehouse.day(J.SONG_RSI, DAY)
    plays = standin(spark, SF_SMALL, "plays").withColumn("song_id", F.col("song_id").cast("string"))
    feats = song_features(plays, song_dim(standin(spark, SF_SMALL, "songs_raw")), DAY)
    want = song_influence(feats)
    norm = lambda df: sorted((r.period, str(r.nbr), round(r.rsi, 9), r.rsi_rank) for r in df.collect())
    assert got.count() > 0
    assert norm(got) == norm(want)


def test_every_daily_table_has_the_day(warehouse):
    for table in (J.SONG_FTUR, J.SINGER_RSI, J.MAC_DIM, J.MAC_LOC, J.CNSM_BRIEF, J.USR_BASE, J.MAC_STAT, J.MRCHNT,
                  J.REGION):
        assert warehouse.day(table, DAY).count() > 0, table
    assert warehouse.read(J.SONG_FTUR).select("data_dt").distinct().count() == 2


def test_client_log_job(spark, warehouse):
    log = scratch_path(spark, "log")
    standin(spark, SF_SMALL, "client_log").select(F.col("line").alias("value")).write.text(log)
    J.job_client_log(warehouse, "20240201", log, "SONG_PLAY", files_per_key=4)
    assert warehouse.day(J.PLAYS, "20240201").count() > 0
    assert not list(Path(urlparse(scratch_path(spark, "x")).path).parent.glob("client-log-*"))      # removed
    fan = spark.read.text(warehouse.path("all_client_tables/20240201"))
    assert set(r.event for r in fan.select("event").distinct().collect()) == {"SONG_PLAY", "SONG_PLAY_REJECTED", "OTHER_EVENT"}


def test_cli_validates_the_date_first():
    with pytest.raises(ValueError):
        J.main(["song_rsi", "2024-01-30", "--warehouse", "/nonexistent"])


def test_missing_day_or_table_means_no_previous_state(spark, warehouse):
    assert J._day_or_none(warehouse, J.SONG_STATE, "20200101") is None        # day never written
    assert J._day_or_none(warehouse, "no_such_table", DAY) is None            # table never written
    assert J._day_or_none(warehouse, J.SONG_STATE, DAY) is not None


def test_consumption_by_day_and_whole(spark, tmp_path):
    wh = J.Warehouse(spark, str(tmp_path))
    cnsm = standin(spark, SF_SMALL, "cnsm")
    cnsm.write.partitionBy("data_dt").parquet(wh.path(J.CNSM))
    J.job_consumption(wh, DAY)
    assert 0 < wh.day(J.CNSM_BRIEF, DAY).count() == cnsm.where(F.col("data_dt") == DAY).count() < cnsm.count()
    J.job_consumption(wh, DAY, full_history=True)
    assert wh.day(J.CNSM_BRIEF, DAY).count() == cnsm.count()


def test_location_job_with_a_geocoder(spark, warehouse, tmp_path):
    from encore.registry.ops import fake_geocoder

    wh = J.Warehouse(spark, str(tmp_path))
    warehouse.read(J.LOC_REPORTS).write.partitionBy("data_dt").parquet(wh.path(J.LOC_REPORTS))
    J.job_machine_location(wh, DAY, geocoder=fake_geocoder, batch_size=3)
    got = wh.day(J.MAC_LOC, DAY)
    assert got.count() and got.where(~F.col("addr").startswith("near ")).count() == 0
    assert J._named("encore.registry.ops:fake_geocoder") is fake_geocoder


def test_mart_export(spark, warehouse):
    """Into Derby inside this JVM: no server, no port."""
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    url = "jdbc:derby:memory:encore_marts;create=true"
    wh = J.Warehouse(spark, warehouse.root, url, driver)
    J.job_singer_rsi(wh, DAY)
    back = spark.read.jdbc(url, J.EXPORTS["singer_rsi"], properties=driver)
    want = warehouse.day(J.SINGER_RSI, DAY).where(F.col("rsi_rank") <= 30)
    assert back.count() == want.count() > 0
    assert {r[0] for r in back.select("data_dt").collect()} == {DAY}
