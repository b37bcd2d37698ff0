"""Registered queries of the warehouse mechanisms: bitmap states, dyadic partials, the change
ledger, versioned snapshots, catalog tables, bucketed profiles, archives of logs, staged export,
the response ledger, streams of records that count once.  Each runs the mechanism over the
driver's tables and returns what a reader sees afterwards."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import jobs as J
from encore.functions.dates import day_minus
from encore.functions.text import join_ints
from encore.operators.bitmaps import bitmap_state, dense_ids, windows_from_bitmaps
from encore.plans.influence import singer_features
from encore.plans.client_log import PLAY_FIELDS
from encore.plans.location import ADDRESS_FIELDS, location_votes, lookup_enricher, machine_location, top_location, votes_from_state
from encore.plans.songs import SONG_DIM_COLUMNS, features_from_windows, song_dim, song_features
from encore.plans.users import active_users_bucketed, store_profiles
from encore.registry.common import D1, DAY, S, Registry, sql_with
from encore.registry.dims import _DIM_SQL_COLS
from encore.registry.ops import (LOC_T, LONG_CTES, LONG_DAYS, SQL_ACTIVE, SQL_UU, USER_T, _SERVICE_FIELDS, fake_geocoder, sql_location,
                                 users_union)
from encore.registry.songs import FEATURE_CTES, INFLUENCE_CTES, features
from encore.registry.io import PLAY, SQL_IS_OBJ, SQL_REC
from encore.session import scratch_path
from encore.sources.catalog import use_database, write_day_table
from encore.sources.export import export_staged
from encore.sources.responses import Limits, ledger_enricher
from encore.sources.scans import scan_table
from encore.sources.tar_log import scan_tar_log, write_tar_log
from encore.sources.versions import publish_snapshot, read_snapshot
from encore.streaming.plays_once import land_plays_once, latest_windows, stream_song_windows

R = Registry()
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


# ---------------------------------------------------------------- bitmaps


def _features_bitmap(spark: SparkSession, d: str) -> DataFrame:
    """Song features from one bitmap row per (song, day, bucket), stored by day and read back."""
    plays, path = S(spark, d, "plays"), scratch_path(spark, "song-bitmaps")
    users, orders = (dense_ids(plays.select(c), f"{path}/ids-{c}") for c in ("uid", "order_id"))
    state = bitmap_state(plays, users, orders, day_minus(DAY, 30), DAY)
    state.write.partitionBy("data_dt").parquet(f"{path}/days")
    stored = spark.read.schema(state.schema).parquet(f"{path}/days")
    return features_from_windows(windows_from_bitmaps(stored, DAY, out_key="nbr"), S(spark, d, "songs"))


R.add("song_features_bitmap", sql_with(["plays", "songs"], f", {FEATURE_CTES} SELECT * FROM feat"))(_features_bitmap)


# ---------------------------------------------------------------- dyadic partials


def _locations_dyadic(spark: SparkSession, d: str) -> DataFrame:
    """The 700-day locations of two days from the nodes of one tree."""
    reports = S(spark, d, "loc_reports")
    tree = J.location_tree(spark, scratch_path(spark, "loc-tree"), reports)
    enrich, out = lookup_enricher(S(spark, d, "loc_lookup")), None
    for day in (D1, DAY):
        tree.refresh(day_minus(day, LONG_DAYS), day)
        votes = votes_from_state(tree.window(day_minus(day, LONG_DAYS), day))
        out = machine_location(reports, out, day, enrich, LONG_DAYS, votes=votes)
    return out


R.add("machine_location_dyadic", sql_with(LOC_T, f", {LONG_CTES} SELECT * FROM lloc"))(_locations_dyadic)


# ---------------------------------------------------------------- change ledger

CORRECTED = day_minus(DAY, 12)  # a past day of the play log that is rewritten after the first run


def _ledger_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Features of the day, made, then one past day of the log rewritten without a word to the
    job, then the job again: it has to notice the day by its files."""
    wh = J.Warehouse(spark, scratch_path(spark, "ledger"))
    plays = S(spark, d, "plays").select(F.col("song_id").cast("string").alias("songid"), "uid", "order_id", "data_dt")
    plays.where(F.col("data_dt").between(day_minus(DAY, 30), DAY)).write.partitionBy("data_dt").parquet(wh.path(J.PLAYS))
    songs = S(spark, d, "songs")
    songs.write.parquet(wh.path(J.SONG_DIM))
    J.job_song_features(wh, DAY)
    fewer = plays.where((F.col("data_dt") == CORRECTED) & (F.col("uid") % 3 != 0)).drop("data_dt")
    fewer.write.mode("overwrite").parquet(f"{wh.path(J.PLAYS)}/data_dt={CORRECTED}")
    J.job_song_features(wh, DAY)
    return wh.day(J.SONG_FTUR, DAY).withColumn("nbr", F.col("nbr").cast("bigint"))


R.add("ledger_refresh", sql_with(["plays", "songs"], f""",
    corrected AS (SELECT * FROM plays WHERE NOT (data_dt = '{CORRECTED}' AND uid % 3 = 0)),
    {FEATURE_CTES.replace("FROM plays", "FROM corrected")} SELECT * FROM feat"""))(_ledger_refresh)


# ---------------------------------------------------------------- versioned snapshots (K4, U4)


def _fails(value) -> bool:
    raise RuntimeError("a task that dies while the snapshot is written")


def _snapshot_swap(spark: SparkSession, d: str) -> DataFrame:
    """Two published versions of the song dimension and a third whose write fails half way."""
    path = scratch_path(spark, "song-dim-versions")
    dim = song_dim(S(spark, d, "songs_raw"))
    publish_snapshot(dim.where(F.col("nbr") < "5"), path)
    publish_snapshot(dim, path)
    failing = F.udf(_fails, "boolean")
    half = read_snapshot(spark, path).where((F.col("nbr") < "5") | failing("nbr"))
    try:
        publish_snapshot(half, path)
    except Exception as e:  # noqa: BLE001 - Spark wraps the task's error by its own classes
        if "a task that dies" not in str(e):
            raise
    return read_snapshot(spark, path).withColumn("prdct_type", join_ints("prdct_type"))


R.add("snapshot_swap", sql_with(["songs_raw"], "SELECT " + ", ".join(
    f"{_DIM_SQL_COLS.get(c, c)} AS {c}" for c in SONG_DIM_COLUMNS) + " FROM songs_raw WHERE nbr <> ''"))(_snapshot_swap)


# ---------------------------------------------------------------- catalog tables


def _write_day_table(spark: SparkSession, d: str) -> DataFrame:
    """Two days of features in a table of the catalog, one of them written twice, read by name
    from the current database, which is the one before again afterwards."""
    before = spark.catalog.currentDatabase()
    database = f"encore_{uuid.uuid4().hex[:10]}"
    use_database(spark, database, scratch_path(spark, database))
    try:
        plays, songs = S(spark, d, "plays"), S(spark, d, "songs")
        write_day_table(song_features(plays, songs, D1), "song_features", D1)
        for _ in range(2):
            write_day_table(song_features(plays, songs, DAY), "song_features", DAY)
        return scan_table(spark, "song_features").where(F.col("data_dt") == DAY).drop("data_dt")
    finally:
        spark.catalog.setCurrentDatabase(before)


R.add("write_day_table", sql_with(["plays", "songs"], f", {FEATURE_CTES} SELECT * FROM feat"))(_write_day_table)


# ---------------------------------------------------------------- staged export (K6)


def _export_staged(spark: SparkSession, d: str) -> DataFrame:
    """Singer features of two days in one mart (Derby inside this JVM: no port, seen only by this
    process); the second day is exported twice, then once more by a load that fails."""
    url = f"jdbc:derby:memory:encore_{uuid.uuid4().hex[:10]};create=true"
    df = singer_features(features(spark, d))
    days = {day: df.select(F.lit(day).alias("data_dt"), "*") for day in (D1, DAY)}
    for day in (D1, DAY, DAY):
        export_staged(days[day], url, "TM_SINGER_STAGED", DERBY, "data_dt")
    failing = F.udf(_fails, "boolean")
    first = df.columns[0]
    try:
        export_staged(days[DAY].where(failing(first)), url, "TM_SINGER_STAGED", DERBY, "data_dt")
    except Exception as e:  # noqa: BLE001
        if "a task that dies" not in str(e):
            raise
    back = spark.read.jdbc(url, "TM_SINGER_STAGED", properties=DERBY)
    return back.toDF(*[c.lower() for c in back.columns])


R.add("export_staged", sql_with(["plays", "songs"], f""", {INFLUENCE_CTES}
    SELECT '{D1}' AS data_dt, * FROM singer UNION ALL SELECT '{DAY}' AS data_dt, * FROM singer"""))(_export_staged)


# ---------------------------------------------------------------- bucketed profiles

PROFILE_BUCKETS = 16


def _active_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The day's users against profiles that are stored bucketed by uid."""
    before = spark.catalog.currentDatabase()
    database = f"encore_{uuid.uuid4().hex[:10]}"
    use_database(spark, database, scratch_path(spark, database))
    try:
        store_profiles(users_union(spark, d), "profiles", PROFILE_BUCKETS)
        return active_users_bucketed(S(spark, d, "logins"), scan_table(spark, "profiles"), DAY)
    finally:
        spark.catalog.setCurrentDatabase(before)


R.add("active_users_bucketed", sql_with(USER_T, f", {SQL_UU}, {SQL_ACTIVE} SELECT * FROM active"))(_active_bucketed)


# ---------------------------------------------------------------- archives of logs


def _scan_tar(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "log-tar")
    write_tar_log(S(spark, d, "client_log").select(F.col("line").alias("value")), path, 2000)
    return scan_tar_log(spark, path).select("value")


R.add("scan_tar_log", sql_with(["client_log"], "SELECT line AS value FROM client_log"))(_scan_tar)


# ---------------------------------------------------------------- response ledger


def _patient_geocoder(location: str) -> str:
    """The stand-in service, which also answers a batch of one position."""
    import json

    if "|" in location:
        return fake_geocoder(location)
    both = json.loads(fake_geocoder(f"{location}|{location}"))
    return json.dumps(both | {"regeocodes": both["regeocodes"][:1]})


def _geocode_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Top locations of two days: the second run asks for positions that the first did not."""
    reports = S(spark, d, "loc_reports")
    enrich = ledger_enricher(_patient_geocoder, scratch_path(spark, "geo-ledger"), Limits(batch_size=7, batches_per_commit=1000))
    enrich(top_location(location_votes(reports, D1)))
    return enrich(top_location(location_votes(reports, DAY)))


R.add("geocode_ledger", sql_with(LOC_T, f""", {sql_location('d', DAY)}
    SELECT r.mid, r.x, r.y, r.cnt, {', '.join(f"{_SERVICE_FIELDS.get(c, "''")} AS {c}" for c in ADDRESS_FIELDS)} FROM d_top r"""))(_geocode_ledger)


# ---------------------------------------------------------------- records that count once


def _replayed_log(spark: SparkSession, d: str) -> str:
    """The client log as files, and some of its lines once more in further files."""
    path = scratch_path(spark, "replayed-log")
    lines = S(spark, d, "client_log").select(F.col("line").alias("value"))
    lines.write.text(f"{path}/first")
    lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == 0).write.text(f"{path}/again")
    return f"{path}/*"


def _stream_once(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "plays-once")
    land_plays_once(spark, _replayed_log(spark, d), out, DAY, scratch_path(spark, "plays-once-ckpt"), PLAY).awaitTermination()
    return spark.read.schema(", ".join(f"{f} string" for f in [*PLAY_FIELDS, "data_dt"])).parquet(out)


_SQL_DAY = f"CASE WHEN regexp_matches(json_extract_string(p[4], '$.play_time'), '^[0-9]{{8}}') THEN substr(json_extract_string(p[4], '$.play_time'), 1, 8) ELSE '{DAY}' END"
_SQL_ONCE = (f", {SQL_REC}, once AS MATERIALIZED (SELECT " + ", ".join(f"json_extract_string(p[4], '$.{f}') AS {f}" for f in PLAY_FIELDS)
             + f", {_SQL_DAY} AS data_dt FROM rec WHERE len(p) = 6 AND p[3] = '{PLAY}' AND {SQL_IS_OBJ})")

R.add("client_log_stream_once", sql_with(["client_log"], f"{_SQL_ONCE} SELECT * FROM once"))(_stream_once)


def _song_windows_stream(spark: SparkSession, d: str) -> DataFrame:
    out = scratch_path(spark, "song-windows")
    stream_song_windows(spark, _replayed_log(spark, d), out, DAY, scratch_path(spark, "song-windows-ckpt"), PLAY).awaitTermination()
    return latest_windows(spark.read.schema("songid string, plays long, sing_cnt long, rct_7_sing_cnt long, rct_30_sing_cnt long").parquet(out))


R.add("song_windows_stream", sql_with(["client_log"], f"""{_SQL_ONCE} SELECT songid, count(*) AS plays,
    count(*) FILTER (WHERE data_dt = '{DAY}') AS sing_cnt,
    count(*) FILTER (WHERE data_dt BETWEEN '{day_minus(DAY, 7)}' AND '{DAY}') AS rct_7_sing_cnt,
    count(*) FILTER (WHERE data_dt BETWEEN '{day_minus(DAY, 30)}' AND '{DAY}') AS rct_30_sing_cnt
    FROM once WHERE songid IS NOT NULL GROUP BY songid"""))(_song_windows_stream)
