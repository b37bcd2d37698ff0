"""Registered queries: client-log parsing (J1), text scan, sinks (fan-out, day partition,
snapshot, JDBC), the batched Python hook and the streaming landing job.

Sink queries write to a fresh folder under the shared checkpoint folder and return what a
reader sees afterwards, so the check covers the round trip."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from encore.operators.batches import map_in_batches
from encore.plans.client_log import PLAY_FIELDS, client_log_parse, client_log_records
from encore.plans.influence import singer_features
from encore.plans.location import location_votes, top_location
from encore.plans.songs import song_dim, song_features
from encore.functions.text import join_ints
from encore.registry.common import D1, DAY, S, Registry, sql_with
from encore.registry.songs import FEATURE_CTES, INFLUENCE_CTES, features
from encore.registry.dims import _DIM_SQL_COLS
from encore.plans.songs import SONG_DIM_COLUMNS
from encore.session import scratch_path
from encore.sources.scans import scan_day, scan_text_log
from encore.sources.sinks import export_jdbc, fanout_by_key, write_day, write_snapshot
from encore.streaming.client_log_stream import land_client_log, land_play_table

R = Registry()

PLAY = "SONG_PLAY"   # play event name used by the stand-in log

SQL_REC = "rec AS (SELECT string_split(regexp_replace(line, '&+$', ''), '&') AS p FROM client_log)"
SQL_IS_OBJ = "(CASE WHEN json_valid(p[4]) THEN json_type(p[4]) = 'OBJECT' END)"


def _lines(spark, d):
    return S(spark, d, "client_log")


R.add("client_log_parse", sql_with(["client_log"], f", {SQL_REC} SELECT "
                                   + ", ".join(f"json_extract_string(p[4], '$.{f}') AS {f}" for f in PLAY_FIELDS)
                                   + f" FROM rec WHERE len(p) = 6 AND p[3] = '{PLAY}' AND {SQL_IS_OBJ}"))(
    lambda spark, d: client_log_parse(_lines(spark, d), PLAY, value_col="line"))

SQL_GOOD_PLAY = f"(p[3] = '{PLAY}' AND coalesce({SQL_IS_OBJ}, false))"
SQL_RECORDS = (f", {SQL_REC} SELECT CASE WHEN p[3] = '{PLAY}' AND NOT {SQL_GOOD_PLAY} THEN p[3] || '_REJECTED' "
               f"ELSE p[3] END AS event, CASE WHEN {SQL_GOOD_PLAY} THEN concat_ws(chr(9), "
               + ", ".join(f"coalesce(json_extract_string(p[4], '$.{f}'), '\\N')" for f in PLAY_FIELDS)
               + ") ELSE p[4] END AS value FROM rec WHERE len(p) = 6")


def _write_log_text(spark, d, name):
    path = scratch_path(spark, name)
    _lines(spark, d).select(F.col("line").alias("value")).write.mode("overwrite").text(path)
    return path


def _scan_text(spark, d):
    return scan_text_log(spark, _write_log_text(spark, d, "log-text"))


R.add("scan_text_log", sql_with(["client_log"], "SELECT line AS value FROM client_log"))(_scan_text)


def _fanout(spark, d):
    path = scratch_path(spark, "fanout")
    fanout_by_key(client_log_records(_lines(spark, d), PLAY, value_col="line"), "event", "value", path)
    return spark.read.schema("value string, event string").text(path).select("event", "value")


R.add("fanout_by_key", sql_with(["client_log"], SQL_RECORDS))(_fanout)


def _stream(spark, d):
    src = _write_log_text(spark, d, "stream-src")
    out = scratch_path(spark, "stream-out")
    q = land_client_log(spark, src, out, checkpoint=scratch_path(spark, "stream-ckpt"), event_name=PLAY)
    q.awaitTermination()
    return spark.read.schema("value string, event string").text(out).select("event", "value")


R.add("client_log_stream", sql_with(["client_log"], SQL_RECORDS))(_stream)


def _stream_table(spark, d):
    src = _write_log_text(spark, d, "stream-src")
    out = scratch_path(spark, "stream-table")
    land_play_table(spark, src, out, checkpoint=scratch_path(spark, "stream-table-ckpt"), event_name=PLAY,
                    day=DAY).awaitTermination()
    return spark.read.schema(", ".join(f"{f} string" for f in [*PLAY_FIELDS, "data_dt"])).parquet(out)


R.add("client_log_stream_table", sql_with(["client_log"], f", {SQL_REC} SELECT "
                                          + ", ".join(f"json_extract_string(p[4], '$.{f}') AS {f}" for f in PLAY_FIELDS) + f", '{DAY}' AS data_dt"
                                          + f" FROM rec WHERE len(p) = 6 AND p[3] = '{PLAY}' AND {SQL_IS_OBJ}"))(_stream_table)


def _write_day(spark, d):
    path = scratch_path(spark, "song-features")
    plays, songs = S(spark, d, "plays"), S(spark, d, "songs")
    write_day(song_features(plays, songs, D1), path, D1)
    feats = song_features(plays, songs, DAY)
    write_day(feats, path, DAY)
    write_day(feats, path, DAY)          # a rerun replaces the day, it does not append
    schema = feats.schema.add("data_dt", "string")
    return scan_day(spark.read.schema(schema).parquet(path), DAY).drop("data_dt")


R.add("write_day", sql_with(["plays", "songs"], f", {FEATURE_CTES} SELECT * FROM feat"))(_write_day)


def _write_snapshot(spark, d):
    path = scratch_path(spark, "song-dim")
    dim = song_dim(S(spark, d, "songs_raw"))
    write_snapshot(dim, path)
    write_snapshot(dim, path)
    return spark.read.schema(dim.schema).parquet(path).withColumn("prdct_type", join_ints("prdct_type"))


R.add("write_snapshot", sql_with(["songs_raw"], "SELECT " + ", ".join(
    f"{_DIM_SQL_COLS.get(c, c)} AS {c}" for c in SONG_DIM_COLUMNS) + " FROM songs_raw WHERE nbr <> ''"))(_write_snapshot)


def _export(spark, d):
    """Export to an embedded in-memory Derby database (inside this JVM; it opens no port
    and only this process sees it) and read the table back over JDBC."""
    url = f"jdbc:derby:memory:encore_{uuid.uuid4().hex[:10]};create=true"
    df = singer_features(features(spark, d))
    export_jdbc(df, url, "TM_SINGER_FEATURES", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    back = spark.read.jdbc(url, "TM_SINGER_FEATURES", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    return back.toDF(*[c.lower() for c in back.columns])


R.add("export_jdbc", sql_with(["plays", "songs"], f", {INFLUENCE_CTES} SELECT * FROM singer"))(_export)


def _slice_requests(pdf: pd.DataFrame) -> pd.DataFrame:
    """Caller-side batch function: one request string per slice, answered per row."""
    request = "|".join(pdf["y"] + "," + pdf["x"])
    return pd.DataFrame({"mid": pdf["mid"], "location": pdf["y"] + "," + pdf["x"],
                         "in_request": [f"{y},{x}" in request.split("|") for x, y in zip(pdf["x"], pdf["y"])],
                         "slice_ok": len(pdf) <= 4})


R.add("map_in_batches", sql_with(["loc_reports"], f""", d_votes AS (SELECT mid, lat AS x, lng AS y, count(*) AS cnt
    FROM (SELECT DISTINCT uid, mid, lat, lng FROM loc_reports WHERE data_dt BETWEEN '20231231' AND '{DAY}') t
    GROUP BY mid, lat, lng),
    d_top AS (SELECT mid, x, y FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY cnt DESC, x, y) AS rk
        FROM d_votes) v WHERE rk = 1 AND x <> '' AND y <> '')
    SELECT mid, y || ',' || x AS location, true AS in_request, true AS slice_ok FROM d_top"""))(
    lambda spark, d: map_in_batches(top_location(location_votes(S(spark, d, "loc_reports"), DAY)),
                                    _slice_requests, "mid long, location string, in_request boolean, slice_ok boolean",
                                    batch_size=4))
