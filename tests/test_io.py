"""Client-log parsing, sinks and the streaming landing job."""

import uuid

from pyspark.sql import functions as F

from encore.plans.client_log import client_log_parse, client_log_records, rejected_lines
from encore.session import scratch_path
from encore.sources import export_jdbc, fanout_by_key, scan_day, write_day

LINES = [
    "1&a&EV&{\"songid\":\"5\",\"uid\":\"9\"}&v&e",          # 6 fields
    "2&a&EV&{\"songid\":\"6\"}&v",                           # 5 fields
    "3&a&EV&{\"songid\":\"7\"}&v&e&x",                       # 7 fields
    "4&a&EV&{\"songid\":\"8\"}&v&e&",                        # trailing empty field: 6
    "5&a&EV&{\"songid\":\"a&b\"}&v&e",                       # '&' inside the JSON: 7 -> dropped
    "6&a&EV&{bad json&v&e",                                  # malformed payload
    "7&a&OTHER&{\"k\":1}&v&e",                               # other event
]


def test_client_log_parse(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = [(r.songid, r.uid, r.mid) for r in client_log_parse(df, "EV").collect()]
    assert sorted(got, key=str) == sorted([("5", "9", None), ("8", None, None)], key=str)
    assert rejected_lines(df, "EV").count() == 1
    rec = {r.event: r.value for r in client_log_records(df, "EV").collect() if r.event != "EV"}
    assert rec == {"OTHER": "{\"k\":1}", "EV_REJECTED": "{bad json"}


def test_write_day_is_idempotent(spark):
    path = scratch_path(spark, "t-day")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write_day(df, path, "20240101")
    write_day(df, path, "20240102")
    write_day(df, path, "20240102")
    back = spark.read.schema("k int, v string, data_dt string").parquet(path)
    assert back.count() == 4
    assert scan_day(back, "20240102").count() == 2


def test_fanout_and_jdbc(spark):
    path = scratch_path(spark, "t-fan")
    df = spark.createDataFrame([("a", "x1"), ("a", "x2"), ("b", "y")], "event string, value string")
    fanout_by_key(df.repartition(3), "event", "value", path)
    back = spark.read.schema("value string, event string").text(path)
    assert sorted((r.event, r.value) for r in back.collect()) == [("a", "x1"), ("a", "x2"), ("b", "y")]
    # bounded files per key: same rows, at most 2 files in each key folder
    import glob
    path2 = scratch_path(spark, "t-fan2")
    many = spark.createDataFrame([("a", f"v{i}") for i in range(200)] + [("b", "y")], "event string, value string")
    fanout_by_key(many.repartition(7), "event", "value", path2, files_per_key=2)
    back2 = spark.read.schema("value string, event string").text(path2)
    assert back2.count() == 201
    local = path2.replace("file:", "")
    assert len([f for f in glob.glob(f"{local}/event=a/part-*")]) <= 2
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    export_jdbc(df, url, "T1", props)
    export_jdbc(df.limit(1), url, "T1", props)       # overwrite replaces the table
    assert spark.read.jdbc(url, "T1", properties=props).count() == 1


def test_stream_landing(spark):
    from encore.streaming import land_client_log

    src = scratch_path(spark, "t-src")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(src)
    out = scratch_path(spark, "t-out")
    ck = scratch_path(spark, "t-ck")
    land_client_log(spark, src, out, checkpoint=ck, event_name="EV").awaitTermination()
    back = spark.read.schema("value string, event string").text(out)
    assert back.where(F.col("event") == "EV").count() == 2
    # a re-run with the same checkpoint finds nothing new
    land_client_log(spark, src, out, checkpoint=ck, event_name="EV").awaitTermination()
    assert spark.read.schema("value string, event string").text(out).count() == back.count()
