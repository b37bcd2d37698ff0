"""Warehouse mechanisms: versions, ledger, dyadic tree, bitmaps, catalog, export, tar, responses, streams."""

import io
import random
import tarfile
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from encore import jobs as J
from encore.functions.dates import day_minus
from encore.operators import dyadic
from encore.operators.bitmaps import bitmap_state, dense_ids, windows_from_bitmaps
from encore.operators.windows import trailing_windows
from encore.plans.location import location_state
from encore.plans.users import USER_COLUMNS, active_users, active_users_bucketed, store_profiles
from encore.session import scratch_path
from encore.sources import versions
from encore.sources.catalog import table_days, use_database, write_day_table
from encore.sources.export import export_staged
from encore.sources.ledger import Ledger, affected_days, day_signatures
from encore.sources.responses import Limits, ask, ledger_enricher, read_ledger
from encore.sources.tar_log import scan_tar_log, write_tar_log

DAY = "20240130"


def ints(df):
    return sorted(r[0] for r in df.collect())


# ---------------------------------------------------------------- snapshots


def dying():
    """A column function that fails at 7 (made inside, so that it travels by value)."""
    def boom(x):
        if x == 7:
            raise RuntimeError("task died")
        return x

    return F.udf(boom, "long")


def test_a_failed_write_leaves_the_snapshot_before(spark):
    path = scratch_path(spark, "t-versions")
    assert versions.version_path(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.read_snapshot(spark, path)
    assert versions.publish_snapshot(spark.range(3), path) == 1
    with pytest.raises(Exception, match="task died"):
        versions.publish_snapshot(spark.range(0, 20, 1, 4).select(dying()("id").alias("id")), path)
    assert ints(versions.read_snapshot(spark, path)) == [0, 1, 2]
    own = versions.read_snapshot(spark, path)  # a version made from the one it follows
    assert versions.publish_snapshot(own.union(own), path) == 2
    assert ints(versions.read_snapshot(spark, path)) == [0, 0, 1, 1, 2, 2]
    assert ints(versions.read_snapshot(spark, path, 1)) == [0, 1, 2]


def test_two_writers_and_old_versions(spark):
    path = scratch_path(spark, "t-versions")
    versions.publish_snapshot(spark.range(1), path, expected=0)
    with pytest.raises(versions.VersionConflict):
        versions.publish_snapshot(spark.range(9), path, expected=0)
    assert ints(versions.read_snapshot(spark, path)) == [0]
    for n in (2, 3, 4):
        versions.publish_snapshot(spark.range(n), path, keep=2)
    assert versions.versions(spark, path) == [3, 4]
    folders = [n for n, _ in versions._listed(spark, path) if n.startswith("v-")]
    assert len(folders) == 3  # two versions, and the folder of the writer that lost, which is young
    assert len(versions.collect_versions(spark, path, orphan_seconds=-1)) == 1
    assert ints(versions.read_table(spark, path)) == [0, 1, 2, 3]


# ---------------------------------------------------------------- ledger


def play_rows(spark, wh, days):
    rows = [(f"s{k % 3}", f"u{k % 5}", f"o{k}", d) for d in days for k in range(8)]
    spark.createDataFrame(rows, "songid string, uid string, order_id string, data_dt string").write.mode("overwrite").partitionBy("data_dt").parquet(wh.path(J.PLAYS))
    dim = [(f"s{k}", *["x"] * 6, 1, *["y"] * 4, 0) for k in range(3)]
    names = "nbr name source album prdct lang video_format".split()
    spark.createDataFrame(dim, ", ".join(f"{n} string" for n in names) + ", dur int, singer1 string, singer2 string, singer1id string, singer2id string, mac_time int"
                          ).write.mode("overwrite").parquet(wh.path(J.SONG_DIM))


@pytest.mark.parametrize("bitmaps", [False, True])
def test_a_rewritten_day_is_noticed(spark, bitmaps):
    """No flag, no word: the features of the day are those of the files as they are now."""
    wh = J.Warehouse(spark, scratch_path(spark, "t-ledger"))
    days = [day_minus(DAY, k) for k in range(4)]
    play_rows(spark, wh, days)

    def total():
        J.job_song_features(wh, DAY, bitmaps=bitmaps)
        return wh.day(J.SONG_FTUR, DAY).agg(F.sum("rct_7_sing_cnt"), F.sum("rct_7_ordr_cnt")).first()[:]

    first = total()
    assert first == (32, 8)
    assert total() == first  # nothing changed, nothing lost
    consumer = J.SONG_BITS if bitmaps else J.SONG_STATE
    assert J._changed(wh, consumer, J.PLAYS, days)[0] == []
    one = spark.createDataFrame([("s0", "u0", "o0")], "songid string, uid string, order_id string")
    one.write.mode("overwrite").parquet(f"{wh.path(J.PLAYS)}/data_dt={days[2]}")
    assert J._changed(wh, consumer, J.PLAYS, days)[0] == [days[2]]
    assert total()[0] == 25
    one.write.mode("append").parquet(f"{wh.path(J.PLAYS)}/data_dt={days[3]}")  # a late file beside the others
    assert total()[0] == 26
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{wh.path(J.PLAYS)}/data_dt={days[1]}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # a day that is gone
    assert total()[0] == 18


def test_refresh_makes_the_results_that_rest_on_a_changed_day(spark):
    wh = J.Warehouse(spark, scratch_path(spark, "t-refresh"))
    days = [day_minus(DAY, k) for k in range(3, -1, -1)]
    play_rows(spark, wh, days)
    for d in days:
        J.job_song_features(wh, d)
    assert J.job_refresh(wh, DAY) == []
    spark.createDataFrame([("s0", "u0", "o0")], "songid string, uid string, order_id string").write.mode("overwrite").parquet(f"{wh.path(J.PLAYS)}/data_dt={days[2]}")
    assert J.job_refresh(wh, DAY) == days[2:]
    assert wh.day(J.SONG_FTUR, DAY).agg(F.sum("rct_7_sing_cnt")).first()[0] == 25
    assert J.job_refresh(wh, DAY) == []


def test_ledger_folds_its_appends(spark):
    ledger = Ledger(spark, scratch_path(spark, "t-fold"), fold_after=3)
    for k in range(9):
        ledger.record("c", "s", {"20240101": f"sig{k}", f"2024010{k + 1}": "x" if k else f"sig{k}"})
    assert ledger.built_from("c", "s", ["20240101", "20240105"]) == {"20240101": "sig8", "20240105": "x"}
    assert affected_days(["20240101"], "20240103", 30) == ["20240101", "20240102", "20240103"]
    assert day_signatures(spark, scratch_path(spark, "nothing"), ["20240101"]) == {"20240101": "none"}


# ---------------------------------------------------------------- dyadic partials


def test_covers_of_random_windows():
    rng = random.Random(4)
    for _ in range(300):
        start = date(2020, 1, 1) + timedelta(days=rng.randrange(2000))
        n = rng.randrange(1, 800)
        a, b = (d.strftime("%Y%m%d") for d in (start, start + timedelta(days=n - 1)))
        nodes = dyadic.cover(a, b)
        days = [s + k for level, s in nodes for k in range(1 << level)]
        assert days == list(range(dyadic.day_number(a), dyadic.day_number(b) + 1))
        assert all(s % (1 << level) == 0 for level, s in nodes)
        assert len(nodes) <= max(1, 2 * n.bit_length())


def test_tree_windows_equal_the_scan_and_a_corrected_day_costs_its_ancestors(spark):
    rng = random.Random(9)
    days = [day_minus(DAY, k) for k in range(70)]
    rows = [(f"u{rng.randrange(9)}", f"m{rng.randrange(4)}", str(rng.randrange(3)), "1", rng.choice(days)) for _ in range(600)]
    schema = "uid string, mid string, lat string, lng string, data_dt string"
    path = scratch_path(spark, "t-tree")

    def same(reports, tree, n, end):
        a = day_minus(end, n)
        want = location_state(reports, a, end).collect()
        return sorted(tuple(r) for r in tree.window(a, end).collect()) == sorted(tuple(r) for r in want)

    reports = spark.createDataFrame(rows, schema)
    tree = J.location_tree(spark, path, reports)
    with pytest.raises(LookupError):
        tree.window(DAY, DAY)
    assert len(tree.refresh(day_minus(DAY, 63), DAY)) > 64
    assert same(reports, tree, 63, DAY) and tree.refresh(day_minus(DAY, 63), DAY) == []
    for n, end in ((5, day_minus(DAY, 9)), (40, day_minus(DAY, 3)), (69, DAY)):
        tree.refresh(day_minus(end, n), end)
        assert same(reports, tree, n, end)
    fixed = spark.createDataFrame([r for r in rows if r[4] != days[30]] + [("new", "m0", "9", "9", days[30])], schema)
    tree = J.location_tree(spark, path, fixed)
    before = tree.stored()
    built = tree.refresh(day_minus(DAY, 69), DAY, [days[30]])
    top = max(k for k, _ in before)
    assert 0 < len(built) <= top + 1 and set(built) <= set(dyadic.ancestors(days[30], top))
    assert same(fixed, tree, 69, DAY)
    tree.refresh(day_minus(DAY, 33), DAY)
    assert same(fixed, tree, 33, DAY)


# ---------------------------------------------------------------- bitmaps


def test_bitmap_windows_equal_the_rows(spark):
    """Nulls, a user in a third of all plays, ids past one bucket."""
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, None, *range(2, 40)]) if k % 3 else 1, rng.choice([None, k, k // 2]), day_minus(DAY, rng.randrange(35))) for k in range(900)]
    plays = spark.createDataFrame(rows, "song_id string, uid long, order_id long, data_dt string")
    path = scratch_path(spark, "t-ids")
    spark.range(40_000).select((F.col("id") + 10**6).alias("value"), "id").write.parquet(f"{path}/orders")  # so that new ids start in bucket 2
    users, orders = dense_ids(plays.select("uid"), f"{path}/users"), dense_ids(plays.select("order_id"), f"{path}/orders")
    again = dense_ids(plays.select("uid"), f"{path}/users")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, users.collect())) and users.select("id").distinct().count() == 39
    assert sorted(r.id for r in users.collect()) == list(range(39))
    state = bitmap_state(plays, users, orders, day_minus(DAY, 30), DAY)
    assert state.where("bucket > 1").count() > 0
    want, got = trailing_windows(plays, DAY), windows_from_bitmaps(state, DAY)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_bitmap_state_is_no_larger_than_its_pairs(spark):
    """Orders all over the id table: a row of a few numbers holds a few bytes, not a whole bucket."""
    plays = spark.range(0, 4000).select((F.col("id") % 50).alias("song_id"), (F.col("id") % 7).alias("uid"), (F.col("id") * 7919 % 4000).alias("order_id"), F.lit(DAY).alias("data_dt"))
    path = scratch_path(spark, "t-sparse")
    spark.range(4000).select(F.col("id").alias("value"), (F.col("id") * 40_000 + 63).alias("id")).write.parquet(f"{path}/orders")
    users, orders = dense_ids(plays.select("uid"), f"{path}/users"), dense_ids(plays.select("order_id"), f"{path}/orders")
    state = bitmap_state(plays, users, orders, DAY, DAY)
    kind = dict(state.dtypes)["bits"]
    held = state.agg(F.sum(F.octet_length("bits") if kind == "binary" else F.lit(8)), F.count("*")).first()
    assert held[0] <= 8 * (4000 + 350) and held[1] <= 4000 + 350
    want, got = trailing_windows(plays, DAY), windows_from_bitmaps(state, DAY)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


# ---------------------------------------------------------------- catalog


def test_daily_run_over_catalog_tables(spark):
    database = f"t_{uuid.uuid4().hex[:8]}"
    before = spark.catalog.currentDatabase()
    try:
        wh = J.CatalogWarehouse(spark, database, scratch_path(spark, database))
        assert spark.catalog.currentDatabase() == database
        plays = spark.createDataFrame([(f"s{k % 3}", *[None] * 2, f"u{k % 5}", *[None] * 6, f"o{k}") for k in range(9)],
                                      "songid string, mid string, optrate_type string, uid string, consume_type string, play_time string, dur_time string, "
                                      "session_id string, songname string, pkg_id string, order_id string")
        for d in (day_minus(DAY, 1), DAY):
            wh.write_day(plays, J.PLAYS, d)
        dim = spark.createDataFrame([(f"s{k}", *["x"] * 6, 1, *["y"] * 4, 0) for k in range(3)],
                                    "nbr string, name string, source string, album string, prdct string, lang string, video_format string, dur int, "
                                    "singer1 string, singer2 string, singer1id string, singer2id string, mac_time int")
        for _ in range(2):
            wh.write_whole(dim, J.SONG_DIM)
        for _ in range(2):
            J.job_song_features(wh, DAY)
            J.job_song_rsi(wh, DAY)
        assert wh.day(J.SONG_FTUR, DAY).agg(F.sum("sing_cnt"), F.sum("rct_7_sing_cnt")).first()[:] == (9, 18)
        assert table_days(spark, f"{database}.{J.SONG_RSI}") == {DAY}
        assert spark.table(f"{database}.{J.SONG_DIM}").count() == 3
        with pytest.raises(ValueError, match="declares"):
            write_day_table(plays.drop("pkg_id"), f"{database}.{J.PLAYS}", DAY)
        write_day_table(plays.limit(0), f"{database}.{J.PLAYS}", DAY)
        assert wh.read(J.PLAYS).count() == 9  # the day is empty now, the other one stays
    finally:
        spark.catalog.setCurrentDatabase(before)


# ---------------------------------------------------------------- bucketed profiles


def test_profiles_are_joined_where_they_lie(spark):
    database, before = f"t_{uuid.uuid4().hex[:8]}", spark.catalog.currentDatabase()
    use_database(spark, database, scratch_path(spark, database))
    try:
        users = spark.createDataFrame([tuple(f"{c}{k}" if c != "uid" else str(k) for c in USER_COLUMNS) for k in range(400)] , ", ".join(f"{c} string" for c in USER_COLUMNS))
        logins = spark.createDataFrame([(str(k % 500), DAY if k % 2 else "20240101") for k in range(900)], "uid string, data_dt string")
        for _ in range(4):
            store_profiles(users, "profiles", 16)
        assert len([t for t in spark.catalog.listTables(database) if t.name.startswith("profiles_b")]) == 2
        df = active_users_bucketed(logins, spark.table("profiles"), DAY)
        want = active_users(logins, users, DAY)
        assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin"):]
        scan = next(k for k, line in enumerate(join.splitlines()) if "FileScan" in line and "profiles" in line.lower())
        depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
        lines, at, above = join.splitlines(), scan, []
        while at >= 0 and "SortMergeJoin" not in lines[at]:
            if depth(lines[at]) < depth(lines[scan]) or at == scan:
                above.append(lines[at])
            at = next((j for j in range(at - 1, -1, -1) if depth(lines[j]) < depth(lines[at])), -1)
        assert above and not any("Exchange" in line for line in above)
        assert "Bucketed: true" in lines[scan]
    finally:
        spark.catalog.setCurrentDatabase(before)


# ---------------------------------------------------------------- export

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_a_failed_export_leaves_the_mart(spark):
    """Derby inside this JVM: no server, no port."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"

    def day(d, ids):
        return spark.range(0, ids, 1, 4).select(F.lit(d).alias("data_dt"), F.col("id").alias("k"))

    def mart():
        return sorted((r[0], r[1]) for r in spark.read.jdbc(url, "MART", properties=DERBY).collect())

    assert export_staged(day("20240101", 3), url, "MART", DERBY, "data_dt") == 3
    export_staged(day("20240102", 4), url, "MART", DERBY, "data_dt")
    export_staged(day("20240102", 2), url, "MART", DERBY, "data_dt")
    want = [("20240101", k) for k in range(3)] + [("20240102", k) for k in range(2)]
    assert mart() == want
    failing = day("20240102", 20).withColumn("k", dying()("k"))
    with pytest.raises(Exception, match="task died"):
        export_staged(failing, url, "MART", DERBY, "data_dt")
    assert mart() == want
    left = spark.read.jdbc(url, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLENAME LIKE '%STG%') t", properties=DERBY)
    assert left.count() == 0
    export_staged(day("20240103", 1), url, "MART", DERBY)  # no day column: the whole table
    assert mart() == [("20240103", 0)]


# ---------------------------------------------------------------- tar


def archive(path, members):
    with tarfile.open(path, "w:gz", format=members.pop("format", tarfile.PAX_FORMAT)) as tar:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
            else:
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))


@pytest.mark.parametrize("format", [tarfile.PAX_FORMAT, tarfile.GNU_FORMAT, tarfile.USTAR_FORMAT])
def test_lines_of_tar_members(spark, tmp_path, format):
    deep = "d" * 60 + "/" + "e" * 60 + "/long name.txt"
    if format != tarfile.USTAR_FORMAT:
        deep = "é" * 80 + "/" + deep
    archive(tmp_path / "a.tar.gz", {"format": format, "logs": None, "logs/one.txt": b"a\nb\r\nlast without feed", "logs/empty.txt": b"", deep: b"x" * 5000 + b"\n\n" + b"y\n" * 700,
                                    "other.bin": b"\0" * 512 + b"\n"})
    archive(tmp_path / "b.tar.gz", {"format": format, "logs/two.txt": "ünï\n".encode() * 600})
    got = sorted((r.archive[-8:], r.member, r.value) for r in scan_tar_log(spark, f"{tmp_path}/*.tar.gz").collect())
    want = [("a.tar.gz", "logs/one.txt", v) for v in ("a", "b", "last without feed")]
    want += [("a.tar.gz", deep, v) for v in ["x" * 5000, "", *["y"] * 700]] + [("a.tar.gz", "other.bin", "\0" * 512)]
    want += [("b.tar.gz", "logs/two.txt", "ünï")] * 600
    assert got == sorted(want)
    assert scan_tar_log(spark, f"{tmp_path}/*.tar.gz", r"logs/.*\.txt").select("member").distinct().count() == 2


def test_written_archives_are_tar_files(spark, tmp_path):
    lines = [f"line {k} é" for k in range(1000)]
    write_tar_log(spark.createDataFrame([(x,) for x in lines], "value string").repartition(3), f"{tmp_path}/out", 70)
    assert sorted(r.value for r in scan_tar_log(spark, f"{tmp_path}/out").collect()) == sorted(lines)
    inside = []
    for f in (tmp_path / "out").glob("*.gz"):
        with tarfile.open(f, "r:gz") as tar:
            for m in tar:
                inside += tar.extractfile(m).read().decode().splitlines()
    assert sorted(inside) == sorted(lines)
    with pytest.raises(Exception, match="not a gzip file"):
        spark.range(2).select(F.col("id").cast("string")).write.text(f"{tmp_path}/plain")
        scan_tar_log(spark, f"{tmp_path}/plain").count()


# ---------------------------------------------------------------- responses


def counting(folder, hang="", fail=""):
    """A service that notes every position it sees."""
    import json
    import time

    def call(location):
        for p in location.split("|"):
            with open(f"{folder}/{p}", "a") as f:
                f.write("x")
        if hang and hang in location:
            time.sleep(3)
        if fail and fail in location:
            raise OSError("service is down")
        return json.dumps({"infocode": "10000", "regeocodes": [{"formatted_address": f"at {p}"} for p in location.split("|")]})

    return call


def test_positions_are_asked_once(spark, tmp_path):
    path, seen = scratch_path(spark, "t-geo"), tmp_path / "seen"
    seen.mkdir()

    def top(ids):
        return spark.createDataFrame([(k, str(k), f"y{k}", 2) for k in ids] + [(1000 + k, str(k), f"y{k}", 1) for k in ids], "mid long, x string, y string, cnt long")

    enrich = ledger_enricher(counting(seen), path, Limits(batch_size=3, batches_per_commit=2))
    assert enrich(top(range(10))).count() == 20
    day_two = enrich(top(range(5, 15)))
    assert sorted(r.addr for r in day_two.collect()) == sorted([f"at y{k},{k}" for k in range(5, 15)] * 2)
    assert enrich(top(range(15))).count() == 30  # a forced retry of both
    assert sorted(f.name for f in seen.iterdir()) == sorted(f"y{k},{k}" for k in range(15))
    assert all(f.read_text() == "x" for f in seen.iterdir())


def test_calls_that_hang_or_fail_are_asked_again(spark, tmp_path):
    path, limits = scratch_path(spark, "t-geo"), Limits(batch_size=2, seconds=1.0, connections=2, per_second=50)
    top = spark.createDataFrame([(str(k), "y") for k in range(6)], "x string, y string")
    assert ask(top, counting(tmp_path, hang="y,0", fail="y,5"), path, limits) == 3
    assert sorted(r.x for r in read_ledger(spark, path).collect()) == ["2", "3"]
    assert ask(top, counting(tmp_path), path, limits) == 2
    assert read_ledger(spark, path).count() == 6
    assert ask(top, counting(tmp_path), path, limits) == 0


# ---------------------------------------------------------------- streams


def test_replayed_files_do_not_double_plays(spark):
    from encore.streaming.plays_once import land_plays_once, latest_windows, stream_song_windows

    def line(k, song, day):
        return (f'{k}&a&EV&{{"songid":"{song}","play_time":"{day}120000"}}&v&e',)

    source, table, windows = (scratch_path(spark, f"t-once-{n}") for n in ("src", "table", "win"))
    marks = [scratch_path(spark, f"t-once-ck{n}") for n in range(2)]
    files = [[line(k, f"s{k % 2}", DAY) for k in range(6)], [line(k, "s0", day_minus(DAY, 10)) for k in range(6, 9)] + [line(9, "s1", "20200101"), ("bad",)]]

    def deliver(n, again):
        spark.createDataFrame(files[n], "value string").coalesce(1).write.text(f"{source}/f{n}-{again}")

    def run():
        land_plays_once(spark, f"{source}/*", table, DAY, marks[0], "EV").awaitTermination()
        stream_song_windows(spark, f"{source}/*", windows, DAY, marks[1], "EV").awaitTermination()
        got = {r.songid: tuple(r)[1:] for r in latest_windows(spark.read.parquet(windows)).collect()}
        return spark.read.parquet(table).count(), got

    deliver(0, 0)
    assert run() == (6, {"s0": (3, 3, 3, 3), "s1": (3, 3, 3, 3)})
    deliver(0, 1)  # the same file once more
    deliver(1, 0)
    assert run() == (10, {"s0": (6, 3, 3, 6), "s1": (4, 3, 3, 3)})
    deliver(1, 1)  # and late
    assert run() == (10, {"s0": (6, 3, 3, 6), "s1": (4, 3, 3, 3)})
