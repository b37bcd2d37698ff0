"""Daily jobs over a warehouse folder: ``python -m encore.jobs <job> <yyyyMMdd> --warehouse ROOT``.

Each job reads its input tables (parquet folders under ROOT, day-partitioned by
``data_dt`` where the table is daily), runs one plan, writes its output day partition
(dynamic overwrite, so a rerun replaces the day) or snapshot, and optionally exports the
mart over JDBC.  Exports read back the written partition, so a plan is never computed
twice for two sinks.  Connection settings come from arguments / environment, never from
code.  Order implied by the reads:

    client_log, song_dim, machine_dim, consumption, users, machine_location
      -> song_features, machine_stats
      -> song_rsi, singer_rsi, merchant_stats, region_stats
"""

from __future__ import annotations

import argparse
import importlib
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.dates import check_day, day_minus
from encore.plans.client_log import PLAY_EVENT, fanout_records, parse_client_log, play_table
from encore.plans.influence import TOP_EXPORT, singer_influence, song_influence
from encore.plans.location import (BATCH_SIZE, LONG_BATCH_SIZE, combine_location_partials, location_state,
                                   lookup_enricher, machine_location, service_enricher, votes_from_state)
from encore.plans.machines import machine_dim
from encore.plans.money import consumption_detail, machine_stats, merchant_share, region_stats
from encore.operators.windows import combine_window_partials, window_state, windows_from_state
from encore.plans.songs import song_dim
from encore.plans.users import active_users, channel_union, newly_active_users
from encore.session import remove_scratch, scratch_path
from encore.operators.bitmaps import bitmap_state, dense_ids, windows_from_bitmaps
from encore.operators.dyadic import DyadicStore
from encore.plans.songs import features_from_windows
from encore.sources import catalog
from encore.sources.export import export_staged
from encore.sources.ledger import Ledger, affected_days, day_signatures
from encore.sources.scans import scan_day_range
from encore.sources.sinks import fanout_by_key, stamp_date, write_day, write_snapshot
from encore.sources.versions import publish_snapshot, read_table

# Table names (folders under the warehouse root).
PLAYS = "to_client_song_play_operate_req_d"
SONG_SRC, SONG_DIM, SONG_FTUR = "to_song_info_d", "tw_song_baseinfo_d", "tw_song_ftur_d"
SONG_STATE = "tw_song_day_partial_d"       # one partial aggregate per day of the play log
SONG_BITS = "tw_song_day_bits_d"           # the same as bitmaps of dense ids, in words of 64
USER_IDS, ORDER_IDS = "tw_user_id", "tw_order_id"
SONG_RSI, SINGER_RSI = "tw_song_rsi_d", "tw_singer_rsi_d"
MAC_A, MAC_B, MAC_ADDR = "to_ycak_mac_d", "to_ycbk_mac_admin_map_d", "to_ycak_mac_loc_d"
PRVC, CITY, AREA, STORE_MAP, STORE = ("to_ycbk_prvc_d", "to_ycbk_city_d", "to_ycbk_area_d", "to_ycbk_mac_store_map_d",
                                      "to_ycbk_store_d")
MAC_DIM, LOC_REPORTS, LOC_LOOKUP, MAC_LOC = "tw_mac_baseinfo_d", "to_ycak_usr_loc_d", "to_loc_lookup", "tw_mac_loc_d"
LOC_STATE = "tw_mac_loc_day_partial_d"    # distinct location reports of each day
LOC_TREE = "tw_mac_loc_dyadic"             # the same over 1, 2, 4, ... days, for long windows
LONG_WINDOW = 60                           # days from which a window is read from the tree
GEO_RESPONSES = "to_geocode_response_d"    # what the geocoder answered, by day
CNSM, CNSM_BRIEF, MAC_STAT = "to_ycak_cnsm_d", "tw_cnsm_brief_d", "tw_mac_stat_d"
USR_WX, USR_ALI, USR_QQ, USR_APP, LOGINS = ("to_ycak_usr_d", "to_ycak_usr_ali_d", "to_ycak_usr_qq_d",
                                             "to_ycak_usr_app_d", "to_ycak_usr_login_d")
USR_BASE, MRCHNT, REGION = "tw_usr_baseinfo_d", "tm_usr_mrchnt_stat_d", "tm_mac_region_stat_d"

# Export table names of the marts.
EXPORTS = {"song_rsi": "to_song_rsi", "singer_rsi": "tm_singer_rsi", "machine_dim": "tm_mac_baseinfo",
           "machine_stats": "tm_machine_rev_infos", "merchant_stats": "tm_usr_mrchnt_stat_d",
           "region_stats": "tm_mac_region_stat_d", "users": "user_7days_active"}


_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")


@dataclass
class Warehouse:
    """Tables as folders under ``root``.  ``CatalogWarehouse`` has the same tables by name."""

    spark: SparkSession
    root: str
    jdbc_url: str | None = None
    jdbc_props: dict = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        df = read_table(self.spark, self.path(table))
        if "data_dt" in df.columns:      # day partitions are strings whatever discovery infers
            df = df.withColumn("data_dt", F.col("data_dt").cast("string"))
        return df

    def day(self, table: str, day: str) -> DataFrame:
        """One day partition, read from its own folder: only that folder is listed, not
        every day the table has accumulated.  Raises if the day was never written."""
        base = self.path(table)
        df = self.spark.read.option("basePath", base).parquet(f"{base}/data_dt={check_day(day)}")
        return df.drop("data_dt")

    def write_day(self, df: DataFrame, table: str, day: str) -> DataFrame:
        write_day(df, self.path(table), day)
        return self.day(table, day)

    def write_whole(self, df: DataFrame, table: str) -> None:
        """Replace a snapshot table as a new version; readers see the old one until it is whole."""
        publish_snapshot(df, self.path(table))

    def stored_days(self, table: str, start: str, end: str, schema) -> set[str]:
        """Days of ``[start, end]`` with rows."""
        try:
            self.read(table)
        except AnalysisException as e:
            if e.getCondition() not in _MISSING:
                raise
            return set()
        stored = self.spark.read.schema(schema).parquet(self.path(table))
        return {r[0] for r in stored.where(F.col("data_dt").between(start, end)).select("data_dt").distinct().collect()}

    def replace_days(self, df: DataFrame, table: str, days: set[str]) -> None:
        """Write ``df`` (with ``data_dt``) over the stored ``days``.

        The stored days are emptied first (an empty day counts as not stored, so a run that fails
        here is made good by the next): a day whose source has lost all its rows keeps none of before."""
        for d in days:
            write_snapshot(self.spark.createDataFrame([], df.schema).drop("data_dt"), f"{self.path(table)}/data_dt={d}")
        (df.hint("rebalance", "data_dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("data_dt").parquet(self.path(table)))

    def read_days(self, table: str, start: str, end: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(table)).where(F.col("data_dt").between(start, end))

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, self.root)

    def export(self, df: DataFrame, job: str, day: str | None = None) -> None:
        """To the mart's relational table, staged; a dated mart keeps its other days."""
        if self.jdbc_url and job in EXPORTS:
            out = stamp_date(df, day) if day else df
            export_staged(out, self.jdbc_url, EXPORTS[job], self.jdbc_props, "data_dt" if day else None)


class CatalogWarehouse(Warehouse):
    """The same tables by name in a database of the catalog: ``CREATE TABLE ... PARTITIONED BY``
    with the columns of the first write (the play table with its declared ones), dynamic
    ``INSERT OVERWRITE`` of days, snapshots swapped by the table's location."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None, jdbc_url: str | None = None,
                 jdbc_props: dict | None = None):
        super().__init__(spark, catalog.use_database(spark, database, location), jdbc_url, jdbc_props or {})
        self.database = database

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def day(self, table: str, day: str) -> DataFrame:
        return self.read(table).where(F.col("data_dt") == check_day(day)).drop("data_dt")

    def write_day(self, df: DataFrame, table: str, day: str) -> DataFrame:
        if table == PLAYS:
            catalog.create_day_table(self.spark, self.name(table), catalog.PLAY_TABLE_DDL)
        catalog.write_day_table(df, self.name(table), day)
        return self.day(table, day)

    def write_whole(self, df: DataFrame, table: str) -> None:
        catalog.swap_table(df, self.name(table), f"{self.root}/_snapshots/{table}")

    def stored_days(self, table: str, start: str, end: str, schema) -> set[str]:
        return {d for d in catalog.table_days(self.spark, self.name(table)) if start <= d <= end}

    def replace_days(self, df: DataFrame, table: str, days: set[str]) -> None:
        catalog.drop_days(self.spark, self.name(table), sorted(days))
        catalog.insert_days(df.hint("rebalance", "data_dt"), self.name(table))

    def read_days(self, table: str, start: str, end: str, schema) -> DataFrame:
        return self.read(table).where(F.col("data_dt").between(start, end))


def job_client_log(wh: Warehouse, day: str, log_path: str, event_name: str = PLAY_EVENT,
                   files_per_key: int | None = None) -> None:
    """Raw log text -> per-event text folders and the play table's day partition.
    ``files_per_key`` bounds the files written per event (see ``fanout_by_key``)."""
    # Read and parse the log once, store the records on shared storage, and write both
    # outputs from there: nothing of the day is held in executors that can be lost.
    parsed = parse_client_log(wh.spark.read.text(log_path), event_name)
    stored = scratch_path(wh.spark, "client-log")
    try:
        write_snapshot(parsed, stored)
        records = wh.spark.read.schema(parsed.schema).parquet(stored)
        fanout_by_key(fanout_records(records), "event", "value", wh.path(f"all_client_tables/{day}"), files_per_key)
        wh.write_day(play_table(records), PLAYS, day)
    finally:
        remove_scratch(wh.spark, stored)


def job_song_dim(wh: Warehouse, day: str | None = None) -> None:
    """Song dimension snapshot."""
    wh.write_whole(song_dim(wh.read(SONG_SRC)), SONG_DIM)


def _changed(wh: Warehouse, consumer: str, source: str, window: Sequence[str]) -> tuple[list[str], dict[str, str]]:
    """Days of the source whose files are others than those that ``consumer`` was built from, and
    the files' signatures of now.  They are taken before anything of the source is read."""
    now = day_signatures(wh.spark, wh.path(source), window)
    return wh.ledger.changed(consumer, source, now), now


def _partials(wh: Warehouse, table: str, source: DataFrame, build: Callable[..., DataFrame], day: str, days: int,
              changed: Sequence[str] = (), origin: str | None = None) -> DataFrame:
    """The day partials of ``[day-days, day]``, one immutable partition per day.  The day
    itself, days never stored, those named in ``changed`` and, where ``origin`` names the source
    table, days whose files have changed since (by the ledger) are built from the source;
    no other day of it is read, and nothing stored for another day is written again."""
    window = [day_minus(day, k) for k in range(days, -1, -1)]
    rewritten, signatures = _changed(wh, table, origin, window) if origin else ([], {})
    schema = build(source, day, day, by_day=True).schema
    have = wh.stored_days(table, window[0], day, schema)
    todo = [d for d in window if d == day or d not in have or d in changed or d in rewritten]
    built = build(source.where(F.col("data_dt").isin(todo)), window[0], day, by_day=True)
    wh.replace_days(built, table, set(todo) & have)
    if origin:
        wh.ledger.record(table, origin, {d: s for d, s in signatures.items() if d in todo})
    return wh.read_days(table, window[0], day, schema)


def job_song_features(wh: Warehouse, day: str, changed: Sequence[str] = (), bitmaps: bool = False) -> None:
    """Song features of ``day`` from one partial aggregate per day of the 30-day window.

    Only days without a partial, ``day`` itself and days of the play log that were corrected
    since are read: the ledger notices rewritten files, and ``changed`` names further days.
    With ``bitmaps`` the partials are bitmaps of dense user and order numbers."""
    plays = wh.read(PLAYS).select(F.col("songid").cast("string").alias("song_id"), "uid", "order_id", "data_dt")
    songs = wh.read(SONG_DIM).withColumn("nbr", F.col("nbr").cast("string"))
    if bitmaps:
        window = scan_day_range(plays, day_minus(day, 30), day)
        users, orders = (dense_ids(window.select(c), wh.path(t)) for c, t in (("uid", USER_IDS), ("order_id", ORDER_IDS)))
        state = _partials(wh, SONG_BITS, plays, lambda df, a, b, by_day: bitmap_state(df, users, orders, a, b), day, 30, changed, PLAYS)
        windows = windows_from_bitmaps(state, day, out_key="nbr")
    else:
        parts = _partials(wh, SONG_STATE, plays, window_state, day, 30, changed, PLAYS)
        windows = windows_from_state(combine_window_partials(parts), day, out_key="nbr")
    wh.write_day(features_from_windows(windows, songs), SONG_FTUR, day)


def job_song_rsi(wh: Warehouse, day: str) -> None:
    """J4 + J14: ranked song influence; the top 30 per period are exported."""
    out = wh.write_day(song_influence(wh.day(SONG_FTUR, day)), SONG_RSI, day)
    wh.export(out.where(F.col("rsi_rank") <= TOP_EXPORT), "song_rsi", day)


def job_singer_rsi(wh: Warehouse, day: str) -> None:
    """J5 + J14: ranked singer influence; the top 30 per period are exported."""
    out = wh.write_day(singer_influence(wh.day(SONG_FTUR, day)), SINGER_RSI, day)
    wh.export(out.where(F.col("rsi_rank") <= TOP_EXPORT), "singer_rsi", day)


def job_machine_dim(wh: Warehouse, day: str) -> None:
    """Machine dimension of ``day`` (sources are snapshots)."""
    out = wh.write_day(machine_dim(*[wh.read(t) for t in (MAC_A, MAC_B, MAC_ADDR, PRVC, CITY, AREA, STORE_MAP,
                                                          STORE)]), MAC_DIM, day)
    wh.export(out, "machine_dim", day)


def _day_or_none(wh: Warehouse, table: str, day: str) -> DataFrame | None:
    """One day of a table, or None if it was never written.  Other errors are raised."""
    try:
        df = wh.day(table, day)
    except AnalysisException as e:
        if e.getCondition() in _MISSING:
            return None
        raise
    return df if df.limit(1).count() else None


def _latest_before(wh: Warehouse, table: str, day: str) -> DataFrame | None:
    """The latest stored day before ``day``: the day before if it is there, else a look at
    the table's partitions."""
    found = _day_or_none(wh, table, day_minus(day, 1))
    if found is not None:
        return found
    try:
        last = wh.read(table).where(F.col("data_dt") < day).agg(F.max("data_dt")).first()[0]
    except AnalysisException as e:
        if e.getCondition() in _MISSING:
            return None
        raise
    return wh.day(table, last) if last else None


def job_machine_location(wh: Warehouse, day: str, days: int = 30, changed: Sequence[str] = (),
                         geocoder: Callable[[str], str] | None = None, batch_size: int | None = None) -> None:
    """Location snapshot of ``day`` merged over the latest earlier one, from one partial
    of distinct reports per day; any window length is made from the same partials.

    Positions are looked up in the location table, or asked of ``geocoder`` (see
    ``service_enricher``) in requests of ``batch_size`` positions; the day's responses stay in
    the warehouse."""
    if geocoder is None:
        enrich = lookup_enricher(wh.read(LOC_LOOKUP))
    else:
        size = batch_size or (BATCH_SIZE if days <= 30 else LONG_BATCH_SIZE)
        enrich = service_enricher(geocoder, f"{wh.path(GEO_RESPONSES)}/data_dt={check_day(day)}", size)
    reports = wh.read(LOC_REPORTS)
    if days >= LONG_WINDOW:
        state = _location_tree(wh, reports, day, days, changed)
    else:
        state = combine_location_partials(_partials(wh, LOC_STATE, reports, location_state, day, days, changed, LOC_REPORTS))
    prev = _latest_before(wh, MAC_LOC, day)
    wh.write_day(machine_location(reports, prev, day, enrich, days, votes=votes_from_state(state)), MAC_LOC, day)


def _location_tree(wh: Warehouse, reports: DataFrame, day: str, days: int, changed: Sequence[str]) -> DataFrame:
    """The distinct reports of a long window from at most 2 log2(days) stored partials."""
    start = day_minus(day, days)
    rewritten, signatures = _changed(wh, LOC_TREE, LOC_REPORTS, [day_minus(day, k) for k in range(days, -1, -1)])
    tree = location_tree(wh.spark, wh.path(LOC_TREE), reports)
    tree.refresh(start, day, {*changed, *rewritten, day})
    wh.ledger.record(LOC_TREE, LOC_REPORTS, {d: s for d, s in signatures.items() if d in rewritten or d == day})
    return tree.window(start, day)


def location_tree(spark: SparkSession, path: str, reports: DataFrame) -> DyadicStore:
    return DyadicStore(spark, path, lambda a, b: location_state(reports, a, b, by_day=True),
                       lambda df, extra: df.groupBy(*extra, "uid", "mid", "lat", "lng").agg(F.max("last").alias("last")))


def job_refresh(wh: Warehouse, day: str, back: int = 30) -> list[str]:
    """Make the features, rankings and locations up to ``day`` again that rest on source days
    whose files have changed since.  Looks at the ``back`` days before ``day`` as result days;
    returns the result days that were made again."""
    span = [day_minus(day, k) for k in range(back + 30, -1, -1)]
    results = span[30:]
    made = []
    changed, _ = _changed(wh, SONG_STATE, PLAYS, span)
    for d in affected_days(changed, day, 30):
        if d in results and _day_or_none(wh, SONG_FTUR, d) is not None:
            job_song_features(wh, d)
            job_song_rsi(wh, d)
            job_singer_rsi(wh, d)
            made.append(d)
    changed, _ = _changed(wh, LOC_STATE, LOC_REPORTS, span)
    for d in results:  # a snapshot also rests on the one of the day before
        if changed and d >= changed[0] and _day_or_none(wh, MAC_LOC, d) is not None:
            job_machine_location(wh, d)
            made.append(d)
    return sorted(set(made))


def job_consumption(wh: Warehouse, day: str, full_history: bool = False) -> None:
    """Consumption detail of ``day``; with ``full_history`` the whole source table is
    stored under the day, so that the statistics cover all days up to it."""
    source = wh.read(CNSM)
    wh.write_day(consumption_detail(source, None if full_history else day), CNSM_BRIEF, day)


def job_users(wh: Warehouse, day: str) -> None:
    """J9 + J10: active users of ``day``; the newly active ones are exported."""
    users = channel_union(*[wh.read(t) for t in (USR_WX, USR_ALI, USR_QQ, USR_APP)])
    wh.write_day(active_users(wh.read(LOGINS), users, day), USR_BASE, day)
    week = scan_day_range(wh.read(USR_BASE), day_minus(day, 7), day)
    wh.export(newly_active_users(week, day), "users")


def job_machine_stats(wh: Warehouse, day: str) -> None:
    """Revenue, refunds and new users per machine x package x pay type."""
    out = wh.write_day(machine_stats(wh.day(MAC_DIM, day), wh.day(MAC_LOC, day), wh.day(CNSM_BRIEF, day),
                                     wh.day(USR_BASE, day), day), MAC_STAT, day)
    wh.export(out, "machine_stats", day)


def job_merchant_stats(wh: Warehouse, day: str) -> None:
    """Shares per agent x pay type."""
    wh.export(wh.write_day(merchant_share(wh.day(MAC_STAT, day)), MRCHNT, day), "merchant_stats", day)


def job_region_stats(wh: Warehouse, day: str) -> None:
    """Totals per province x city."""
    wh.export(wh.write_day(region_stats(wh.day(MAC_STAT, day)), REGION, day), "region_stats", day)


JOBS: dict[str, Callable[..., None]] = {
    "client_log": job_client_log, "song_dim": job_song_dim, "machine_dim": job_machine_dim,
    "consumption": job_consumption, "users": job_users, "machine_location": job_machine_location,
    "song_features": job_song_features, "machine_stats": job_machine_stats, "song_rsi": job_song_rsi,
    "singer_rsi": job_singer_rsi, "merchant_stats": job_merchant_stats, "region_stats": job_region_stats,
}
DAILY_ORDER = ["song_dim", "machine_dim", "consumption", "users", "machine_location", "song_features",
               "machine_stats", "song_rsi", "singer_rsi", "merchant_stats", "region_stats"]


def run_day(wh: Warehouse, day: str, jobs: list[str] | None = None) -> None:
    """Run the daily jobs (all but the log landing) for ``day`` in dependency order."""
    check_day(day)
    for name in jobs or DAILY_ORDER:
        JOBS[name](wh, day)


def _named(name: str) -> Callable[[str], str]:
    """The function that ``module:function`` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="python -m encore.jobs", description=__doc__.split("\n")[0])
    p.add_argument("job", choices=sorted(JOBS) + ["all", "refresh"])
    p.add_argument("day", help="analysis date yyyyMMdd")
    where = p.add_mutually_exclusive_group(required=True)
    where.add_argument("--warehouse", help="root folder of the tables")
    where.add_argument("--database", help="catalog database of the tables, in place of a folder")
    p.add_argument("--database-location", help="folder of the database, if it has to be created")
    p.add_argument("--bitmaps", action="store_true", help="song_features: day partials as bitmaps of dense ids")
    p.add_argument("--log-path", help="raw log files (client_log job)")
    p.add_argument("--event", default=PLAY_EVENT)
    p.add_argument("--files-per-key", type=int, default=None, help="client_log: max files per event folder")
    p.add_argument("--days", type=int, default=30, help="machine_location: length of the window")
    p.add_argument("--geocoder", help="machine_location: module:function that answers one request string")
    p.add_argument("--batch-size", type=int, default=None, help="machine_location: positions per request")
    p.add_argument("--full-history", action="store_true", help="consumption: store the whole source, not the day")
    p.add_argument("--changed-days", default="", help="song_features, machine_location: past days corrected since, comma-joined")
    p.add_argument("--jdbc-url", default=os.environ.get("ENCORE_JDBC_URL"))
    p.add_argument("--jdbc-user", default=os.environ.get("ENCORE_JDBC_USER"))
    p.add_argument("--jdbc-password-env", default="ENCORE_JDBC_PASSWORD",
                   help="name of the environment variable holding the password")
    p.add_argument("--jdbc-driver", default=None)
    a = p.parse_args(argv)
    check_day(a.day)                     # validate before starting Spark
    changed = [check_day(d) for d in a.changed_days.split(",") if d]

    from encore.session import build_session, ensure_checkpoint_dir

    spark = SparkSession.getActiveSession() or build_session(master=os.environ.get("ENCORE_MASTER", "local[*]"))
    ensure_checkpoint_dir(spark)
    props = {k: v for k, v in {"user": a.jdbc_user, "password": os.environ.get(a.jdbc_password_env),
                               "driver": a.jdbc_driver}.items() if v}
    wh = (CatalogWarehouse(spark, a.database, a.database_location, a.jdbc_url, props) if a.database
          else Warehouse(spark, a.warehouse, a.jdbc_url, props))
    if a.job == "refresh":
        job_refresh(wh, a.day)
    elif a.job == "client_log":
        if not a.log_path:
            p.error("--log-path is required for client_log")
        job_client_log(wh, a.day, a.log_path, a.event, a.files_per_key)
    elif a.job == "all":
        run_day(wh, a.day)
    elif a.job == "song_features":
        job_song_features(wh, a.day, changed, a.bitmaps)
    elif a.job == "machine_location":
        job_machine_location(wh, a.day, a.days, changed, _named(a.geocoder) if a.geocoder else None, a.batch_size)
    elif a.job == "consumption":
        job_consumption(wh, a.day, a.full_history)
    else:
        JOBS[a.job](wh, a.day)


if __name__ == "__main__":
    main()
