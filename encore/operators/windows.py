"""Windowed and ranked operators.

* ``trailing_windows`` - plays / distinct users / distinct orders per key over the day,
  the trailing 7 and 30 days, plus the best single day of the previous 7 / 30 days,
  from ONE scan of the play log.
* ``global_row_number`` - row numbers per group without putting a group in one task.
* ``top_n`` - first ``n`` rows per group (planned as ``WindowGroupLimit``: each map task
  keeps ``n`` rows per group before the shuffle).
* ``top1_by`` - best row per key as an aggregate (partial aggregation, skew-proof).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.dates import check_day, day_minus
from encore.session import ensure_checkpoint_dir

_KIND_DAY, _KIND_USER, _KIND_ORDER = 0, 1, 2


STATE_COLUMNS = ["_k", "kind", "kd", "ku", "ko", "n", "last"]


def window_state(plays: DataFrame, start: str, end: str, key: str = "song_id", user: str = "uid",
                 order: str = "order_id", day_col: str = "data_dt", by_day: bool = False) -> DataFrame:
    """State of the plays in ``[start, end]``: one row per (key, day) with its play
    count, per (key, user) and per (key, order) with the last day seen (``yyyyMMdd`` as int).

    Every play becomes three keyed rows (``inline``) aggregated once by
    ``(key, kind, value)`` with a map-side partial aggregate; the int day keeps the
    buffers fixed-width (hash aggregation).  ``by_day`` keeps one partial per day, with
    ``data_dt``; ``combine_window_partials`` makes the state from them."""
    d = F.col(day_col)
    base = plays.where(d.between(check_day(start), check_day(end))).select(
        F.col(key).alias("_k"), F.col(user).alias("_u"), F.col(order).alias("_o"), d.try_cast("int").alias("_d"), *([d.alias("data_dt")] if by_day else []))
    utype = dict(base.dtypes)["_u"]
    otype = dict(base.dtypes)["_o"]

    def entry(kind: int, kd: Column, ku: Column, ko: Column) -> Column:
        return F.struct(F.lit(kind).cast("tinyint").alias("kind"), kd.cast("int").alias("kd"),
                        ku.cast(utype).alias("ku"), ko.cast(otype).alias("ko"))

    null = F.lit(None)
    split = ["data_dt"] if by_day else []
    keyed = base.select("_k", "_d", *split, F.inline(F.array(
        entry(_KIND_DAY, F.col("_d"), null, null),
        entry(_KIND_USER, null, F.col("_u"), null),
        entry(_KIND_ORDER, null, null, F.col("_o")),
    )))
    # n: plays of a (key, day) row; NULL on user/order rows, whose last day is all that
    # matters - so a kept state never carries counts from days that left the window.
    return keyed.groupBy("_k", "kind", "kd", "ku", "ko", *split).agg(
        F.sum(F.when(F.col("kind") == _KIND_DAY, F.lit(1))).alias("n"), F.max("_d").alias("last"))


def combine_window_partials(partials: DataFrame) -> DataFrame:
    """The window state of the days whose partials are given."""
    return partials.groupBy("_k", "kind", "kd", "ku", "ko").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def advance_window_state(state: DataFrame, plays: DataFrame, day: str, longest: int = 30, key: str = "song_id",
                         user: str = "uid", order: str = "order_id", day_col: str = "data_dt") -> DataFrame:
    """Yesterday's state -> today's: drop what left ``[day-longest, day]``, fold in the
    plays of ``day`` only.  Equal to ``window_state`` over the whole window, reading one
    day of the play log instead of ``longest + 1``.  ``state`` must not contain ``day``
    yet (start from the previous day's state, as the daily job does)."""
    lo = int(day_minus(day, longest))
    kept = state.select(*STATE_COLUMNS).where(F.col("last") >= lo)
    today = window_state(plays, day, day, key, user, order, day_col)
    return (kept.unionByName(today)
                .groupBy("_k", "kind", "kd", "ku", "ko")
                .agg(F.sum("n").alias("n"), F.max("last").alias("last")))


def windows_from_state(state: DataFrame, day: str, spans: Sequence[int] = (7, 30),
                       out_key: str = "song_id") -> DataFrame:
    """Per key: counts on ``day`` and over ``[day-n, day]`` for each ``n`` in ``spans``, and
    the best single day of ``[day-n, day-1]`` (see ``trailing_windows``)."""
    check_day(day)
    spans = sorted(set(spans))
    is_day = F.col("kind") == _KIND_DAY
    is_user = (F.col("kind") == _KIND_USER) & F.col("ku").isNotNull()
    is_order = (F.col("kind") == _KIND_ORDER) & F.col("ko").isNotNull()
    kd, last, n = F.col("kd"), F.col("last"), F.col("n")
    today, prev = int(day), int(day_minus(day, 1))
    lo = {s: int(day_minus(day, s)) for s in spans}
    aggs = [
        F.coalesce(F.sum(F.when(is_day & (kd == today), n)), F.lit(0)).cast("bigint").alias("sing_cnt"),
        F.count(F.when(is_user & (last == today), 1)).alias("usr_cnt"),
        F.count(F.when(is_order & (last == today), 1)).alias("ordr_cnt"),
    ]
    for s in spans:
        p = f"rct_{s}_"
        aggs += [
            F.coalesce(F.sum(F.when(is_day & (kd >= lo[s]), n)), F.lit(0)).cast("bigint").alias(p + "sing_cnt"),
            F.count(F.when(is_user & (last >= lo[s]), 1)).alias(p + "usr_cnt"),
            F.count(F.when(is_order & (last >= lo[s]), 1)).alias(p + "ordr_cnt"),
            F.max(F.when(is_day & kd.between(lo[s], prev), n).otherwise(0)).cast("bigint")
             .alias(p + "top_sing_cnt"),
        ]
    return state.groupBy(F.col("_k").alias(out_key)).agg(*aggs)


def trailing_windows(plays: DataFrame, day: str, key: str = "song_id", user: str = "uid",
                     order: str = "order_id", spans: Sequence[int] = (7, 30),
                     day_col: str = "data_dt", out_key: str | None = None) -> DataFrame:
    """Per ``key``: counts on ``day`` and over ``[day-n, day]`` for each ``n`` in ``spans``.

    Columns: ``sing_cnt, usr_cnt, ordr_cnt`` (the day), ``rct_{n}_sing_cnt``,
    ``rct_{n}_usr_cnt``, ``rct_{n}_ordr_cnt`` and ``rct_{n}_top_sing_cnt`` (largest daily
    play count in ``[day-n, day-1]``, 0 if none).  Keys with no play in the longest span
    are absent.

    Plan: ONE scan of the longest span into the compact ``window_state`` (two shuffles in
    all: by (key, kind, value), then by key).  This replaces separate scans per window and
    the row copies Catalyst makes for several ``count(distinct)``.  A daily job can keep
    the state and ``advance_window_state`` it instead of rescanning the window.
    """
    check_day(day)
    spans = sorted(set(spans))
    first = day_minus(day, spans[-1]) if spans else day      # no spans: the day alone
    state = window_state(plays, first, day, key, user, order, day_col)
    return windows_from_state(state, day, spans, out_key or key)


def top_n(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], n: int,
          name: str = "rank") -> DataFrame:
    """First ``n`` rows per group by ``order_cols`` (a total order gives stable results)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (df.withColumn(name, F.row_number().over(w))
              .where(F.col(name) <= n)
              .withColumn(name, F.col(name).cast("bigint")))


def top1_by(df: DataFrame, key_cols: Sequence[str], desc_col: str, tie_cols: Sequence[str],
            carry_cols: Sequence[str] = ()) -> DataFrame:
    """Row with the largest ``desc_col`` per key; ties go to the smallest ``tie_cols``.

    Written as ``min(struct(-desc, ties..., carried...))`` so Spark aggregates partially on
    each map task: a key holding a third of all rows still costs one row per task."""
    best = F.min(F.struct((-F.col(desc_col)).alias("_neg"),
                          *[F.col(c) for c in tie_cols], *[F.col(c) for c in carry_cols])).alias("_best")
    out = df.groupBy(*key_cols).agg(best)
    return out.select(*key_cols, *[F.col(f"_best.{c}").alias(c) for c in tie_cols],
                      (-F.col("_best._neg")).alias(desc_col),
                      *[F.col(f"_best.{c}").alias(c) for c in carry_cols])


# Largest offset table we are willing to broadcast in ``global_row_number``.
OFFSET_BROADCAST_ROWS = 200_000


def global_row_number(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                      name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by group_cols order by order_cols)`` for FEW, LARGE groups.

    A plain window sends each group to one task; here the rows are range-partitioned on
    ``(group, order)`` (``partitions`` tasks, or as many as AQE's advisory partition size
    gives when ``None``), numbered inside each task, and shifted
    by the count of the group's rows in earlier tasks.  The offset table has at most
    ``partitions + groups`` rows; it is broadcast only when its counted size is within
    ``OFFSET_BROADCAST_ROWS``.  The numbered rows are checkpointed (reliable storage under
    ``spark.checkpoint.dir``) so positions stay fixed if a task is re-run.
    ``order_cols`` must be a total order for a deterministic result.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    g = [F.col(c) for c in group_cols]
    # Without an explicit count AQE may merge adjacent range partitions to its advisory
    # size; merged ids still increase with the range, which is all the numbering needs.
    ranged = (df.repartitionByRange(partitions, *g, *order_cols) if partitions
              else df.repartitionByRange(*g, *order_cols))
    numbered = (ranged
                  .sortWithinPartitions(*g, *order_cols)
                  .withColumn("_rp", F.spark_partition_id())
                  .withColumn("_rpos", F.monotonically_increasing_id()))
    frozen = numbered.checkpoint(eager=True)
    stats = frozen.groupBy("_rp", *group_cols).agg(F.min("_rpos").alias("_first"),
                                                    F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*group_cols).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    stats = stats.select(F.col("_rp").alias("_srp"), *[F.col(c).alias(f"_s_{c}") for c in group_cols],
                         "_first", "_before")
    if stats.limit(OFFSET_BROADCAST_ROWS + 1).count() <= OFFSET_BROADCAST_ROWS:
        stats = F.broadcast(stats)
    cond = F.col("_rp") == F.col("_srp")
    for c in group_cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    out = frozen.join(stats, cond, "inner")
    rn = (F.col("_before") + F.col("_rpos") - F.col("_first") + 1).cast("bigint")
    return out.withColumn(name, rn).drop("_rp", "_rpos", "_srp", "_first", "_before",
                                         *[f"_s_{c}" for c in group_cols])
