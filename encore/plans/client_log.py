"""Client log landing (J1): raw ``&``-separated lines -> typed play table and per-event
text records.  Narrow transformations only (no shuffle), so the same functions run on a
streaming frame (see ``encore.streaming``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Record layout and the play event's name and JSON keys (in output order).
FIELD_SEP = "&"
FIELD_COUNT = 6
EVENT_INDEX = 2
PAYLOAD_INDEX = 3
PLAY_EVENT = "MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"
PLAY_FIELDS = ["songid", "mid", "optrate_type", "uid", "consume_type", "play_time", "dur_time", "session_id",
               "songname", "pkg_id", "order_id"]
TEXT_NULL = "\\N"     # NULL marker in tab-separated text (Hive's convention)
REJECTED_SUFFIX = "_REJECTED"   # fan-out key of play records whose payload is not a JSON object

PLAY_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in PLAY_FIELDS])
_CORRUPT = "_corrupt_payload"
# One parse per payload: text that is not a JSON object lands in the corrupt-record field.
_PARSE_SCHEMA = T.StructType(PLAY_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])
_PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def _parsed(payload: str = "payload"):
    """(parsed struct, is-a-JSON-object flag) from a single ``from_json``."""
    j = F.from_json(F.col(payload), _PARSE_SCHEMA, _PARSE_OPTIONS)
    return j, j.isNotNull() & j[_CORRUPT].isNull()


def split_records(lines: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``event, payload`` (and the ``keep`` columns) of every well-formed line: exactly 6
    fields once trailing empty fields are dropped (as Java's ``split`` does)."""
    parts = F.split(F.regexp_replace(F.col(value_col), f"{FIELD_SEP}+$", ""), FIELD_SEP)
    return (lines.select(parts.alias("_p"), *keep)
                 .where(F.size("_p") == FIELD_COUNT)
                 .select(F.get("_p", F.lit(EVENT_INDEX)).alias("event"), F.get("_p", F.lit(PAYLOAD_INDEX)).alias("payload"),
                         *keep))


def parse_client_log(lines: DataFrame, event_name: str = PLAY_EVENT, value_col: str = "value",
                     keep: Sequence[str] = ()) -> DataFrame:
    """Every well-formed record, parsed once: ``event`` (fan-out key), ``value`` (fan-out
    text), ``_play`` (a play record with a JSON-object payload) and the 11 play fields
    (NULL unless ``_play``).  Both the play table and the fan-out derive from it, so a job
    that writes both can store this frame and read and parse the log only once.

    Play records become tab-separated fields (NULL as ``\\N``, positions kept); other
    events pass through; play records with a malformed payload keep their text under
    ``<event>_REJECTED`` - counted and inspectable, out of the play table."""
    rec = split_records(lines, value_col, keep)
    is_play = F.col("event") == event_name
    j, ok = _parsed()
    good_play = is_play & ok
    tsv = F.concat_ws("\t", *[F.coalesce(j[f], F.lit(TEXT_NULL)) for f in PLAY_FIELDS])
    return rec.select(
        F.when(is_play & ~ok, F.concat(F.col("event"), F.lit(REJECTED_SUFFIX))).otherwise(F.col("event")).alias("event"),
        F.when(good_play, tsv).otherwise(F.col("payload")).alias("value"),
        good_play.alias("_play"),
        *[F.when(good_play, j[f]).alias(f) for f in PLAY_FIELDS], *keep)


def play_table(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The play table from ``parse_client_log``."""
    return parsed.where(F.col("_play")).select(*PLAY_FIELDS, *keep)


def fanout_records(parsed: DataFrame) -> DataFrame:
    """``event, value`` fan-out records from ``parse_client_log``."""
    return parsed.select("event", "value")


def client_log_parse(lines: DataFrame, event_name: str = PLAY_EVENT, value_col: str = "value",
                     keep: Sequence[str] = ()) -> DataFrame:
    """The play table: 11 string columns from the JSON payload of ``event_name`` records, and
    the ``keep`` columns of the lines.  A missing key is NULL; a payload that is not a JSON
    object (malformed) is dropped."""
    return play_table(parse_client_log(lines, event_name, value_col, keep), keep)


def rejected_lines(lines: DataFrame, event_name: str = PLAY_EVENT, value_col: str = "value") -> DataFrame:
    """Play records whose payload is not a JSON object (the rows ``client_log_parse`` drops)."""
    rec = split_records(lines, value_col).where(F.col("event") == event_name)
    _, ok = _parsed()
    return rec.where(~ok)


def client_log_records(lines: DataFrame, event_name: str = PLAY_EVENT, value_col: str = "value") -> DataFrame:
    """``event, value`` text records for the per-event fan-out (see ``parse_client_log``)."""
    return fanout_records(parse_client_log(lines, event_name, value_col))
