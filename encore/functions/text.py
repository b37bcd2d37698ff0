"""String and JSON rules used by the song dimension and the log parser.

All of them are built-in column expressions (JVM side, inside whole-stage codegen);
no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's defaults).
NO_ALBUM = "暂无专辑"          # album text when neither JSON nor 《…》 gives a name
DEFAULT_COMPANY = "乐心曲库"    # authorising company when the JSON object is unusable
ALBUM_OPEN = "《"
ALBUM_CLOSE = "》"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_if_null(s: Column | str) -> Column:
    """NULL (or ``''``) becomes ``''``."""
    return F.coalesce(_c(s), F.lit(""))


def string_length(s: Column | str) -> Column:
    return F.length(_c(s))


def _json_array_object(s: Column, i: int) -> Column:
    """True when ``s`` is a JSON array whose element ``i`` is an object."""
    elem = F.get_json_object(s, f"$[{i}]")
    return F.ltrim(s).startswith("[") & F.ltrim(elem).startswith("{")


def album_name(s: Column | str) -> Column:
    """JSON array -> ``[0].name``; else the text between the first 《 and the first 》;
    else the fixed default (also for NULL and for 》 before 《)."""
    c = _c(s)
    bracket = f"^[^{ALBUM_OPEN}{ALBUM_CLOSE}]*{ALBUM_OPEN}([^{ALBUM_CLOSE}]*){ALBUM_CLOSE}"
    return (F.when(_json_array_object(c, 0), F.get_json_object(c, "$[0].name"))
            .when(c.rlike(bracket), F.regexp_extract(c, bracket, 1))
            .otherwise(F.lit(NO_ALBUM)))


def singer_field(s: Column | str, index: int, field: str) -> Column:
    """Field ``field`` (``name``/``id``) of element ``index`` of a JSON array of singers.

    ``''`` when the element is absent or the text is not a JSON array; NULL when the
    element exists but has no such field."""
    c = _c(s)
    return F.when(_json_array_object(c, index),
                  F.get_json_object(c, f"$[{index}].{field}")).otherwise(F.lit(""))


def auth_company(s: Column | str) -> Column:
    """``name`` of a JSON object; the fixed default when the text is not an object
    (NULL, ``''``, malformed, an array).  An object without ``name`` gives NULL."""
    c = _c(s)
    return F.when(F.json_object_keys(c).isNull(), F.lit(DEFAULT_COMPANY)) \
        .otherwise(F.get_json_object(c, "$.name"))


def product_types(s: Column | str) -> Column:
    """``[8.0,9.0]`` -> ``array<int>`` [8, 9] (numbers truncated).

    Blank, ``[]`` and NULL give NULL; an item that is not a number gives a NULL item."""
    c = _c(s)
    stripped = F.regexp_replace(F.regexp_replace(c, r"^\[", ""), r"\]$", "")
    # Java's String.split drops trailing empty items; do the same.
    stripped = F.regexp_replace(stripped, ",+$", "")
    items = F.split(stripped, ",")
    arr = F.transform(items, lambda x: x.try_cast("double").try_cast("int"))
    empty = c.isNull() | (F.trim(c) == "") | (F.trim(stripped) == "")
    return F.when(empty, F.lit(None).cast("array<int>")).otherwise(arr)


def join_ints(arr: Column | str, sep: str = ",") -> Column:
    """Text form of an int array with NULL items shown as ``null`` (for display/compare)."""
    a = _c(arr)
    text = F.concat_ws(sep, F.transform(a, lambda x: F.coalesce(x.cast("string"), F.lit("null"))))
    return F.when(a.isNotNull(), text)
