"""Province and city from a free-text Chinese address.

Rules work on the positions of marker characters.  Where a range would be invalid (a
missing end mark, or one placed before the start mark) the result is ``''``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's tables): region markers tested in this order,
# and the short province name each one yields.
PROVINCE_MARKERS = [
    ("内蒙古自治区", "内蒙古"),
    ("宁夏回族自治区", "宁夏"),
    ("西藏自治区", "西藏"),
    ("广西壮族自治区", "广西"),
    ("新疆维吾尔自治区", "新疆"),
    ("北京市", "北京"),
    ("上海市", "上海"),
    ("重庆市", "重庆"),
    ("天津市", "天津"),
]
PROVINCE_MARK = "省"
# Autonomous regions whose city lies between the first 区 and the first 市.
REGION_CITY_MARKERS = ["内蒙古自治区", "宁夏回族自治区", "广西壮族自治区"]
XINJIANG = "新疆维吾尔自治区"
# Municipalities whose district name lies between the first 市 and the first 区.
MUNICIPALITY_MARKERS = ["北京市", "上海市"]
CHONGQING = "重庆市"
TIANJIN = "天津市"
DISTRICT, CITY, COUNTY, PREFECTURE = "区", "市", "县", "州"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _rest(c: Column, mark: str) -> Column:
    """Text after the first ``mark`` (whole text if absent)."""
    return F.substr(c, F.instr(c, mark) + 1, F.length(c))


def _cut(c: Column, start: str, end: str) -> Column:
    """Text after the first ``start`` up to the first ``end`` (both found from the
    beginning); ``''`` when ``end`` is missing or comes before ``start``."""
    i, j = F.instr(c, start), F.instr(c, end)
    return F.when((i > 0) & (j > i), F.substr(c, i + 1, j - i - 1)).otherwise(F.lit(""))


def _upto(c: Column, mark: str) -> Column:
    """Text before the first ``mark``; ``''`` when it is missing."""
    k = F.instr(c, mark)
    return F.when(k > 0, F.substr(c, F.lit(1), k - 1)).otherwise(F.lit(""))


def province_from_address(addr: Column | str) -> Column:
    c = _c(addr)
    out = None
    for marker, short in PROVINCE_MARKERS:
        cond = c.contains(marker)
        out = F.when(cond, F.lit(short)) if out is None else out.when(cond, F.lit(short))
    return out.when(c.contains(PROVINCE_MARK), _upto(c, PROVINCE_MARK)).otherwise(F.lit(""))


def city_from_address(addr: Column | str) -> Column:
    """City or district name by the per-region rules (position arithmetic keeps the
    generated code small enough for whole-stage codegen)."""
    c = _c(addr)
    d, m, x, z = DISTRICT, CITY, COUNTY, PREFECTURE
    after_d = _rest(c, d)
    # Xinjiang: 区..市 when that range is valid, else 区..next 区, else 区..州.
    xj = (F.when(F.instr(c, m) > F.instr(c, d), _cut(c, d, m))
          .when(after_d.contains(d), _upto(after_d, d))
          .otherwise(_upto(after_d, z)))
    # Chongqing: 市..区 if a 区 follows the first 市, else 市..县 if a 县 follows it.
    after_m = _rest(c, m)
    cq = (F.when(after_m.contains(d), _cut(c, m, d))
          .when(after_m.contains(x), _cut(c, m, x))
          .otherwise(F.lit("")))
    # Provinces: 省..市 if a 市 follows the first 省, else 省..州.
    after_p = _rest(c, PROVINCE_MARK)
    pv = (F.when(after_p.contains(m), _cut(c, PROVINCE_MARK, m))
          .otherwise(_upto(after_p, z)))
    region = None
    for marker in REGION_CITY_MARKERS:
        region = c.contains(marker) if region is None else region | c.contains(marker)
    muni = None
    for marker in MUNICIPALITY_MARKERS:
        muni = c.contains(marker) if muni is None else muni | c.contains(marker)
    return (F.when(region, _cut(c, d, m))
            .when(c.contains(XINJIANG), xj)
            .when(muni, _cut(c, m, d))
            .when(c.contains(CHONGQING), cq)
            .when(c.contains(TIANJIN), _cut(c, m, d))
            .when(c.contains(PROVINCE_MARK), pv)
            .otherwise(F.lit("")))


def province_or_derived(prvc: Column | str, addr: Column | str) -> Column:
    """Text ``'null'`` means missing: derive from the address (``''`` if that is NULL)."""
    p, a = _c(prvc), _c(addr)
    return F.when(p == "null", F.when(a.isNotNull(), province_from_address(a)).otherwise(F.lit(""))) \
        .otherwise(p)


def city_or_derived(cty: Column | str, addr: Column | str) -> Column:
    """Only a ``'null'`` city is derived from the address; any other value gives ``''``
    (callers apply it to rows whose city is ``'null'``)."""
    t, a = _c(cty), _c(addr)
    return F.when((t == "null") & a.isNotNull(), city_from_address(a)).otherwise(F.lit(""))
