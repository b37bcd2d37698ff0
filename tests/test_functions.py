"""Golden rows for the column rules (hand-made inputs covering each branch)."""

from pyspark.sql import functions as F

from encore.functions import (album_name, auth_company, city_from_address, day_minus, join_ints, normalise_time14,
                              product_types, province_from_address, release_time, singer_field)


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {typ}")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_addresses(spark):
    cases = {
        "内蒙古自治区呼和浩特市": ("内蒙古", "呼和浩特"),
        "西藏自治区拉萨市": ("西藏", ""),
        "新疆维吾尔自治区伊犁州": ("新疆", "伊犁"),
        "新疆维吾尔自治区乌鲁木齐市": ("新疆", "乌鲁木齐"),
        "新疆维吾尔自治区阿勒泰区北屯区": ("新疆", "阿勒泰"),
        "北京市朝阳区": ("北京", "朝阳"),
        "上海市": ("上海", ""),
        "重庆市云阳县": ("重庆", "云阳"),
        "重庆市渝中区": ("重庆", "渝中"),
        "天津市和平区": ("天津", "和平"),
        "广东省深圳市": ("广东", "深圳"),
        "云南省大理白族自治州": ("云南", "大理白族自治"),
        "广西壮族自治区桂林": ("广西", ""),
        "宁夏回族自治区银川市": ("宁夏", "银川"),
        "市场省": ("市场", ""),
        "": ("", ""),
    }
    values = list(cases) + [None]
    prov = one_col(spark, values, province_from_address)
    city = one_col(spark, values, city_from_address)
    for v, p, c in zip(values, prov, city):
        if v is None:
            assert (p, c) == (None, None) or (p, c) == ("", "")
        else:
            assert (p, c) == cases[v], v


def test_normalise_time(spark):
    got = one_col(spark, ["20200101120000", "20200101", "2020010", "", None], normalise_time14)
    assert got == ["20200101120000", "20200101000000", "19700101000000", "19700101000000", "19700101000000"]


def test_release_time(spark):
    vals = ["2020-01-02 03:04:05", "2020-1-2 3:4:5", "2020-01-02 03:04:05 trailing", "2020-13-01 00:00:00",
            "1577145600000", "1.5771456E12", "x", None]
    got = one_col(spark, vals, release_time)
    assert got == ["2020-01-02 03:04:05", "2020-01-02 03:04:05", "2020-01-02 03:04:05", "",
                   "2019-12-24 00:00:00", "2019-12-24 00:00:00", "", ""]


def test_album_name(spark):
    vals = ['[{"name":"A1"}]', '[{"id":1}]', "[]", "专辑《夜曲》", "》x《", "plain", None]
    got = one_col(spark, vals, album_name)
    assert got == ["A1", None, "暂无专辑", "夜曲", "暂无专辑", "暂无专辑", "暂无专辑"]


def test_singer_fields(spark):
    vals = ['[{"name":"a","id":"1"},{"name":"b","id":"2"}]', '[{"name":"a","id":"1"}]', "[]",
            '[{"id":"1"}]', '{"name":"a"}', "bad", None]
    s1 = one_col(spark, vals, lambda c: singer_field(c, 0, "name"))
    s2 = one_col(spark, vals, lambda c: singer_field(c, 1, "id"))
    assert s1 == ["a", "a", "", None, "", "", ""]
    assert s2 == ["2", "", "", "", "", "", ""]


def test_auth_company(spark):
    vals = ['{"name":"c"}', '{"id":1}', "", "bad", "[1]", None]
    assert one_col(spark, vals, auth_company) == ["c", None, "乐心曲库", "乐心曲库", "乐心曲库", "乐心曲库"]


def test_product_types(spark):
    vals = ["[8.0,2.9]", "[]", "", "[a]", None, "[8.0,]"]
    got = one_col(spark, vals, lambda c: join_ints(product_types(c)))
    assert got == ["8,2", None, None, "null", None, "8"]


def test_day_minus():
    assert day_minus("20240301", 1) == "20240229"
    assert day_minus("20240130", 30) == "20231231"


def test_release_time_padding_is_not_a_number(spark):
    assert one_col(spark, [" 1577145600000", "1577145600000 ", "+1577145600000"], release_time) == \
        ["", "", "2019-12-24 00:00:00"]
