import pytest
from conftest import rows
from pyspark.sql import functions as F

from roomtide.functions import args, fixed, scalars
from roomtide.functions.jsonx import descend, field, json_elements, json_map


def test_json_object_fields(spark):
    df = spark.createDataFrame(
        [(1, '{"a":"x","n":null,"o":{"b":1},"t":true,"i":7}'), (2, '{"a":'), (3, "[1]"),
         (4, None), (5, "null"), (6, "")], "id int, s string")
    m = df.withColumn("m", json_map(F.col("s")))
    got = rows(m.select("id", *[field(F.col("m"), k).alias(k) for k in "anotiz"]), "id")
    assert got[0] == (1, "x", "null", '{"b":1}', "true", "7", "")
    assert all(r[1:] == ("",) * 6 for r in got[1:])


def test_json_elements(spark):
    df = spark.createDataFrame(
        [(1, '[{"id":"1"},null,"abc",5]'), (2, "oops"), (3, "null"), (4, "[]"), (5, '{"id":1}')],
        "id int, s string")
    got = dict(rows(df.select("id", json_elements(F.col("s"))), "id"))
    assert got[1] == ['{"id":"1"}', "{}", "abc", "5"]
    assert got[2] == got[3] == got[5] == ["{}"]
    assert got[4] == []


def test_descend(spark):
    df = spark.createDataFrame([('{"a":{"b":{"c":"deep"}}}',), ("bad",)], "s string")
    assert rows(descend(df, "s", ("a", "b", "c"), "v").select("v")) == [("",), ("deep",)]


@pytest.mark.parametrize("second, want", [
    (None, 30), ("", 30), ("1.5", 30), ("12", 12), (" 12", 30), ("+5", 5), ("-3", -3),
    ("99999999999", 30), ("0", 0)])
def test_beat_seconds(spark, second, want):
    df = spark.createDataFrame([(second,)], "s string")
    assert df.select(scalars.beat_seconds(F.col("s"))).first()[0] == want


def test_identity_and_codes(spark):
    df = spark.createDataFrame(
        [("u", "d", "1", fixed.ROOM_VIDEO), ("", "d", "", fixed.ROOM_TEXT),
         (None, "d", None, fixed.BIG_LIVE), (None, None, "0", "x")],
        "uid string, dev string, on string, t string")
    got = [tuple(r) for r in df.select(
        scalars.identity(F.col("uid"), F.col("dev")), scalars.online_flag(F.col("on")),
        scalars.live_type_code(F.col("t"))).collect()]
    assert got == [("u", "1", 0), ("d", "0", 1), ("d", "0", 2), ("", "0", 3)]


def test_times(spark):
    df = spark.createDataFrame([("2020-07-09 12:00:00.0",)], "s string")
    cut = scalars.cut_to_second(F.col("s"))
    iso = scalars.local_to_iso(cut)
    assert tuple(df.select(cut, iso, scalars.iso_to_local(iso, "Asia/Shanghai"),
                           scalars.iso_to_local(F.lit("bad"), "UTC")).first()) == (
        "2020-07-09 12:00:00", "2020-07-09T12:00:00+08:00", "2020-07-09 12:00:00", None)


def test_args():
    assert args.date_range_args(["x2020-01-02y", "2020-01-03"]) == ("2020-01-02", "2020-01-03")
    assert args.date_or_time_arg("2020-01-02 03:04:05") == "2020-01-02"
    for bad in ([], ["2020-01-01"], ["a", "b"], ["2020-13-01", "2020-01-01"]):
        with pytest.raises(ValueError):
            args.date_range_args(bad)
    with pytest.raises(ValueError):
        args.date_or_time_arg("at 2020-01-02")
