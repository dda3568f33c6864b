"""Column functions on tiny literal frames (edge cases from FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import functions as X
from martforge.functions.coerce import KEEP_NULL, coerce

D = dt.datetime


def one(spark, expr, schema, *rows):
    df = spark.createDataFrame(list(rows), schema)
    return [r[0] for r in df.select(expr).collect()]


def test_local_time_and_date(spark):
    # 1998-10-03 is summer time in Moscow (+4); 1999-01-16 is winter (+3)
    got = one(spark, X.to_local("t"), "t timestamp_ntz", (D(1998, 10, 3, 21, 0),), (D(1999, 1, 16, 21, 0),))
    assert got == [D(1998, 10, 4, 1, 0), D(1999, 1, 17, 0, 0)]
    assert one(spark, X.local_date("t"), "t timestamp_ntz", (D(2024, 1, 1, 21, 0),)) == [dt.date(2024, 1, 2)]
    assert one(spark, X.plus_hours("t", 3), "t timestamp_ntz", (D(2024, 1, 1, 22, 0),)) == [D(2024, 1, 2, 1, 0)]


def test_hours_floor_truncates_toward_zero(spark):
    rows = [(D(2024, 1, 1), D(2024, 1, 2)),                       # exactly 24 h
            (D(2024, 1, 1), D(2024, 1, 1, 23, 59, 59)),           # 23:59:59
            (D(2024, 1, 1), D(2024, 1, 3)),                       # 48 h
            (D(2024, 1, 2), D(2024, 1, 1, 22, 30))]               # negative 1.5 h -> -1
    got = one(spark, X.hours_floor("a", "b"), "a timestamp_ntz, b timestamp_ntz", *rows)
    assert got == [24, 23, 48, -1]
    assert one(spark, X.sla_bucket(X.hours_floor("a", "b")), "a timestamp_ntz, b timestamp_ntz", *rows) == [
        "Более 24 часов", "Менее 24 часов", "Более 48 часов", "Менее 24 часов"]


def test_minute_boundaries_vs_elapsed(spark):
    rows = [(D(2024, 1, 1, 10, 0, 59), D(2024, 1, 1, 10, 1, 1)),   # 2 s apart, 1 boundary
            (D(2024, 1, 1, 10, 0, 0), D(2024, 1, 1, 10, 2, 30)),    # 2.5 min -> half-even 2
            (D(2024, 1, 1, 10, 0, 0), D(2024, 1, 1, 10, 3, 30))]    # 3.5 min -> half-even 4
    s = "a timestamp_ntz, b timestamp_ntz"
    assert one(spark, X.minute_boundaries("a", "b"), s, *rows) == [1, 2, 3]
    assert one(spark, X.minutes_elapsed("a", "b"), s, *rows) == [0, 2, 4]
    assert one(spark, X.minutes_float("a", "b"), s, *rows)[1] == pytest.approx(2.5)


def test_clock_formats(spark):
    assert one(spark, X.hhmmss("s"), "s long", (59,), (3661,), (360000 + 61,)) == ["00:00:59", "01:01:01", "100:01:01"]
    assert one(spark, X.hms("s"), "s double", (0.5,), (1.5,), (3600.4,)) == ["0:00:00", "0:00:02", "1:00:00"]


def test_parse_fix_clamp(spark):
    texts = [("2024-01-05 10:00:60",), ("2024-01-05T10:00:00",), ("05.01.2024 10:00:00",), ("garbage",), (None,),
             ("1950-01-01 00:00:00",)]
    parsed = one(spark, X.parse_ts(X.fix_sec60("x")), "x string", *texts)
    assert parsed[:3] == [D(2024, 1, 5, 10, 0, 59), D(2024, 1, 5, 10, 0), D(2024, 1, 5, 10, 0)]
    assert parsed[3] is None and parsed[4] is None
    assert one(spark, X.parse_ts("x"), "x string", ("2024-01-05 10:00:60",)) == [None]
    clamped = one(spark, X.clamp_ts(X.parse_ts("x")), "x string", *texts)
    assert clamped[3] == D(1971, 1, 1) and clamped[5] == D(1971, 1, 1)
    assert one(spark, X.date_or_floor("x"), "x string", ("",), ("2024-02-03",), ("bad",)) == [
        dt.date(1900, 1, 1), dt.date(2024, 2, 3), dt.date(1900, 1, 1)]
    assert one(spark, X.open_end("d"), "d date", (None,), (dt.date(2299, 12, 31),), (dt.date(2024, 1, 1),)) == [
        dt.date(2099, 12, 31), dt.date(2099, 12, 31), dt.date(2024, 1, 1)]


def test_json_text_and_pick(spark):
    raw = '{"studyIUID": "s1", "aiResult": {"norma": "1", "modelId": 1003}}'
    doubly = '{"aiResult": "{\\"norma\\": \\"0\\"}"}'
    s = "raw string, comp string"
    rows = [(raw, '{"studyUid": "c1", "modelId": 7}'), ("null", '{"studyUid": "c2", "modelId": 8}'), (doubly, "{}")]
    assert one(spark, X.json_text("raw", "aiResult", "norma"), s, *rows) == ["1", "", "0"]
    assert one(spark, X.json_pick("raw", "comp", ["studyIUID"], ["studyUid"]), s, *rows) == ["s1", "c2", ""]
    assert one(spark, X.json_pick("raw", "comp", ["aiResult", "modelId"], ["modelId"], as_int=True), s, *rows) == [
        1003, 8, None]


def test_split_pick_int(spark):
    got = one(spark, X.split_pick_int("u"), "u string", ("1.2.643.555.1003.1",), ("1.2.840.99",), ("12345",),
              ("1.2.20240101123456.1",), (None,))
    assert got == [1003, 840, None, 20240101123456, None]


def test_clean_text(spark):
    got = one(spark, X.clean_text("t"), "t string", (None,), ("",), ('a "b"\r\nc',), ('""',),
              ("  many   spaces here  ",))
    assert got == [None, "", "a b c", "", "many spaces here"]


def test_norm_accession(spark):
    got = one(spark, X.norm_accession("x"), "x string", (" 12345 6",), ("А123456",), ("а123456",), ("x-12",),
              ("A1234",), ("b7654321",), (None,))
    assert got == ["A123456", "A123456", "A123456", None, None, "B7654321", None]


def test_html_helpers(spark):
    html = ('<div><span class="x">one &amp; two</span><SPAN></SPAN><span><b>nested</b></span></div>'
            '<a href="https://store.example/docs/7/a.pdf">a</a><a href="https://store.example/docs/8/b.pdf">b</a>'
            '<a href="https://store.example/docs/7/a.pdf">again</a>')
    s = "h string"
    assert one(spark, X.strip_html("h"), s, ("<p>a</p>\n<p>b</p>",), (None,)) == ["a b", ""]
    assert one(spark, X.tag_texts("h", "span"), s, (html,)) == ["one & two; nested"]
    urls = one(spark, X.storage_urls("h", r'href="([^"]+)"', 1, "/docs/7/"), s, (html,))
    assert urls == [["https://store.example/docs/7/a.pdf"]]


def test_status_names_and_text(spark):
    assert one(spark, X.map_status("s"), "s string", (" Новая ",), ("В работе",), ("other ",)) == [
        "new", "work", "other"]
    assert one(spark, X.full_name("l", "f", "m", "id"), "l string, f string, m string, id long",
               ("Ivanov", "", None, 5), (None, None, None, 6)) == ["Ivanov", "6"]
    assert one(spark, X.to_text("a"), "a array<string>", (["x", None, "y"],), (None,)) == ["x; y", ""]
    assert one(spark, X.yes_no("b"), "b boolean", (True,), (False,), (None,)) == ["Да", "Нет", ""]
    assert one(spark, X.flag_text("x"), "x string", ("1.0",), ("0",), (None,)) == ["1", "0", None]
    assert one(spark, X.bool_text("b"), "b boolean", (True,), (None,)) == ["1", "0"]


def test_age_groups(spark):
    rows = [(18,), (17,), (None,)]
    assert one(spark, X.age_group("a"), "a long", *rows) == ["Взрослые", "Дети", "Не указано"]
    assert one(spark, X.age_group2("a"), "a long", *rows) == ["Взрослые", "Дети", "Дети"]


def test_coerce_defaults(spark):
    df = spark.createDataFrame([(None, "x", None)], "a string, b string, n string")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("d", T.DateType()), T.StructField("k", T.StringType())])
    out = coerce(df, schema, {"k": KEEP_NULL})
    assert out.columns == ["a", "n", "d", "k"]
    assert tuple(out.collect()[0]) == ("", 0, None, None)
    out2 = coerce(spark.createDataFrame([("",)], "a string"), T.StructType([T.StructField("a", T.StringType())]),
                  {"a": KEEP_NULL}, empty_as_null=("a",))
    assert out2.collect()[0][0] is None


def test_time_functions_ignore_session_zone(spark):
    """Same answers under a session zone with daylight saving."""
    rows = [(D(2024, 3, 10, 1, 30, 0, 500000), D(2024, 3, 10, 3, 30, 0, 250000))]
    s = "a timestamp_ntz, b timestamp_ntz"
    exprs = [X.to_local("a"), X.secs("a", "b"), X.minute_boundaries("a", "b"), X.hours_floor("a", "b"),
             X.parse_ts(F.lit("2024-03-10 02:30:00")), X.parse_ts(F.lit("2024-03-10T05:30:00+03:00"))]
    before = [one(spark, e, s, *rows)[0] for e in exprs]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        after = [one(spark, e, s, *rows)[0] for e in exprs]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after
    assert before == [D(2024, 3, 10, 4, 30, 0, 500000), 7200, 120, 2, D(2024, 3, 10, 2, 30), D(2024, 3, 10, 2, 30)]
