"""X-1 .. X-22 scalar expressions and the declared types (V2)."""
import datetime as dt
import decimal

from pyspark.sql import functions as F

from periodica.functions.formats import format_from_layout, parse_date_any, render_date
from periodica.functions.scalar import concat_poisoned, seconds_between, tsql_left, tsql_len, zero_pad
from periodica.functions.types import misfit, parse_type, typed


def test_zero_pad_keeps_right_end(spark):
    df = spark.createDataFrame([("1234567",), ("780",), (None,)], "k string")
    got = [r[0] for r in df.select(zero_pad("k", 6)).collect()]
    assert got == ["234567", "000780", None]
    # the trap: lpad keeps the left end
    assert df.select(F.lpad("k", 6, "0")).first()[0] == "123456"


def test_len_left_concat(spark):
    df = spark.createDataFrame([("abc  ", None)], "a string, b string")
    r = df.select(tsql_len("a"), tsql_left("a", 2), concat_poisoned("a", "b")).first()
    assert (r[0], r[1], r[2]) == (3, "ab", None)


def test_seconds_between(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 0, 0, 0, 900000), dt.datetime(2026, 1, 1, 0, 0, 1, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between("a", "b")).first()[0] == 1  # one boundary crossed


def test_render_formats_and_null(spark):
    df = spark.createDataFrame([(dt.date(2026, 6, 5),), (None,)], "d date")
    got = df.select(render_date("d", "yyyy/MM/dd"), render_date("d", "dd/MM/yyyy"),
                    render_date("d", "yyyy-MM-dd")).collect()
    assert tuple(got[0]) == ("2026/06/05", "05/06/2026", "2026-06-05")
    assert tuple(got[1]) == (None, None, None)


def test_layout_format_words():
    assert format_from_layout("AAAAMMDD") == "yyyy/MM/dd"  # code wins over the note
    assert format_from_layout("DD/MM/AAAA") == "dd/MM/yyyy"
    assert format_from_layout(None) == "yyyy/MM/dd"


def test_parse_three_input_forms(spark):
    df = spark.createDataFrame([("2026-04-17",), ("2026/04/17",), ("17/04/2026",), ("2026/13/01",),
                                ("17.04.2026",), ("",)], "s string")
    got = [r[0] for r in df.select(parse_date_any("s")).collect()]
    d = dt.date(2026, 4, 17)
    assert got == [d, d, d, None, None, None]


def test_types_and_misfits(spark):
    assert parse_type("numeric(12,6)").spark.simpleString() == "decimal(12,6)"
    assert parse_type("varchar(3)").length == 3
    df = spark.createDataFrame([("1.005", "ab  ", "abcd"), ("1000", "abc", "x")], "n string, a string, b string")
    t52 = parse_type("numeric(5,2)")
    r = df.select(typed("n", t52).alias("v"), misfit("n", t52).alias("m"),
                  misfit("a", parse_type("varchar(3)")).alias("ma"),
                  misfit("b", parse_type("varchar(3)")).alias("mb")).collect()
    assert r[0]["v"] == decimal.Decimal("1.01") and not r[0]["m"]  # excess scale rounds half up
    assert r[1]["v"] is None and r[1]["m"]                           # excess precision
    assert not r[0]["ma"] and r[0]["mb"]                              # trailing blanks ignored


def test_double_fast_path_matches_exact_cast(spark):
    """The range shortcut for doubles gives the same answer as the decimal cast,
    including values one rounding step around the bound, NaN and infinity."""
    from pyspark.sql import types as T
    vals = [99999.994, 99999.99499, 99999.995, 99999.9951, 99999.996, 100000.0, -99999.995,
            0.0, 1e300, float("nan"), float("inf"), None, 12.345, 99999.98]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    t = parse_type("numeric(7,2)")
    got = df.select(misfit("x", t, T.DoubleType()).alias("fast"), misfit("x", t).alias("exact")).collect()
    assert [r["fast"] for r in got] == [r["exact"] for r in got]


def test_compact_date_literal():
    from periodica.functions.formats import compact_date
    assert compact_date("19000101") == "1900-01-01"
