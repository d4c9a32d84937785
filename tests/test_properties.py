"""Property tests (hypothesis): Spark expressions against plain-Python rules."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from periodica.functions.formats import parse_date_any
from periodica.functions.periods import FREQUENCIES, window_for
from periodica.functions.scalar import zero_pad


@given(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2500, 12, 31)),
       st.sampled_from(FREQUENCIES))
def test_window_contains_day(d, f):
    w = window_for(d, f)
    assert w.start <= d < w.end
    assert window_for(w.start, f) == w and window_for(w.end - dt.timedelta(days=1), f) == w


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=10 ** 9)), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=8))
def test_zero_pad_matches_rule(spark, values, width):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in df.select(zero_pad("v", width)).collect()]
    want = [None if v is None else ("0" * width + str(v))[-width:] for v in values]
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.dates(min_value=dt.date(1000, 1, 1), max_value=dt.date(9999, 12, 31)),
                          st.sampled_from(["%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y"])), min_size=1, max_size=30))
def test_parse_any_form(spark, items):
    df = spark.createDataFrame([(d.strftime(f),) for d, f in items], "s string")
    got = [r[0] for r in df.select(parse_date_any("s")).collect()]
    assert got == [d for d, _ in items]
