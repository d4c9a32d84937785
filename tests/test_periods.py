"""Window bounds on the driver and as Spark expressions."""
import datetime as dt

from pyspark.sql import functions as F

from periodica.functions.periods import (DAILY, MONTHLY, QUARTERLY, WEEKLY, in_window,
                                         minute_rounded, period_end, period_start,
                                         weekday_offset_start, window_for)


def test_weekly_starts_monday():
    assert window_for(dt.date(2026, 6, 21), WEEKLY).start == dt.date(2026, 6, 15)  # Sunday
    assert window_for(dt.date(2026, 6, 15), WEEKLY).start == dt.date(2026, 6, 15)  # Monday
    assert window_for(dt.date(2026, 6, 21), WEEKLY).end == dt.date(2026, 6, 22)


def test_monthly_quarterly_daily():
    w = window_for(dt.date(2026, 12, 31), MONTHLY)
    assert (w.start, w.end) == (dt.date(2026, 12, 1), dt.date(2027, 1, 1))
    q = window_for(dt.date(2026, 5, 15), QUARTERLY)
    assert (q.start, q.end) == (dt.date(2026, 4, 1), dt.date(2026, 7, 1))
    d = window_for("2026/02/28", DAILY)
    assert (d.start, d.end) == (dt.date(2026, 2, 28), dt.date(2026, 3, 1))


def test_datetime_parameter_cast_first():
    """A DATETIME with a time part selects its day, not nothing."""
    w = window_for(dt.datetime(2026, 6, 3, 17, 45), DAILY)
    assert w.contains(dt.date(2026, 6, 3))


def test_bounds_property_every_day_2023_2028():
    d = dt.date(2023, 1, 1)
    while d < dt.date(2029, 1, 1):
        for f, lens in ((DAILY, {1}), (WEEKLY, {7}), (MONTHLY, {28, 29, 30, 31}),
                        (QUARTERLY, {90, 91, 92})):
            w = window_for(d, f)
            assert w.contains(d) and w.days in lens, (d, f)
        d += dt.timedelta(days=1)


def test_column_bounds_match_driver(spark):
    days = [(dt.date(2023, 1, 1) + dt.timedelta(days=i),) for i in range(0, 2200, 3)]
    df = spark.createDataFrame(days, "d date")
    rows = df.select("d", *[period_start("d", f).alias(f"s_{f}") for f in (DAILY, WEEKLY, MONTHLY, QUARTERLY)],
                     *[period_end("d", f).alias(f"e_{f}") for f in (DAILY, WEEKLY, MONTHLY, QUARTERLY)],
                     weekday_offset_start("d").alias("ref")).collect()
    for r in rows:
        for f in (DAILY, WEEKLY, MONTHLY, QUARTERLY):
            w = window_for(r["d"], f)
            assert (r[f"s_{f}"], r[f"e_{f}"]) == (w.start, w.end)
        assert r["ref"] == r[f"s_{WEEKLY}"]  # the legacy weekday formula


def test_half_open_and_null(spark):
    w = window_for(dt.date(2026, 6, 10), MONTHLY)
    df = spark.createDataFrame([(dt.date(2026, 5, 31),), (dt.date(2026, 6, 1),), (dt.date(2026, 6, 30),),
                                (dt.date(2026, 7, 1),), (None,)], "d date")
    got = sorted(r["d"] for r in df.where(in_window("d", w)).collect())
    assert got == [dt.date(2026, 6, 1), dt.date(2026, 6, 30)]  # F2, F3


def test_minute_rounding(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 10, 0, 29),), (dt.datetime(2026, 1, 1, 10, 0, 30),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(minute_rounded("ts")).collect()]
    assert got == [dt.datetime(2026, 1, 1, 10, 0), dt.datetime(2026, 1, 1, 10, 1)]


def test_window_filter_is_pushed_down(spark):
    """The range reaches the Parquet scan (PushedFilters), no function wraps the column."""
    w = window_for(dt.date(1995, 3, 15), MONTHLY)
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where(in_window("o_orderdate", w))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert df.count() == df.where(F.to_date("o_orderdate").between(w.start, w.end - dt.timedelta(days=1))).count()
