from datetime import date, timedelta
from math import log

import pytest
from pyspark.sql import functions as F

from peerscore.operators import returns

SERIES = "fund_key string, dt_comptc date, vl_quota double"


def _days(key, levels, start=date(2024, 1, 1)):
    return [(key, start + timedelta(days=i), v) for i, v in enumerate(levels)]


def test_log_return_starts_with_null(rows):
    out = returns.daily_log_returns(rows(SERIES, *_days("F1", [100.0, 101.0, 102.0]))).orderBy("dt_comptc").collect()
    assert out[0].log_ret is None
    assert out[1].log_ret == pytest.approx(log(1.01))
    assert out[2].log_ret == pytest.approx(log(102 / 101))


def test_log_return_does_not_cross_entities(rows):
    df = rows(SERIES, *_days("A", [100.0, 110.0]), *_days("B", [50.0, 55.0]))
    firsts = [r.log_ret for r in returns.daily_log_returns(df).collect() if r.dt_comptc == date(2024, 1, 1)]
    assert firsts == [None, None]


@pytest.mark.parametrize("bad", [0.0, -5.0, None])
def test_log_return_is_null_around_a_level_that_is_not_positive(rows, bad):
    df = rows(SERIES, *_days("A", [100.0, bad, 110.0, 120.0]))
    got = [r.log_ret for r in returns.daily_log_returns(df).orderBy("dt_comptc").collect()]
    assert got[:3] == [None, None, None]
    assert got[3] == pytest.approx(log(120 / 110))


def _growing_then(levels, last):
    series = [100.0 * 1.0001**i for i in range(levels)]
    return series + [series[-1] * last]


def test_jump_on_the_last_of_seventy_days(rows):
    df = returns.daily_log_returns(rows(SERIES, *_days("A", _growing_then(69, 2.0))))
    flags = [r.is_jump for r in returns.flag_jumps(df).orderBy("dt_comptc").collect()]
    assert flags[-1] is True
    assert not any(flags[:-1])


def test_window_with_too_few_returns_flags_nothing(rows):
    df = returns.daily_log_returns(rows(SERIES, *_days("A", _growing_then(59, 2.0))))
    assert returns.flag_jumps(df).filter("is_jump").count() == 0
    assert returns.flag_jumps(df, window=20, sigma=4.0).filter("is_jump").count() == 1


def test_five_sigma_is_out_of_reach_for_short_windows(rows):
    df = returns.daily_log_returns(rows(SERIES, *_days("A", _growing_then(40, 2.0))))
    assert returns.flag_jumps(df, window=26, sigma=5.0).filter("is_jump").count() == 0


def test_drop_jumps_keeps_the_other_rows(rows):
    df = rows("k string, is_jump boolean", ("a", True), ("b", False))
    assert [r.k for r in returns.drop_jumps(df).collect()] == ["b"]


def test_monthly_returns_use_the_last_day(rows):
    df = rows(
        SERIES,
        ("F1", date(2024, 1, 5), 100.0),
        ("F1", date(2024, 1, 31), 110.0),
        ("F1", date(2024, 2, 1), 110.0),
        ("F1", date(2024, 2, 29), 121.0),
    )
    out = returns.monthly_returns(df).orderBy("year_month").collect()
    assert [r.year_month for r in out] == [date(2024, 1, 1), date(2024, 2, 1)]
    assert out[0].monthly_ret is None
    assert out[1].monthly_ret == pytest.approx(0.10)


def test_month_end_keeps_a_null_level(rows):
    df = rows(SERIES, ("F1", date(2024, 1, 5), 100.0), ("F1", date(2024, 1, 31), None))
    assert returns.month_end_levels(df).collect()[0].vl_quota_eom is None


def test_null_month_counts_as_unchanged(rows):
    df = rows("k string, m int, v double", ("a", 1, 100.0), ("a", 2, None), ("a", 3, 110.0))
    got = [r.p for r in returns.period_change(df, "v", "m", "p", "k").orderBy("m").collect()]
    assert got[0] is None and got[1] == 0.0 and got[2] == pytest.approx(0.10)
    strict = [r.p for r in returns.period_change(df, "v", "m", "p", "k", carry_forward=False).orderBy("m").collect()]
    assert strict == [None, None, None]


def test_daily_chain_needs_one_exchange(spark, rows):
    """From the keyed series to flags: one exchange and one sort."""
    df = rows(SERIES, *_days("A", [100.0, 101.0]))
    plan = returns.flag_jumps(returns.daily_log_returns(df))._jdf.queryExecution().sparkPlan().toString()
    executed = returns.flag_jumps(returns.daily_log_returns(df))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = executed.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Window" in plan
    assert text.count("Exchange") == 1
    assert text.count("Sort [") == 1


def test_flags_do_not_depend_on_input_order(rows):
    data = _days("A", _growing_then(69, 2.0))
    a = returns.flag_jumps(returns.daily_log_returns(rows(SERIES, *data)))
    b = returns.flag_jumps(returns.daily_log_returns(rows(SERIES, *data[::-1]).repartition(3)))
    assert a.filter("is_jump").select("dt_comptc").collect() == b.filter("is_jump").select("dt_comptc").collect()
    assert a.agg(F.count("*")).collect() == b.agg(F.count("*")).collect()
