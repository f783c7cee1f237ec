from datetime import date
from math import sqrt
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from peerscore.operators import metrics, returns
from peerscore.plans.settings import TAX_RATES

MONTHLY = "fund_key string, year_month date, monthly_ret double"
REFERENCE = "year_month date, benchmark_code string, monthly_bench_ret double"
DIM = "fund_key string, benchmark string"


def _months(n):
    return [date(2023 + i // 12, i % 12 + 1, 1) for i in range(n)]


def _frames(rows, values, ref=0.008):
    months = _months(len(values))
    return (
        rows(DIM, ("F1", "CDI"), ("F2", "CDI")),
        rows(MONTHLY, *[("F1", m, v) for m, v in zip(months, values)]),
        rows(REFERENCE, *[(m, "CDI", ref) for m in months]),
    )


def _by_key(df, col):
    return {r.fund_key: r[col] for r in df.collect()}


def test_information_ratio(rows):
    values = [0.012, 0.013, 0.014, 0.011, 0.013, 0.015] * 2
    dim, monthly, ref = _frames(rows, values)
    got = _by_key(metrics.attach_information_ratio(dim, monthly, ref), "information_ratio")
    excess = [v - 0.008 for v in values]
    assert got["F1"] == pytest.approx(mean(excess) / stdev(excess) * sqrt(12))
    assert got["F1"] == pytest.approx(12.8452, abs=1e-3)
    assert got["F2"] is None


def test_information_ratio_without_tracking_error_is_null(rows):
    dim, monthly, ref = _frames(rows, [0.008] * 12)
    assert _by_key(metrics.attach_information_ratio(dim, monthly, ref), "information_ratio")["F1"] is None


def test_one_month_is_not_enough(rows):
    dim, monthly, ref = _frames(rows, [0.02])
    assert _by_key(metrics.attach_information_ratio(dim, monthly, ref), "information_ratio")["F1"] is None


def test_sortino_ratio(rows):
    dim, monthly, ref = _frames(rows, [0.013] * 11 + [-0.002])
    got = _by_key(metrics.attach_sortino_ratio(dim, monthly, ref), "sortino_ratio")
    excess = [0.005] * 11 + [-0.010]
    negative = [min(e, 0) for e in excess]
    assert got["F1"] == pytest.approx(mean(excess) * 12 / (stdev(negative) * sqrt(12)))
    assert got["F1"] == pytest.approx(4.5, abs=1e-6)


def test_sortino_without_downside_is_null(rows):
    dim, monthly, ref = _frames(rows, [0.013, 0.012, 0.011])
    assert _by_key(metrics.attach_sortino_ratio(dim, monthly, ref), "sortino_ratio")["F1"] is None


def test_excess_needs_both_sides(rows):
    months = _months(3)
    dim = rows(DIM, ("F1", "CDI"), ("F2", "GOLD"))
    monthly = rows(MONTHLY, ("F1", months[0], None), ("F1", months[1], 0.1), ("F1", months[2], 0.2), ("F2", months[1], 0.1))
    ref = rows(REFERENCE, (months[0], "CDI", 0.01), (months[1], "CDI", 0.02), (months[2], "CDI", None))
    out = metrics.excess_returns(monthly, dim, ref).collect()
    assert [(r.fund_key, r.year_month) for r in out] == [("F1", months[1])]


def test_label_efficiency(rows):
    labels = ["Isento", "Longo Prazo", "Curto Prazo", "Previdenciário", "Alíquota de 15%", "Não Aplicável", "Indefinido", "???", None]
    dim = rows("fund_key string, tributacao_alvo string", *[(f"F{i}", v) for i, v in enumerate(labels)])
    got = _by_key(metrics.attach_label_efficiency(dim, TAX_RATES), "tax_efficiency")
    assert [got[f"F{i}"] for i in range(5)] == pytest.approx([1.0, 0.85, 0.80, 0.90, 0.85])
    assert [got[f"F{i}"] for i in range(5, 9)] == [None] * 4
    assert set(_by_key(metrics.attach_label_efficiency(dim, {}), "tax_efficiency").values()) == {None}


SERIES = "fund_key string, dt_comptc date, vl_quota double, vl_patrim_liq double, nr_cotst bigint"


def test_latest_attributes_skip_nulls(rows):
    series = rows(
        SERIES,
        ("F1", date(2024, 1, 1), 1.0, 10.0, 5),
        ("F1", date(2024, 1, 2), 1.0, 20.0, None),
        ("F1", date(2024, 1, 3), 1.0, None, None),
    )
    dim = rows("fund_key string", ("F1",), ("F2",))
    assert _by_key(metrics.attach_equity(dim, series), "equity") == {"F1": 20.0, "F2": None}
    assert _by_key(metrics.attach_holders(dim, series), "nr_cotst") == {"F1": 5, "F2": 0}


def test_age_in_days(rows):
    dim = rows(
        "fund_key string, data_de_inicio date",
        ("F1", date(2023, 1, 1)), ("F2", date(2024, 6, 15)), ("F3", date(2026, 1, 1)), ("F4", None),
    )
    got = _by_key(metrics.attach_age(dim, date(2025, 1, 1)), "existing_time")
    assert got == {"F1": 731, "F2": 200, "F3": 0, "F4": None}


def _composed(dim, flagged, ref):
    monthly = returns.monthly_returns(returns.drop_jumps(flagged))
    out = metrics.attach_information_ratio(dim, monthly, ref)
    out = metrics.attach_sortino_ratio(out, monthly, ref)
    return metrics.attach_holders(metrics.attach_equity(out, flagged), flagged)


def test_one_pass_statistics_equal_the_composed_chain(rows):
    """Jumps (a whole month of them too), null levels and null attributes."""
    data = []
    for f, key in enumerate(["A", "B", "C"]):
        for i in range(240):
            m, d = divmod(i, 20)
            level = None if (i + f) % 37 == 0 else 100.0 + f + i * 0.3 + ((i * 7 + f * 3) % 11)
            jump = (i % 23 == 5) or (key == "B" and m == 4)
            data.append((key, date(2023, m + 1, d + 1), level, None if i % 3 else float(i), None if i % 5 else i, jump, "CDI"))
    flagged = rows(SERIES + ", is_jump boolean, benchmark string", *data)
    ref = rows(REFERENCE, *[(m, "CDI", 0.001 * (i % 4)) for i, m in enumerate(_months(12))])
    dim = rows(DIM, ("A", "CDI"), ("B", "CDI"), ("C", "CDI"))
    want = {r.fund_key: r for r in _composed(dim, flagged, ref).collect()}
    got = metrics.entity_statistics(flagged, ref).select(
        "fund_key",
        metrics.information_ratio_expr().alias("information_ratio"),
        metrics.sortino_ratio_expr().alias("sortino_ratio"),
        "equity",
        "nr_cotst",
    )
    assert {r.fund_key for r in got.collect()} == set(want)
    for r in got.collect():
        w = want[r.fund_key]
        assert r.information_ratio == pytest.approx(w.information_ratio)
        assert r.sortino_ratio == pytest.approx(w.sortino_ratio)
        assert (r.equity, r.nr_cotst) == (w.equity, w.nr_cotst)


def test_metric_registry_attaches_by_name(rows):
    dim, monthly, ref = _frames(rows, [0.012, 0.013, 0.014])
    dim = dim.withColumn("tributacao_alvo", F.lit("Isento")).withColumn("data_de_inicio", F.lit(date(2020, 1, 1)))
    series = rows(SERIES, ("F1", date(2024, 1, 1), 1.0, 10.0, 5))
    inputs = metrics.MetricInputs(monthly, ref, series, date(2025, 1, 1), TAX_RATES)
    out = metrics.attach_metrics(dim, list(metrics.METRICS), inputs)
    assert set(metrics.METRICS) <= set(out.columns)
    assert out.count() == 2
