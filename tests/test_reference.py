from datetime import date

import pytest
from pyspark.sql import functions as F

from peerscore.operators import reference
from peerscore.plans import reference_series
from peerscore.plans.settings import LEVEL_FILE_STEMS, REFERENCE_COLUMNS, REFERENCE_UNITS

D = date


def test_percents_compound_over_known_days(rows):
    df = rows("r double", (1.0,), (None,), (2.0,))
    assert df.agg(reference.compounded(F.col("r")).alias("x")).collect()[0].x == pytest.approx(0.0302)


def test_first_published_value(rows):
    df = rows("d date, r double", (D(2024, 1, 3), None), (D(2024, 1, 1), 0.62), (D(2024, 1, 2), 0.9))
    assert df.agg(reference.first_published(F.col("r"), F.col("d")).alias("x")).collect()[0].x == pytest.approx(0.0062)


def test_level_series_drops_its_first_month(rows):
    df = rows("series string, data date, valor double",
              ("a", D(2024, 1, 31), 100.0), ("a", D(2024, 2, 10), 105.0), ("a", D(2024, 2, 28), None))
    out = reference.level_returns(df).collect()
    assert [(r.year_month, round(r.monthly_bench_ret, 9)) for r in out] == [(D(2024, 2, 1), 0.05)]


def test_all_units_at_once(rows):
    wide = rows(
        "data date, cdi double, ipca double, ima_b double",
        (D(2024, 1, 30), 1.0, None, 100.0), (D(2024, 1, 31), 2.0, 0.5, 110.0), (D(2024, 2, 1), None, None, None),
        (D(2024, 2, 28), 1.0, 0.7, 121.0),
    )
    got = {(r.benchmark_code, r.year_month): round(r.monthly_bench_ret, 9)
           for r in reference.monthly_reference_returns(wide, REFERENCE_UNITS).collect()}
    assert got == {
        ("CDI", D(2024, 1, 1)): 0.0302, ("CDI", D(2024, 2, 1)): 0.01,
        ("IPCA", D(2024, 1, 1)): 0.005, ("IPCA", D(2024, 2, 1)): 0.007,
        ("IMA-B", D(2024, 2, 1)): 0.1,
    }


def test_wide_table_is_a_full_join(rows):
    a = rows("data date, valor double", (D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.0), (D(2030, 1, 1), 9.0))
    b = rows("data date, valor double", (D(2024, 1, 3), 3.0))
    wide = reference_series.index_series({"cdi": a, "ipca": b}, D(2024, 12, 31))
    assert wide.columns == ["data", *REFERENCE_COLUMNS]
    assert dict(wide.dtypes)["irf_m"] == "double"
    got = [(r.data.day, r.cdi, r.ipca, r.irf_m) for r in wide.orderBy("data").collect()]
    assert got == [(1, 1.0, None, None), (2, 2.0, None, None), (3, None, 3.0, None)]


def test_missing_essentials(rows):
    a = rows("data date, valor double", (D(2024, 1, 1), 1.0))
    out = reference_series.missing_essentials({"cdi": a, "ipca": a.filter("valor > 5")})
    assert sorted(r.code for r in out.collect()) == ["ipca", "selic"]


def test_settings_cover_every_series():
    assert len(REFERENCE_COLUMNS) == 11 and len(LEVEL_FILE_STEMS) == 6
    assert set(REFERENCE_UNITS) == set(REFERENCE_COLUMNS) - {"selic"}
