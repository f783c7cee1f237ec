import sys
import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F

from peerscore.functions import calendar, casts, display, numbers, text
from peerscore.operators import impute, quality, select
from peerscore.plans.settings import BENCHMARK_CODES, DEFAULT_BENCHMARK
from peerscore.schemas import struct


def _apply(rows, fn, *values, kind="string"):
    return [r.o for r in rows(f"i int, v {kind}", *enumerate(values)).select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_id(rows):
    assert _apply(rows, text.clean_id, "00.123.456/0001-99", "123", "", "no", None, "1234567890123456") == [
        "00123456000199", "00000000000123", "0" * 14, "0" * 14, None, "12345678901234",
    ]
    assert _apply(rows, text.clean_id_or_null, "1-2", "", "x", None) == ["00000000000012", None, None, None]


def test_normalise_text(rows):
    got = _apply(rows, text.normalise_text, "  Ação   de\n\tCRÉDITO ", "ÀÉÎÕÜ Ç", "ﬁm … ½", "áë", "Straße", None, "", "日本 ｱ", "x  y")
    assert got == ["acao de credito", "aeiou c", "fim ... 1⁄2", "ae", "straße", None, "", "日本 ア", "x y"]


def test_text_trim_and_label(rows):
    assert _apply(rows, text.text_trim, " a ", "\tb ", None) == ["a", "b", None]
    assert _apply(rows, lambda c: text.label_is(c, "Classe"), " CLASSE ", "subclasse", None) == [True, False, None]
    assert _apply(rows, text.file_stem, "/d/IMAB-Historico.XLS", "a.b.xlsx", "plain") == ["imab-historico", "a.b", "plain"]


def test_casts_are_strict_but_quiet(rows):
    assert _apply(rows, casts.to_double, "1.5", "1e3", " 1", "1d", "x", "", None, "-.5", "5.") == [1.5, 1000.0, None, None, None, None, None, -0.5, 5.0]
    assert _apply(rows, casts.to_long, "10", "10.0", " 10", "+7", "99999999999999999999", "x") == [10, None, None, 7, None, None]
    assert _apply(rows, casts.iso_date, "2024-01-05", "2024-1-5", "2024", "05/01/2024", "2024-02-30", "2024-01-05x") == [
        date(2024, 1, 5), date(2024, 1, 5), None, None, None, None,
    ]
    assert _apply(rows, casts.dmy_date, "05/01/2024", "2024-01-05") == [date(2024, 1, 5), None]
    assert _apply(rows, casts.null_tokens, "", "N/A", "NA", "n/a", "x") == [None, None, None, "n/a", "x"]


def test_numbers(rows):
    inf = float("inf")
    assert _apply(rows, numbers.finite, 1.0, inf, -inf, float("nan"), None, kind="double") == [1.0, None, None, None, None]
    assert _apply(rows, numbers.below_zero, 1.0, -2.0, 0.0, None, kind="double") == [0.0, -2.0, 0.0, None]
    assert _apply(rows, lambda c: numbers.spread_or_null(c, F.lit(-100.0)), 0.0, 1e-11, 0.1, None, kind="double") == [None, None, 0.1, None]
    assert _apply(rows, lambda c: numbers.spread_or_null(c, F.lit(1e-9)), 0.0, 1e-13, kind="double") == [None, 1e-13]


def test_days_since(rows):
    fn = lambda c: calendar.days_since(c, date(2024, 3, 1))
    assert _apply(rows, fn, date(2024, 2, 28), date(2025, 1, 1), None, kind="date") == [2, 0, None]


def test_display(rows):
    assert _apply(rows, display.money, 1.5e9, 2e6, 1500.0, 999.5, -3e6, None, kind="double") == [
        "R$ 1.50B", "R$ 2.00M", "R$ 1.50K", "R$ 999.50", "R$ -3.00M", "",
    ]
    assert _apply(rows, display.signed_percent, 0.1, -0.05, None, kind="double") == ["+10.00%", "-5.00%", ""]
    assert _apply(rows, display.plain_percent, 0.1, None, kind="double") == ["10.00%", ""]
    assert _apply(rows, display.thousands, 1234567, None, kind="bigint") == ["1,234,567", ""]
    assert _apply(rows, display.two_decimals, 3.14159, None, kind="double") == ["3.14", ""]
    assert _apply(rows, lambda c: display.entity_label(F.lit("C"), c), "S", "", None) == ["`C` (sub `S`)", "`C`", "`C`"]


def test_two_decimals_round_the_stored_double(rows):
    values = [2.675, 1.005, -1.005, 0.125, 0.375, 0.995, 0.005, 0.0049, 1e-9, -0.001, -0.0, 9.999, 999.995, 1234567.005, 2.0**52 + 0.5, 2.0**53, -7.285]
    values += [k / 1000 for k in range(5, 10_000, 10)] + [k / 8 + 1e6 for k in range(8)]
    assert _apply(rows, display.two_decimals, *values, kind="double") == [f"{v:.2f}" for v in values]
    assert _apply(rows, display.money, 1005.0, 2985.0, 3125.0, 999.999, 999_999.0, 1.2345e13, kind="double") == [
        "R$ 1.00K", "R$ 2.98K", "R$ 3.12K", "R$ 1,000.00", "R$ 1000.00K", "R$ 12345.00B",
    ]
    assert _apply(rows, display.signed_percent, 0.02675, -0.00125, 0.0, kind="double") == [f"{v * 100:+.2f}%" for v in (0.02675, -0.00125, 0.0)]


def test_find_column_and_conform(rows):
    df = rows("`CNPJ Fundo ` string, n int", ("a", 1))
    assert select.find_column(df, "nope", "cnpj fundo") == "CNPJ Fundo "
    assert select.find_column(df, "nope") is None
    out = select.conform(df, struct("n bigint, absent double"))
    assert out.dtypes == [("n", "bigint"), ("absent", "double")] and out.collect()[0].absent is None


def test_predicates_drop_nulls(rows):
    df = rows("label string, d date", ("Renda Fixa Simples", date(2024, 1, 1)), ("renda fixa", None), (None, date(2025, 1, 1)))
    assert select.with_prefix(df, "label", "Renda Fixa").count() == 1
    assert select.on_or_before(df, "d", date(2024, 1, 1)).count() == 1
    assert select.among(df, "label", ["renda fixa"]).count() == 1
    assert select.with_label(df, None, "x").count() == 3


FEE = "taxa_adm double"


def _stats(rows, *values):
    return impute.mode_bounds(rows(FEE, *[(v,) for v in values]), ["taxa_adm"]).collect()[0]


def test_mode_and_bounds(rows):
    assert _stats(rows, 0.0, 0.0, 0.0, 0.005, 0.01).mode == 0.0
    s = _stats(rows, None, 0.005, 0.005, None, 0.01)
    assert s.mode == 0.005 and s.mean == pytest.approx(0.02 / 3)
    s = _stats(rows, 0.0, 0.005, 0.01, 0.02, 10.0)
    assert (s.mean, s.lo, s.hi) == (pytest.approx(2.007), pytest.approx(-11.398, abs=1e-3), pytest.approx(15.412, abs=1e-3))
    assert _stats(rows, 0.2, 0.1, 0.2, 0.1).mode == 0.1
    s = _stats(rows, 0.3)
    assert (s.std, s.lo, s.hi) == (0.0, 0.3, 0.3)
    s = _stats(rows, None, None)
    assert (s.mode, s.mean, s.std, s.lo, s.hi) == (None,) * 5


def _impute(rows, stats, *values):
    frame = rows("column string, mode double, lo double, hi double", stats)
    out = impute.impute_with_mode(rows("i int, taxa_adm double", *enumerate(values)), ["taxa_adm"], frame)
    return [r.taxa_adm for r in out.orderBy("i").collect()]


def test_imputation(rows):
    bounds = ("taxa_adm", 0.005, 0.002, 0.008)
    assert _impute(rows, bounds, None, 0.0, 0.01, 0.003, 0.007, 0.002, 0.008) == [0.005, 0.005, 0.005, 0.003, 0.007, 0.002, 0.008]
    assert _impute(rows, ("taxa_adm", None, None, None), None, 0.1) == [None, 0.1]
    assert _impute(rows, ("other", 1.0, 1.0, 1.0), None, 0.1) == [None, 0.1]


def test_benchmark_labels(rows):
    df = rows("benchmark string", ("Taxa Selic",), ("Índice de preços",), ("Never Heard",), (None,))
    got = [r.benchmark for r in impute.map_labels(df, "benchmark", BENCHMARK_CODES, DEFAULT_BENCHMARK).collect()]
    assert got == ["CDI", "IPCA", "Never Heard", "CDI"]
    assert len(BENCHMARK_CODES) == 18 and len(set(BENCHMARK_CODES.values())) == 10


def test_key_counts_count_null(rows):
    got = quality.key_counts(rows("k int", (None,), (None,), (1,)), ["k"]).collect()[0]
    assert (got.rows, got.distinct_keys, got.duplicates) == (3, 2, 1)
    empty = quality.key_counts(rows("k int", (1,)).filter("k > 1"), ["k"]).collect()[0]
    assert (empty.rows, empty.distinct_keys, empty.duplicates) == (0, 0, 0)


def test_null_counts(rows):
    got = {r.column: (r.nulls, r.pct) for r in quality.null_counts(rows("a int, b int", (None, 1), (2, 2)), ["a", "b", "c"]).collect()}
    assert got == {"a": (1, 50.0), "b": (0, 0.0), "c": (None, None)}


def test_score_profile(rows):
    df = rows("score double", (0.0,), (19.99,), (20.0,), (100.0,), (None,))
    assert [r.n for r in quality.score_buckets(df).collect()] == [2, 1, 0, 0, 1]
    s = quality.score_summary(df).collect()[0]
    assert (s.n, s.min, s.median, s.max) == (4, 0.0, pytest.approx(19.995), 100.0)
    nothing = df.filter("score > 1000")
    assert quality.score_buckets(nothing).count() == 0 and quality.score_summary(nothing).count() == 0


def test_coverage_lists_empty_series(rows):
    df = rows("data date, a double, b double", (date(2024, 1, 1), 1.0, None), (date(2024, 1, 3), 2.0, None), (date(2024, 1, 5), None, None))
    got = {r.series: (r.n, r.first_date, r.last_date) for r in quality.series_coverage(df, ["a", "b"]).collect()}
    assert got == {"a": (2, date(2024, 1, 1), date(2024, 1, 3)), "b": (0, None, None)}


def test_top_duplicates(rows):
    df = rows("k string", *[(k,) for k in "aabbbc"], (None,), (None,))
    assert [(r.k, r.n) for r in quality.top_duplicates(df, "k").collect()] == [("b", 3), (None, 2), ("a", 2)]
    assert quality.top_duplicates(df, "k", 1).count() == 1


def test_observed_counts_ride_on_the_job(rows):
    df, seen = quality.observe_step(rows("k int", (1,), (2,)), "step", F.max("k").alias("top"))
    df.filter("k > 1").collect()
    assert seen.get == {"rows": 2, "top": 2}


def test_steps_beside_an_empty_table_are_no_error(spark, rows):
    steps = quality.StepCounts()
    watch = steps.of("t")
    df = watch(watch(rows("k int, day date", (1, date(2024, 1, 2)), (2, None)), "read", "day", odd=F.count_if(F.col("k") % 2 == 1)).filter("k > rand() + 5"), "cut")
    watch(df.groupBy("k").count(), "kept").collect()
    got = {r.item: (r.n, r.first_date) for r in steps.report(spark).collect()}
    assert got["kept"] == (0, None) and set(got) >= {"read", "cut", "kept"}
    assert got["read"] in ((2, date(2024, 1, 2)), (None, None))


@pytest.mark.parametrize("keys", [["k"], ["k", "v"]])
def test_a_profile_is_one_scan(spark, tmp_path, keys):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None), ("b", 3), ("b", 3)], "k string, v int").write.parquet(path)
    df = spark.read.parquet(path)
    out = quality.profile_table(df, "t", keys, ["k", "v", "absent"])
    got = {(r.check, r.item): (r.n, r.value) for r in out.collect()}
    assert got["nulls", "k"] == (1, pytest.approx(100 / 6)) and got["nulls", "v"] == (1, pytest.approx(100 / 6)) and got["nulls", "absent"] == (None, None)
    want = quality.key_counts(df, keys).first()
    assert [got["keys", c][0] for c in ("rows", "distinct_keys", "duplicates")] == [want.rows, want.distinct_keys, want.duplicates]
    assert {i: n for (c, i), (n, _) in got.items() if c == "top_duplicates"} == ({"a": 2, "b": 3} if keys == ["k"] else {})
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan") == 1, plan


def test_every_code_point_decomposes(spark):
    """All of Unicode, Hangul included, against the Unicode data Python ships."""
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    blocks = ["".join(map(chr, points[i : i + 500])) for i in range(0, len(points), 500)]
    df = spark.createDataFrame(list(enumerate(blocks)), "i int, t string")
    got = {r.i: r.x for r in df.select("i", text.strip_accents(F.col("t")).alias("x")).collect()}
    for i, block in enumerate(blocks):
        want = "".join(c for ch in block for c in unicodedata.normalize("NFKD", ch) if not 0x300 <= ord(c) < 0x370)
        assert got[i] == want, hex(ord(block[0]))


def test_common_forms_parse_as_the_general_way(rows):
    days = ["2021-01-05", "2021-1-5", "2021-02-30", "2020-02-29", "1500-02-29", "0000-01-01", "0001-01-01", "9999-12-31", "2021-13-01", "2021-10-00"]
    days += [" 2021-01-05", "2021-01-05 ", "2021-01-05\n", "2021-01-05T00", "+2021-01-05", "12021-01-05", "202-01-05", "2021-001-05", "", "n/d", "٢٠٢١-01-05", None]
    df = rows("v string", *[(d,) for d in days]).select("v", casts.iso_date(F.col("v")).cast("string").alias("got"), F.try_to_date("v", "yyyy-M-d").cast("string").alias("want"))
    assert [r.v for r in df.collect() if r.got != r.want] == []
    numbers = ["7", "-7", "+7", "7.", ".5", "-7.25", "--7", "7.2.5", "7 ", "7d", "1e3", "0012.50", "1" * 400, "NaN", "-inf", "", None]
    general = F.when(F.col("v").rlike(casts._DECIMAL), F.col("v").try_cast("double"))
    df = rows("v string", *[(n,) for n in numbers]).select("v", casts.to_double(F.col("v")).alias("got"), general.alias("want"))
    assert [r.v for r in df.collect() if str(r.got) != str(r.want)] == []


def test_ids_of_many_other_characters(rows):
    df = rows("v string", ("00.CN-/7--",), ("-- ",), ("٢ x",), (None,)).select(text.clean_id(F.col("v")).alias("id"))
    assert [r.id for r in df.collect()] == ["0" * 13 + "7", "0" * 14, "0" * 13 + "٢", None]
