from datetime import date

from pyspark.sql import functions as F

from peerscore.operators import anchors, dedup, match, select
from peerscore.schemas import struct


def test_parents_with_children_are_dropped(rows):
    parents = rows("ID bigint, name string", (10, "a"), (20, "b"), (30, "c"))
    children = rows("ID bigint", (20,), (20,), (None,))
    kept = match.drop_parents_with_children(parents, children, "ID")
    assert {r.ID for r in kept.collect()} == {10, 30}


def test_empty_or_keyless_children_drop_nobody(spark, rows):
    parents = rows("ID bigint", (10,), (None,))
    assert match.drop_parents_with_children(parents, select.empty_frame(spark, struct("ID bigint")), "ID").count() == 2
    assert match.drop_parents_with_children(parents, rows("other bigint", (10,)), "ID").count() == 2


def test_hierarchy_does_not_fan_out(rows):
    child = rows("cls bigint, sub string", (1, "s1"), (2, "s2"), (9, "s9"))
    parent = rows("cls bigint, fund bigint, cnpj string, line int", (1, 7, "late", 2), (1, 7, "early", 1), (2, 8, "c2", 3))
    grand = rows("fund bigint, name string, line int", (7, "F7", 1), (7, "F7 again", 2))
    out = match.hierarchy_chain(child, parent, grand, "cls", "fund", ["line"])
    assert out.columns == ["sub", "cnpj", "name"]
    assert {tuple(r) for r in out.collect()} == {("s1", "early", "F7"), ("s2", "c2", None), ("s9", None, None)}


BASE = "id_subclasse_cvm string, cnpj_fundo string, cnpj_classe string"
ATTRS = "codigo string, cnpj_fundo string, cnpj_classe string, label string, extra string, line int"


def _two_pass(rows, attrs):
    base = rows(BASE, ("S1", "f", "c"), ("S2", "f", "c2"), ("S3", "x", "x"), (None, "f", "c"))
    frame = rows(ATTRS, *attrs)
    args = (base, frame, "id_subclasse_cvm", "codigo", ["cnpj_fundo", "cnpj_classe"], ["label", "extra"], ["line"])
    out = {r.id_subclasse_cvm: (r.label, r.extra) for r in match.two_pass_match(*args).collect()}
    return out, match.match_breakdown(*args).collect()[0].asDict()


def test_exact_id_wins_and_is_filled_per_column(rows):
    out, counts = _two_pass(
        rows, [("S1", "z", "z", "PRECISE", None, 1), (None, "f", "c", "LOOSE", "loose extra", 2)]
    )
    assert out["S1"] == ("PRECISE", "loose extra")
    assert out["S2"] == (None, None)
    assert out[None] == ("LOOSE", "loose extra")
    assert counts == {"pass1_matched": 1, "pass2_matched": 1, "unmatched": 2, "ambiguity_dropped": 0}


def test_fallback_keeps_the_first_and_counts_the_rest(rows):
    out, counts = _two_pass(
        rows, [(None, "f", "c2", "SECOND", "b", 2), (None, "f", "c2", "FIRST", "a", 1), ("S9", "x", "x", "other id", "", 3)]
    )
    assert out["S2"] == ("FIRST", "a")
    assert out["S3"] == (None, None)
    assert counts["ambiguity_dropped"] == 1
    assert counts["pass1_matched"] + counts["pass2_matched"] + counts["unmatched"] == 4


SERIES = "cnpj_fundo_classe string, id_subclasse string, dt_comptc date, vl_quota double"


def _dim(rows):
    parents = rows("cnpj_classe string, nome string", ("C1", "class 1"), ("C2", "class 2"))
    children = rows("cnpj_classe string, id_subclasse_cvm string, nome string", ("C3", "S3", "sub 3"))
    return match.entity_dimension(parents, children, ["nome"])


def test_entity_dimension_tags_levels(rows):
    got = {r.fund_key: (r.id_subclasse_cvm, r.id_subclasse_join) for r in _dim(rows).collect()}
    assert got == {"CLS_C1": (None, "__CLASSE__"), "CLS_C2": (None, "__CLASSE__"), "SUB_S3": ("S3", "S3")}


def test_series_joins_on_level(rows):
    d = date(2024, 1, 1)
    series = rows(SERIES, ("C1", None, d, 1.0), ("C1", "S3", d, 2.0), ("C3", "S3", d, 3.0), ("C3", None, d, 4.0), (None, None, d, 5.0))
    got = {(r.fund_key, r.vl_quota) for r in match.attach_entity_key(series, _dim(rows)).collect()}
    # A child row counts only under its own parent.
    assert got == {("CLS_C1", 1.0), ("SUB_S3", 3.0)}


def test_known_entities_follow_the_level(rows):
    d = date(2024, 1, 1)
    series = rows(SERIES, ("C1", None, d, 1.0), ("C1", "S9", d, 2.0), ("C9", "S3", d, 3.0), ("C9", None, d, 4.0))
    parents = rows("cnpj_classe string", ("C1",), ("C1",))
    children = rows("id_subclasse_cvm string", ("S3",))
    kept = match.keep_known_entities(series, parents, children)
    assert sorted(r.vl_quota for r in kept.collect()) == [1.0, 3.0]
    assert kept.columns == series.columns


def test_child_attribute_overrides(rows):
    df = rows("cnpj_classe string, id_subclasse_cvm string", ("C1", None), ("C1", "S1"), ("C1", "S2"))
    up = rows("cnpj_classe string, nome string", ("C1", "parent"))
    down = rows("id_subclasse_cvm string, nome string", ("S1", "child"), ("S2", None))
    got = {r.id_subclasse_cvm: r.nome for r in match.override_attributes(df, up, down, ["nome"]).collect()}
    assert got == {None: "parent", "S1": "child", "S2": "parent"}


def test_anchors(rows):
    base, final = date(2023, 12, 31), date(2024, 12, 31)
    series = rows(
        SERIES,
        ("C1", None, date(2023, 12, 28), 100.0), ("C1", None, date(2023, 12, 30), None), ("C1", None, date(2024, 12, 30), 110.0),
        ("C1", None, date(2025, 1, 2), 999.0),
        ("C2", None, date(2024, 5, 1), 5.0),
        ("C3", "S3", date(2023, 1, 1), 0.0), ("C3", "S3", date(2024, 1, 1), 7.0),
    )
    out = {r.nome: r.ret for r in anchors.anchor_returns(_dim(rows), series, base, final, "ret").collect()}
    assert round(out["class 1"], 9) == 0.1
    assert out["class 2"] is None and out["sub 3"] is None


def test_keep_first_treats_nulls_as_equal_and_is_idempotent(rows):
    df = rows("k1 string, k2 string, line int", ("a", None, 2), ("a", None, 1), ("a", "x", 3))
    once = dedup.keep_first(df, ["k1", "k2"], ["line"])
    assert {(r.k2, r.line) for r in once.collect()} == {(None, 1), ("x", 3)}
    assert dedup.keep_first(once, ["k1", "k2"], ["line"]).count() == 2


def test_latest_record_keeps_keys_with_null_dates_only(rows):
    df = rows("k string, d date, v double, line int",
              ("a", date(2020, 1, 1), 1.0, 1), ("a", date(2024, 1, 1), 2.0, 2), ("a", date(2024, 1, 1), 9.0, 3),
              ("a", None, 3.0, 4), ("b", None, 4.0, 6), ("b", None, 5.0, 5))
    got = {r.k: r.v for r in dedup.latest_record(df, "k", "d", ["line"]).collect()}
    assert got == {"a": 2.0, "b": 5.0}


def test_hot_key_is_reduced_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and "Partial" in limits[1]


def test_missing_keys_and_relaxed_union(rows):
    a, b = rows("k int", (1,), (2,)), rows("k int, v string", (2, "x"))
    assert [r.k for r in select.missing_keys(a, b, ["k"]).collect()] == [1]
    assert {(r.k, r.v) for r in select.stack_relaxed([a, b]).collect()} == {(1, None), (2, None), (2, "x")}
