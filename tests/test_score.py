import math
import random

import pytest
from pyspark.sql import functions as F

from peerscore.operators import ranking
from peerscore.operators.score import Eligibility, MetricSpec, ScoringConfig, composite, peer_score
from peerscore.operators.toplist import profile_universe, top_n_by_audience
from peerscore.plans.settings import PROFILES, SCORING

METRICS = "fund_key string, situacao string, nr_cotst bigint, existing_time bigint, equity double, information_ratio double"
OPEN = "Em Funcionamento Normal"


def _config(direction="positive", equity=50_000_000.0, metrics=None):
    return ScoringConfig(
        metrics=metrics or {"information_ratio": MetricSpec(direction, 1.0)},
        eligibility=Eligibility(OPEN, 1000, 252, equity),
    )


def _four(rows):
    return rows(
        METRICS,
        ("A", OPEN, 5000, 400, 100e6, 0.5),
        ("B", OPEN, 2000, 800, 80e6, 1.2),
        ("C", OPEN, 500, 600, 60e6, 0.9),
        ("D", OPEN, 1500, 100, 200e6, 2.0),
    )


def _scores(df):
    return {r.fund_key: r.score for r in df.collect()}


def test_ineligible_entities_have_no_score(rows):
    got = _scores(peer_score(_four(rows), _config()))
    assert got["C"] is None and got["D"] is None
    assert got["B"] > got["A"]
    assert got == {"A": 50.0, "B": 100.0, "C": None, "D": None}


def test_negative_direction_reverses(rows):
    got = _scores(peer_score(_four(rows), _config("negative")))
    assert got["A"] > got["B"]


def test_thresholds_gate(rows):
    counts = [
        sum(v is not None for v in _scores(peer_score(_four(rows), _config(equity=e))).values()) for e in (10e6, 90e6, 150e6)
    ]
    assert counts == [2, 1, 0]


def test_boundaries_of_eligibility(rows):
    df = rows(
        METRICS,
        ("at", OPEN, 1000, 252, 50e6, 1.0),
        ("over", OPEN, 1001, 252, 50e6, 1.0),
        ("null", OPEN, None, 252, 50e6, 1.0),
        ("shut", "CANCELADA", 1001, 252, 50e6, 1.0),
    )
    got = _scores(peer_score(df, _config()))
    assert got == {"at": None, "over": 100.0, "null": None, "shut": None}


def test_two_metrics_and_the_denominator(rows):
    """A null metric leaves its entity unscored, but its other metric counts in the moments."""
    df = rows(
        METRICS + ", tax double",
        *[(k, OPEN, 2000, 300, 60e6, ir, tax) for k, ir, tax in [("A", 1.0, 0.8), ("B", 2.0, 0.9), ("C", 9.0, None)]],
    )
    config = _config(metrics={"information_ratio": MetricSpec("positive", 0.5), "tax": MetricSpec("positive", 0.5)})
    got = _scores(peer_score(df, config))
    assert got == {"A": 50.0, "B": 100.0, "C": None}
    z = {r.fund_key: r.composite for r in composite(df, config).collect()}
    sd = 4.358898943540674
    assert z["A"] == pytest.approx(0.5 * (1.0 - 4.0) / sd + 0.5 * (0.8 - 0.85) / 0.07071067811865475)


def test_without_spread_there_is_no_score(rows):
    df = rows(METRICS + ", tax double", *[(k, OPEN, 2000, 300, 60e6, 1.0, 0.5) for k in "AB"])
    config = _config(metrics={"information_ratio": MetricSpec("positive", 0.5), "tax": MetricSpec("positive", 0.5)})
    assert set(_scores(peer_score(df, config)).values()) == {None}


def test_unknown_metric_is_an_error(rows):
    with pytest.raises(ValueError, match="do not exist"):
        peer_score(_four(rows), _config(metrics={"nope": MetricSpec("positive", 1.0)}))


def test_config_is_checked():
    with pytest.raises(ValueError, match="no metric"):
        ScoringConfig(metrics={}, eligibility=SCORING.eligibility)
    with pytest.raises(ValueError, match="rate table"):
        _config(metrics={"tax_efficiency": MetricSpec("positive", 1.0)})
    with pytest.raises(ValueError) as several:
        _config(metrics={"a": MetricSpec("up", 0.5), "b": MetricSpec("positive", 0.0), "tax_efficiency": MetricSpec("negative", 0.3)})
    for part in ("a has direction 'up'", "b has weight 0.0", "add up to 0.8", "rate table"):
        assert part in str(several.value)
    assert sum(s.weight for s in SCORING.metrics.values()) == pytest.approx(1.0)


def _brute(values):
    out = {}
    for v in set(values):
        positions = [i + 1 for i, x in enumerate(sorted(values)) if x == v]
        out[v] = (len(positions), sum(positions) / len(positions))
    return out


def _value_sets():
    rng = random.Random(7)
    heavy = [rng.gauss(0, 1) for _ in range(300)] + [1.5] * 150
    yield "hot value", heavy
    yield "one value", [3.0] * 20
    yield "single row", [1.0]
    yield "far outlier", [rng.uniform(0, 1e-3) for _ in range(200)] + [1e12, -1e12]
    yield "negatives and zero", [0.0, -0.0, -1.0, -1.0, 2.0]


def _wide_sets():
    rng = random.Random(3)
    yield "many magnitudes", [10 ** rng.uniform(-300, 300) for _ in range(3000)]
    yield "two outliers", [rng.gauss(0, 1) for _ in range(3000)] + [1e6, 1e12]
    yield "infinities", [rng.gauss(0, 1) for _ in range(3000)] + [math.inf, -math.inf]
    yield "hot value", [rng.gauss(0, 1) for _ in range(2000)] + [0.5] * 2000


@pytest.mark.parametrize("name,values", list(_value_sets()), ids=lambda x: x if isinstance(x, str) else "")
def test_ranks_equal_brute_force(rows, name, values):
    df = rows("v double", *[(v,) for v in values], (None,))
    got = {r.value: (r.n, r.avg_rank) for r in ranking.average_ranks(df, "v").collect()}
    assert got == _brute(values)


@pytest.mark.parametrize("name,values", list(_wide_sets()), ids=lambda x: x if isinstance(x, str) else "")
def test_no_window_group_holds_much(rows, name, values):
    df = rows("v double", *[(v,) for v in values])
    ranges = 16
    held = [r.c for r in ranking.in_ranges(df, "v", ranges).groupBy("range").agg(F.count("*").alias("c")).collect()]
    distinct = len(set(values))
    assert sum(held) == distinct and max(held) <= 3 * distinct / ranges
    got = {r.value: r.avg_rank for r in ranking.average_ranks(df, "v", ranges).collect()}
    assert got == {v: r for v, (_, r) in _brute(values).items()}


def test_ranks_of_nothing(rows):
    assert ranking.average_ranks(rows("v double", (None,)), "v").collect() == []


def test_score_rounds_half_to_even(rows):
    df = rows("v double", *[(float(i),) for i in range(32)])
    got = {r.value: r.p for r in ranking.average_rank_percentile(df, "v", "p").collect()}
    assert got[0.0] == 3.12  # 3.125
    assert got[2.0] == 9.38  # 9.375


SCORED = "fund_key string, publico_alvo string, score double"


def test_profiles_are_nested(rows):
    df = rows(
        SCORED,
        ("A", "Público Geral", 90.0), ("B", "Qualificado", 95.0), ("C", "Profissional", 99.0),
        ("D", "Público Geral", None), ("E", "Outro", 100.0), ("F", None, 100.0), ("G", "Público Geral", 10.0),
    )
    top = {(r.profile, r["rank"]): r.fund_key for r in top_n_by_audience(df, PROFILES, 1).collect()}
    assert top == {("Geral", 1): "A", ("Qualificado", 1): "B", ("Profissional", 1): "C"}
    universe = {r.profile: r.universe for r in profile_universe(df, PROFILES).collect()}
    assert universe == {"Geral": 2, "Qualificado": 3, "Profissional": 4}


def test_empty_profile_has_universe_zero(rows):
    df = rows(SCORED, ("C", "Profissional", 99.0))
    universe = {r.profile: r.universe for r in profile_universe(df, PROFILES).collect()}
    assert universe == {"Geral": 0, "Qualificado": 0, "Profissional": 1}


def test_ties_follow_the_key(rows):
    df = rows(SCORED, *[(k, "Público Geral", 50.0) for k in "DCBA"])
    top = top_n_by_audience(df, {"Geral": ["Público Geral"]}, 2).orderBy("rank").collect()
    assert [r.fund_key for r in top] == ["A", "B"]


def test_top_n_is_limited_before_the_exchange(rows):
    df = rows(SCORED, ("A", "Público Geral", 1.0)).repartition(3).withColumn("score", F.col("score") + F.rand(1) * 0)
    plan = top_n_by_audience(df, PROFILES, 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
