"""Returns, reference series, metrics, score and top lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display
from ..operators import anchors, match, metrics, quality, ranking, reference, returns, score, select, toplist
from ..plans import fund_metrics as metrics_plan
from ..plans import reference_series, top_list, validation
from ..plans.entity_series import read_entity_series, write_entity_series
from ..session import materialise, scratch_path
from . import frames as f


def _daily(spark: SparkSession, sf: str, extra: Sequence[str] = ()) -> DataFrame:
    """Series rows of known entities up to the reference date."""
    dim = _dim(spark, sf)
    keyed = match.attach_entity_key(select.on_or_before(f.quotas(spark, sf), "dt_comptc", f.AS_OF), dim, extra)
    return keyed.select("fund_key", *extra, "dt_comptc", "vl_quota", "vl_patrim_liq", "nr_cotst")


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    return match.entity_dimension(f.classes(spark, sf), f.subclasses(spark, sf), metrics_plan.CARRIED)


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    long = select.on_or_before(f.reference_long(spark, sf), "data", f.AS_OF)
    return reference.widen(long, list(f.UNITS))


def _reference_monthly(spark: SparkSession, sf: str) -> DataFrame:
    long = select.on_or_before(f.reference_long(spark, sf), "data", f.AS_OF).withColumnRenamed("code", "series")
    return reference.monthly_series_returns(long, f.UNITS)


def _flagged(spark: SparkSession, sf: str, extra: Sequence[str] = ()) -> DataFrame:
    return returns.flag_jumps(returns.daily_log_returns(_daily(spark, sf, extra)), window=f.WINDOW, sigma=f.SIGMA)


def _monthly(spark: SparkSession, sf: str, extra: Sequence[str] = ()) -> DataFrame:
    return returns.monthly_returns(returns.drop_jumps(_flagged(spark, sf, extra)), carry=extra)


def daily_log_returns(spark, sf):
    out = returns.daily_log_returns(_daily(spark, sf))
    return out.select("fund_key", "dt_comptc", f.rounded("vl_quota", 8).alias("vl_quota"), f.rounded("log_ret").alias("log_ret"))


def jump_flags(spark, sf):
    return _flagged(spark, sf).select("fund_key", "dt_comptc", "is_jump")


def jump_free_rows(spark, sf):
    clean = returns.drop_jumps(_flagged(spark, sf))
    return clean.groupBy("fund_key", F.trunc("dt_comptc", "month").alias("year_month")).agg(F.count("*").alias("days"))


def period_end_levels(spark, sf):
    out = returns.month_end_levels(returns.drop_jumps(_flagged(spark, sf)))
    return out.select("fund_key", "year_month", f.rounded("vl_quota_eom", 8).alias("vl_quota_eom"))


def period_returns(spark, sf):
    return _monthly(spark, sf).select("fund_key", "year_month", f.rounded("monthly_ret").alias("monthly_ret"))


def reference_wide(spark, sf):
    return _wide(spark, sf).select("data", *[f.rounded(c, 4).alias(c) for c in f.UNITS])


def reference_table(spark, sf):
    long = f.reference_long(spark, sf)
    pieces = {c: long.filter(F.col("code") == c).select("data", "valor") for c in f.UNITS}
    wide = reference_series.index_series(pieces, f.AS_OF, [*f.UNITS, "absent"])
    return wide.select("data", *[f.rounded(c, 4).alias(c) for c in f.UNITS], F.col("absent").cast("double").alias("absent"))


def compound_rates(spark, sf):
    rates = f.table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("data")).agg(F.avg("l_tax").alias("rate"))
    return rates.groupBy(F.trunc("data", "month").alias("year_month")).agg(f.rounded(reference.compounded(F.col("rate")), 9).alias("monthly_ret"))


def first_of_period(spark, sf):
    rates = f.table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("data")).agg(
        F.avg(F.nullif("l_discount", F.lit(0.0))).alias("rate")
    )
    return rates.groupBy(F.trunc("data", "month").alias("year_month")).agg(
        f.rounded(reference.first_published(F.col("rate"), F.col("data")), 9).alias("monthly_ret")
    )


def level_returns(spark, sf):
    levels = f.reference_long(spark, sf).filter(F.col("code").startswith("p")).withColumnRenamed("code", "series")
    out = reference.level_returns(levels)
    return out.select("series", "year_month", f.rounded("monthly_bench_ret").alias("monthly_bench_ret"))


def reference_returns_long(spark, sf):
    out = _reference_monthly(spark, sf)
    return out.select("year_month", "benchmark_code", f.rounded("monthly_bench_ret", 9).alias("monthly_bench_ret"))


def excess_statistics(spark, sf):
    excess = metrics.excess_returns(_monthly(spark, sf, ["benchmark"]), _dim(spark, sf), _reference_monthly(spark, sf))
    out = metrics.excess_statistics(excess)
    return out.select("fund_key", *[f.rounded(c, 9).alias(c) for c in ("excess_mean", "excess_std", "downside_std")])


def complete_pairs(spark, sf):
    dim = _dim(spark, sf).select("fund_key", F.col("benchmark").alias("benchmark_code"))
    paired = _monthly(spark, sf).join(dim, "fund_key", "left").join(
        _reference_monthly(spark, sf), ["year_month", "benchmark_code"], "left"
    )
    return select.complete_pairs(paired, "monthly_ret", "monthly_bench_ret").groupBy("fund_key").agg(F.count("*").alias("months"))


def information_ratio(spark, sf):
    out = metrics.attach_information_ratio(_dim(spark, sf).select("fund_key"), _monthly(spark, sf, ["benchmark"]), _reference_monthly(spark, sf))
    return out.select("fund_key", f.rounded("information_ratio").alias("information_ratio"))


def sortino_ratio(spark, sf):
    out = metrics.attach_sortino_ratio(_dim(spark, sf).select("fund_key"), _monthly(spark, sf, ["benchmark"]), _reference_monthly(spark, sf))
    return out.select("fund_key", f.rounded("sortino_ratio").alias("sortino_ratio"))


def label_efficiency(spark, sf):
    out = metrics.attach_label_efficiency(_dim(spark, sf), f.RATES)
    return out.select("fund_key", "tributacao_alvo", "tax_efficiency")


def latest_attributes(spark, sf):
    out = _dim(spark, sf).join(metrics.latest_attributes(_daily(spark, sf)), "fund_key", "left")
    return out.select("fund_key", f.rounded("equity", 2).alias("equity"), F.coalesce("nr_cotst", F.lit(0)).alias("nr_cotst"))


def age_days(spark, sf):
    return metrics.attach_age(_dim(spark, sf), f.AS_OF).select("fund_key", "data_de_inicio", "existing_time")


def _metric_plan(spark: SparkSession, sf: str, build, series: DataFrame | None = None, **more):
    return build(
        f.classes(spark, sf),
        f.subclasses(spark, sf),
        f.quotas(spark, sf) if series is None else series,
        _wide(spark, sf),
        f.AS_OF,
        config=f.SCORING,
        units=f.UNITS,
        window=f.WINDOW,
        sigma=f.SIGMA,
        **more,
    )


def _metrics(spark, sf):
    return _metric_plan(spark, sf, metrics_plan.entity_metrics)


def _scored(spark, sf, series=None):
    return _metric_plan(spark, sf, metrics_plan.fund_metrics, series, store=partial(materialise, label="entity_metrics"))


def _by_entity(spark, sf):
    """The series published in buckets of its entity."""
    root = scratch_path(spark, "by-entity")
    write_entity_series(f.quotas(spark, sf), root, f.AS_OF)
    return read_entity_series(spark, root, f.AS_OF)


_SHOWN = ["cnpj_classe", "id_subclasse_cvm", "situacao", "publico_alvo", "tributacao_alvo"]


def fund_metrics(spark, sf, series=None):
    out = _scored(spark, sf, series)
    return out.select(
        *_SHOWN,
        f.rounded("equity", 2).alias("equity"),
        "nr_cotst",
        "existing_time",
        *[f.rounded(c).alias(c) for c in ("information_ratio", "sortino_ratio", "tax_efficiency", "score")],
    )


def stored_fund_metrics(spark, sf):
    """Metrics and score from a series that is stored by entity, and so not exchanged."""
    return fund_metrics(spark, sf, _by_entity(spark, sf))


def eligibility(spark, sf):
    return _metrics(spark, sf).select("fund_key", score.eligible(f.SCORING.eligibility).alias("eligible"))


def global_zscore(spark, sf):
    names = list(f.SCORING.metrics)
    stored = materialise(_metrics(spark, sf), "entity_metrics")
    out = score.zscores(stored, names, score.eligible(f.SCORING.eligibility))
    return out.select("fund_key", *[f.rounded(f"z_{n}").alias(f"z_{n}") for n in names])


def peer_score(spark, sf):
    return _scored(spark, sf).select("fund_key", f.rounded("score", 2).alias("score"))


def event_value_percentile(spark, sf):
    out = ranking.average_rank_percentile(f.table(spark, sf, "events"), "value", "percentile", decimals=6)
    return out.select("value", f.rounded("percentile", 5).alias("percentile"))


def top_n_by_audience(spark, sf):
    out = toplist.top_n_by_audience(_scored(spark, sf), f.PROFILES, f.SCORING.top_n)
    return out.select("profile", "rank", "fund_key", "publico_alvo", f.rounded("score", 2).alias("score"))


def profile_universe(spark, sf):
    return toplist.profile_universe(_scored(spark, sf), f.PROFILES)


def published_top_list(spark, sf):
    out = top_list.top_list(_scored(spark, sf), f.classes(spark, sf), f.subclasses(spark, sf), f.PROFILES, f.SCORING.top_n)
    return top_list.displayed(out)


def display_format(spark, sf):
    e = f.table(spark, sf, "customer")
    bal = F.col("c_acctbal")
    return e.select(
        "c_custkey",
        display.money(bal).alias("plain"),
        display.money(F.round(bal * 1000, 0)).alias("millions"),
        display.money(F.round(bal * 1000000, 0)).alias("billions"),
        display.thousands(F.round(bal * 1000, 0).cast("bigint")).alias("whole"),
        display.two_decimals(bal).alias("number"),
        display.text(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("label"),
        display.entity_label(F.col("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 1, F.col("c_name"))).alias("entity"),
    )


def anchor_returns(spark, sf, series=None):
    dim = validation.named_entities(f.classes(spark, sf), f.subclasses(spark, sf))
    series = f.quotas(spark, sf) if series is None else series
    out = anchors.anchor_returns(dim, series, *f.ANCHORS, "anchor_ret")
    return out.select("cnpj_fundo", "cnpj_classe", "id_subclasse_cvm", "nome", f.rounded("anchor_ret").alias("anchor_ret"))


def stored_anchor_returns(spark, sf):
    return anchor_returns(spark, sf, _by_entity(spark, sf))


def profile_buckets(spark, sf):
    scored = materialise(_scored(spark, sf).select("score"), "scores")
    out = quality.profile_scores(scored, "fund_metrics")
    return out.select("check", "item", "n", f.rounded("value").alias("value"))


def series_coverage(spark, sf):
    return quality.series_coverage(_wide(spark, sf), list(f.UNITS))


_R = "round({0}, {1}) + 0.0 AS {0}"


def _r(name: str, digits: int = 6) -> str:
    return _R.format(name, digits)


_WIDE_SQL = ", ".join(_r(c, 4) for c in f.UNITS)
_Z_SQL = ", ".join(_r(f"z_{n}") for n in f.SCORING.metrics)
_PROFILE_ROWS = ", ".join(f"('{p}', '{a}')" for p, audiences in f.PROFILES.items() for a in audiences)
_TOP_SQL = f"""SELECT profile, row_number() OVER (PARTITION BY profile ORDER BY score DESC NULLS LAST, {{tie}}) AS rank, scored.*
FROM scored JOIN (VALUES {_PROFILE_ROWS}) p(profile, audience) ON publico_alvo = audience
WHERE score IS NOT NULL QUALIFY rank <= {f.SCORING.top_n}"""
_MONEY_SQL = """CASE WHEN {0} IS NULL THEN '' WHEN abs({0}) >= 1e9 THEN printf('R$ %.2fB', {0} / 1e9)
 WHEN abs({0}) >= 1e6 THEN printf('R$ %.2fM', {0} / 1e6) WHEN abs({0}) >= 1e3 THEN printf('R$ %.2fK', {0} / 1e3)
 ELSE printf('R$ %.2f', {0}) END"""


def _money(expr: str) -> str:
    return _MONEY_SQL.format(f"CAST({expr} AS DOUBLE)")


_TWO = "CASE WHEN {0} IS NULL THEN '' ELSE printf('%.2f', {0}) END AS {0}"

QUERIES = {
    "daily_log_returns": (
        daily_log_returns,
        f.with_ctes(f"SELECT fund_key, dt_comptc, {_r('vl_quota', 8)}, {_r('log_ret')} FROM returns", "returns"),
    ),
    "jump_flags": (jump_flags, f.with_ctes("SELECT fund_key, dt_comptc, is_jump FROM flagged", "flagged")),
    "jump_free_rows": (
        jump_free_rows,
        f.with_ctes(
            "SELECT fund_key, CAST(date_trunc('month', dt_comptc) AS DATE) AS year_month, count(*) AS days FROM flagged WHERE NOT is_jump GROUP BY ALL",
            "flagged",
        ),
    ),
    "period_end_levels": (
        period_end_levels,
        f.with_ctes(f"SELECT fund_key, year_month, {_r('vl_quota_eom', 8)} FROM eom", "eom"),
    ),
    "period_returns": (
        period_returns,
        f.with_ctes(f"SELECT fund_key, year_month, {_r('monthly_ret')} FROM monthly", "monthly"),
    ),
    "reference_wide": (reference_wide, f.with_ctes(f"SELECT data, {_WIDE_SQL} FROM wide", "wide")),
    "reference_table": (
        reference_table,
        f.with_ctes(f"SELECT data, {_WIDE_SQL}, CAST(NULL AS DOUBLE) AS absent FROM wide", "wide"),
    ),
    "compound_rates": (
        compound_rates,
        """SELECT CAST(date_trunc('month', data) AS DATE) AS year_month, round(product(1 + rate / 100) - 1, 9) + 0.0 AS monthly_ret
FROM (SELECT CAST(l_shipdate AS DATE) AS data, avg(l_tax) AS rate FROM lineitem GROUP BY 1) GROUP BY 1""",
    ),
    "first_of_period": (
        first_of_period,
        """SELECT CAST(date_trunc('month', data) AS DATE) AS year_month, round(arg_min(rate, data) / 100, 9) + 0.0 AS monthly_ret
FROM (SELECT CAST(l_shipdate AS DATE) AS data, avg(nullif(l_discount, 0)) AS rate FROM lineitem GROUP BY 1) GROUP BY 1""",
    ),
    "level_returns": (
        level_returns,
        f.with_ctes(
            """SELECT series, year_month, round(r, 6) + 0.0 AS monthly_bench_ret FROM (
SELECT code AS series, year_month, lvl / lag(lvl) OVER (PARTITION BY code ORDER BY year_month) - 1 AS r FROM (
SELECT code, CAST(date_trunc('month', data) AS DATE) AS year_month, arg_max(valor, data) AS lvl FROM reflong
WHERE code LIKE 'p%' GROUP BY ALL)) WHERE r IS NOT NULL""",
            "reflong",
        ),
    ),
    "reference_returns_long": (
        reference_returns_long,
        f.with_ctes(f"SELECT year_month, benchmark_code, {_r('monthly_bench_ret', 9)} FROM refmonthly", "refmonthly"),
    ),
    "excess_statistics": (
        excess_statistics,
        f.with_ctes(
            f"SELECT fund_key, {_r('excess_mean', 9)}, {_r('excess_std', 9)}, {_r('downside_std', 9)} FROM stats", "stats"
        ),
    ),
    "complete_pairs": (
        complete_pairs,
        f.with_ctes("SELECT fund_key, count(*) AS months FROM excess GROUP BY fund_key", "excess"),
    ),
    "information_ratio": (
        information_ratio,
        f.with_ctes(f"SELECT fund_key, {_r('information_ratio')} FROM metrics", "metrics"),
    ),
    "sortino_ratio": (
        sortino_ratio,
        f.with_ctes(f"SELECT fund_key, {_r('sortino_ratio')} FROM metrics", "metrics"),
    ),
    "label_efficiency": (
        label_efficiency,
        f.with_ctes("SELECT fund_key, tributacao_alvo, tax_efficiency FROM metrics", "metrics"),
    ),
    "latest_attributes": (
        latest_attributes,
        f.with_ctes(f"SELECT fund_key, {_r('equity', 2)}, nr_cotst FROM metrics", "metrics"),
    ),
    "age_days": (
        age_days,
        f.with_ctes("SELECT fund_key, data_de_inicio, existing_time FROM metrics JOIN dim USING (fund_key)", "metrics"),
    ),
    "eligibility": (eligibility, f.with_ctes("SELECT fund_key, elig AS eligible FROM zs", "zs")),
    "global_zscore": (global_zscore, f.with_ctes(f"SELECT fund_key, {_Z_SQL} FROM zs", "zs")),
    "peer_score": (peer_score, f.with_ctes(f"SELECT fund_key, {_r('score', 2)} FROM scored", "scored")),
    "event_value_percentile": (
        event_value_percentile,
        """SELECT DISTINCT value, round((rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0)
 / (SELECT count(value) FROM events) * 100.0, 5) + 0.0 AS percentile FROM events WHERE value IS NOT NULL""",
    ),
    "fund_metrics": (
        fund_metrics,
        f.with_ctes(
            f"""SELECT {', '.join(_SHOWN)}, {_r('equity', 2)}, nr_cotst, existing_time, {_r('information_ratio')},
{_r('sortino_ratio')}, {_r('tax_efficiency')}, {_r('score')} FROM scored""",
            "scored",
        ),
    ),
    "top_n_by_audience": (
        top_n_by_audience,
        f.with_ctes(
            f"SELECT profile, rank, fund_key, publico_alvo, {_r('score', 2)} FROM ({_TOP_SQL.format(tie='fund_key')})",
            "scored",
        ),
    ),
    "profile_universe": (
        profile_universe,
        f.with_ctes(
            f"""SELECT profile, count(score) AS universe FROM (VALUES {_PROFILE_ROWS}) p(profile, audience)
LEFT JOIN scored ON publico_alvo = audience GROUP BY profile""",
            "scored",
        ),
    ),
    "published_top_list": (
        published_top_list,
        f.with_ctes(
            f"""SELECT t.profile, t.rank,
 CASE WHEN t.id_subclasse_cvm IS NULL THEN '`' || t.cnpj_classe || '`' ELSE '`' || t.cnpj_classe || '` (sub `' || t.id_subclasse_cvm || '`)' END AS fund,
 coalesce(s.denom_social_subclasse, c.denom_social_classe, '') AS name,
 coalesce(s.classificacao_anbima, c.classificacao_anbima, '') AS classification,
 coalesce(s.benchmark, c.benchmark, '') AS benchmark, coalesce(t.tributacao_alvo, '') AS tax_label,
 {_money('t.equity')} AS equity, format('{{:,}}', t.nr_cotst) AS holders, format('{{:,}}', t.existing_time) AS age_days,
 {_TWO.format('information_ratio')}, {_TWO.format('sortino_ratio')}, {_TWO.format('tax_efficiency')}, {_TWO.format('score')}
FROM ({_TOP_SQL.format(tie='cnpj_classe, id_subclasse_cvm NULLS FIRST')}) t
LEFT JOIN classes c ON t.cnpj_classe = c.cnpj_classe LEFT JOIN subclasses s ON t.id_subclasse_cvm = s.id_subclasse_cvm""",
            "scored",
        ),
    ),
    "display_format": (
        display_format,
        f"""SELECT c_custkey, CASE WHEN abs(c_acctbal) >= 1000 THEN printf('R$ %.2fK', c_acctbal / 1e3) ELSE printf('R$ %.2f', c_acctbal) END AS plain,
 {_money('round(c_acctbal * 1000, 0)')} AS millions, {_money('round(c_acctbal * 1000000, 0)')} AS billions,
 format('{{:,}}', CAST(round(c_acctbal * 1000, 0) AS BIGINT)) AS whole, printf('%.2f', c_acctbal) AS number,
 coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS label,
 CASE WHEN c_custkey % 2 = 1 THEN '`' || c_mktsegment || '` (sub `' || c_name || '`)' ELSE '`' || c_mktsegment || '`' END AS entity
FROM customer""",
    ),
    "anchor_returns": (
        anchor_returns,
        f.with_ctes(
            f"""SELECT cnpj_fundo, cnpj_classe, id_subclasse_cvm, nome, round(CASE WHEN a > 0 THEN b / a - 1 END, 6) + 0.0 AS anchor_ret
FROM dim LEFT JOIN (SELECT fund_key, arg_max(vl_quota, dt_comptc) FILTER (dt_comptc <= DATE '{f.ANCHORS[0]}') AS a,
 arg_max(vl_quota, dt_comptc) FILTER (dt_comptc <= DATE '{f.ANCHORS[1]}') AS b FROM keyed GROUP BY fund_key) USING (fund_key)""",
            "dim",
            "keyed",
        ),
    ),
    "profile_buckets": (
        profile_buckets,
        f.with_ctes(
            """SELECT 'score' AS "check", item, n, round(value, 6) + 0.0 AS value FROM (
 SELECT unnest(['min', 'median', 'mean', 'max']) AS item, count(*) AS n,
        unnest([min(score), median(score), avg(score), max(score)]) AS value FROM scored WHERE score IS NOT NULL)
UNION ALL
SELECT 'score_bucket', item, count(score) AS n, round(count(score) / (SELECT count(score) FROM scored) * 100.0, 6) + 0.0
FROM (VALUES ('0-20', 0, 20), ('20-40', 20, 40), ('40-60', 40, 60), ('60-80', 60, 80), ('80-100', 80, 100.01)) b(item, lo, hi)
LEFT JOIN scored ON score >= lo AND score < hi GROUP BY item""",
            "scored",
        ),
    ),
    "series_coverage": (
        series_coverage,
        f.with_ctes(
            f"""SELECT code AS series, count(valor) AS n, min(data) AS first_date, max(data) AS last_date FROM reflong
WHERE data <= DATE '{f.AS_OF}' AND valor IS NOT NULL GROUP BY code""",
            "reflong",
        ),
    ),
}

# Stored by entity, the series gives the same rows.
QUERIES["stored_fund_metrics"] = (stored_fund_metrics, QUERIES["fund_metrics"][1])
QUERIES["stored_anchor_returns"] = (stored_anchor_returns, QUERIES["anchor_returns"][1])
