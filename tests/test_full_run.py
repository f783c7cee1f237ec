"""From landed files to published tables on a small made-up landing zone."""

from __future__ import annotations

import json
import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from peerscore.operators.select import empty_frame
from peerscore.plans import full_run, landing_zone
from peerscore.schemas import MANIFEST
from peerscore.sources import landing, tables
from test_sources import CURRENT, LEGACY, make_zip

AS_OF = date(2025, 12, 31)
OPEN = "Em Funcionamento Normal"


def _business_days(start, end):
    d = start
    while d <= end:
        if d.weekday() < 5:
            yield d
        d += timedelta(days=1)


def _registry():
    classes = ["ID_Registro_Classe;ID_Registro_Fundo;CNPJ_Classe;Denominacao_Social;Situacao;Data_Inicio_Situacao;Exclusivo;Publico_Alvo;Forma_Condominio"]
    funds = ["ID_Registro_Fundo;CNPJ_Fundo;Denominacao_Social"]
    for i in range(1, 7):
        audience = ["Público Geral", "Qualificado", "Profissional"][i % 3]
        classes.append(f"{i};{100 + i};{i};Classe {i} ;{OPEN};2020-01-0{i};N;{audience};Aberto")
        funds.append(f"{100 + i};9{i};Fundo {i}")
    funds.append("101;9999;Fundo 1 again")
    subs = ["ID_Registro_Classe;ID_Subclasse;Denominacao_Social;Situacao;Data_Inicio_Situacao;Exclusivo;Publico_Alvo;Forma_Condominio"]
    subs.append(f"6;SUB6;Sub de 6;{OPEN};2020-01-01;N;Público Geral;Aberto")
    return {"registro_classe.csv": classes, "registro_fundo.csv": funds, "registro_subclasse.csv": subs}


def _history():
    adm = ["CNPJ_FUNDO;DT_INI_TAXA_ADM;TAXA_ADM"] + [f"9{i};2024-01-01;{1.0 if i < 6 else ''}" for i in range(1, 7)] + ["91;2020-01-01;7"]
    rent = ["CNPJ_Fundo;DT_INI_RENTAB;RENTAB_FUNDO"] + [f"9{i};2024-01-01;{'Taxa Selic' if i != 2 else 'Índice de preços'}" for i in range(1, 6)]
    return {"cad_fi_hist_taxa_adm.csv": adm, "cad_fi_hist_rentab.csv": rent}


def _quotas(days, month):
    out = [CURRENT]
    for n, d in enumerate(days):
        if f"{d:%Y%m}" != month:
            continue
        for i in range(1, 7):
            level = 100 * (1.0005 + 0.00002 * i) ** n * (1 + 0.004 * math.sin(n * (i + 1)))
            sub = "SUB6" if i == 6 else ""
            out.append(f"FI;{i};{sub};{d};1;{level:.8f};{60e6 + i};0;0;{2000 + i}")
    return out


HALF_LANDED = "202503"


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    days = list(_business_days(date(2024, 6, 3), AS_OF))
    make_zip(root / "cvm_registro_classe" / "raw.zip", _registry())
    make_zip(root / "cvm_cad_fi_hist" / "raw.zip", _history())
    for month in sorted({f"{d:%Y%m}" for d in days}):
        make_zip(root / "cvm_inf_diario" / f"competence={month}" / "raw.zip", {"a.csv": _quotas(days, month)})
    # A yearly archive is only read for years that lack a month.
    make_zip(root / "cvm_inf_diario_hist" / "competence=2024" / "raw.zip", {"a.csv": [LEGACY, f"1;{days[0]};1;50;1;0;0;1"]})
    for code in ("cdi", "selic", "ipca"):
        p = root / f"bcb_{code}" / "raw.json"
        p.parent.mkdir()
        p.write_text(json.dumps([{"data": d.strftime("%d/%m/%Y"), "valor": "1.05" if code == "ipca" else "0.05"} for d in days if code != "ipca" or d.day < 4]))
    drop = ["CNPJ Fundo;CNPJ Classe;Estrutura;Código CVM Subclasse;Tipo ANBIMA;Tributação Alvo"]
    drop += [f"9{i};{i};Classe;;{'Renda Fixa X' if i != 5 else 'Multimercado'};Isento" for i in range(1, 7)]
    drop += ["96;6;Subclasse;SUB6;Renda Fixa Y;Curto Prazo"]
    levels = ["Data de Referência;Número Índice;Outro"] + [f"{d};{1000 + n};x" for n, d in enumerate(days)]
    for folder, name, lines in (("anbima_175", "raw.csv", drop), ("anbima_indices", "IMAB-Historico.CSV", levels), ("anbima_indices", "unknown.csv", levels)):
        (root / folder).mkdir(exist_ok=True)
        (root / folder / name).write_text("\n".join(lines), encoding="latin-1")
    files = landing_zone.partitions(spark, str(root)).select("source", "competence", "path").distinct()
    manifest = landing.classify_changes(
        files.select("source", "competence", "path", F.sha2("path", 256).alias("sha256"), F.lit(1).cast("long").alias("byte_size")),
        empty_frame(spark, MANIFEST),
        datetime(2026, 1, 2),
    ).filter(f"competence IS NULL OR competence <> '{HALF_LANDED}'")
    out = str(tmp_path_factory.mktemp("published"))
    listed, original = [], landing_zone.partitions
    landing_zone.partitions = lambda *args: listed.append(args) or original(*args)
    try:
        full_run.run_zone(spark, str(root), manifest, out, AS_OF)
    finally:
        landing_zone.partitions = original
    assert len(listed) == 1

    def read(layer, name):
        return tables.read_table(spark, out, layer, name, AS_OF)

    read.landed = full_run.landed_at(landing_zone.Zone(spark, str(root), manifest), AS_OF)
    read.out = out
    return read


def test_dimensions(published):
    cls = {r.cnpj_classe[-1]: r for r in published("silver", "class_funds").collect()}
    assert set(cls) == set("12345")  # class 6 has a subclass
    assert cls["1"].cnpj_fundo == "00000000000091" and cls["1"].denom_social_classe == "Classe 1"
    assert cls["1"].taxa_adm == pytest.approx(0.01) and cls["1"].taxa_perform is None
    sub = published("silver", "subclass_funds").collect()
    assert [(r.id_subclasse_cvm, r.cnpj_classe[-1], r.cnpj_fundo, r.classificacao_anbima) for r in sub] == [
        ("SUB6", "6", "00000000000096", "Renda Fixa Y")
    ]
    assert published("silver", "class_funds_fixed_income").count() == 4
    treated = {r.cnpj_classe[-1]: r.benchmark for r in published("silver", "class_funds_fixed_income_treated").collect()}
    assert treated == {"1": "CDI", "2": "IPCA", "3": "CDI", "4": "CDI"}
    t = published("silver", "subclass_funds_fixed_income_treated").collect()[0]
    assert (t.benchmark, t.taxa_adm, t.taxa_perform) == ("CDI", pytest.approx(0.01), None)


def test_series(published):
    qs = published("silver", "quota_series")
    assert qs.filter((F.col("vl_quota") == 50.0)).count() == 1  # the legacy row won its day
    months = {r.m for r in qs.select(F.date_format("dt_comptc", "yyyyMM").alias("m")).distinct().collect()}
    assert HALF_LANDED not in months and {"202502", "202504"} < months  # no manifest entry, no rows
    assert qs.groupBy("cnpj_fundo_classe", "id_subclasse", "dt_comptc").count().filter("count > 1").count() == 0
    kept = published("silver", "quota_series_fixed_income")
    assert {r.cnpj_fundo_classe[-1] for r in kept.select("cnpj_fundo_classe").distinct().collect()} == set("12346")
    idx = published("silver", "index_series")
    assert idx.filter("cdi is not null").count() > idx.filter("ipca is not null").count() > 0
    assert idx.filter("irf_m is not null").count() == 0 < idx.filter("ima_b is not null").count()


def test_metrics_and_ranking(published):
    m = {(r.id_subclasse_cvm or r.cnpj_classe[-1]): r for r in published("gold", "fund_metrics").collect()}
    assert set(m) == {"1", "2", "3", "4", "SUB6"}
    assert all(0 < r.score <= 100 for r in m.values())
    assert max(r.score for r in m.values()) == 100.0
    assert m["3"].nr_cotst == 2003 and m["3"].equity == 60e6 + 3
    assert m["SUB6"].tax_efficiency == pytest.approx(0.80)
    assert m["1"].existing_time == (AS_OF - date(2020, 1, 1)).days
    top = published("gold", "top_list")
    by = {p: [r.fund for r in top.filter(F.col("profile") == p).orderBy("rank").collect()] for p in ("Geral", "Qualificado", "Profissional")}
    assert set(by["Geral"]) < set(by["Qualificado"]) < set(by["Profissional"])
    assert any("(sub `SUB6`)" in f for f in by["Geral"])


def test_cross_check_and_quality(published):
    check = {(r.id_subclasse_cvm or r.cnpj_classe[-1]): r.retorno_2025 for r in published("gold", "validacao").collect()}
    assert all(v > 0 for v in check.values()) and set(check) == {"1", "2", "3", "4", "SUB6"}
    q = published("gold", "data_quality")
    rows = {r.table: r.n for r in q.filter("check = 'keys' and item = 'rows'").collect()}
    assert rows["fund_metrics"] == 5 and rows["class_funds"] == 5
    assert q.filter("check = 'score_bucket'").agg(F.sum("n")).first()[0] == 5
    assert q.filter("table = 'index_series' and check = 'coverage'").count() == 11
    steps = {(r.table, r.item): r for r in q.filter("check = 'step'").collect()}
    n = lambda table, item: steps[table, item].n
    series = published("silver", "quota_series")
    assert n("quota_series", "one per entity and day") == series.count() and n("quota_series", "lines read") > series.count()
    assert steps["quota_series", "one per entity and day"].last_date == series.agg(F.max("dt_comptc")).first()[0]
    assert n("class_funds", "read") > n("class_funds", "without subclasses") >= n("class_funds", "one per class") == rows["class_funds"]
    matched = [n("subclass_funds", f"match: {c}") for c in ("pass1_matched", "pass2_matched", "unmatched")]
    assert sum(matched) == n("subclass_funds", "match") >= n("subclass_funds", "one per subclass") == rows["subclass_funds"]
    assert n("class_funds_fixed_income", "read") == rows["class_funds"] and n("class_funds_fixed_income", "fixed income") == rows["class_funds_fixed_income"]
    assert n("fund_metrics", "entities: scored") == published("gold", "fund_metrics").filter("score IS NOT NULL").count()
    fixed = {f"{t}_fixed_income{more}" for t in ("class_funds", "subclass_funds") for more in ("", "_treated")}
    others = {"class_funds", "subclass_funds", "quota_series", "quota_series_fixed_income", "index_series", "fund_metrics", "validacao", "top_list"}
    assert {t for t, _ in steps} == fixed | others
    nulls = {r.item: r.n for r in q.filter("table = 'fund_metrics' and check = 'nulls'").collect()}
    assert nulls["score"] == 0 and nulls["id_subclasse_cvm"] == 4 and nulls["benchmark"] is None


def test_essential_series_must_have_rows(spark, published):
    from dataclasses import replace

    with pytest.raises(RuntimeError, match="cdi"):
        full_run.run(spark, replace(published.landed, reference={}), published.out, AS_OF)
