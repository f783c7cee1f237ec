"""Joins between levels, lookups, unions and typed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, match, select
from ..plans import dimensions
from ..schemas import ATTRIBUTE_COLUMNS, struct
from ..session import materialise, spread
from ..sources import attributes
from . import frames as f


def entity_union(spark, sf):
    dim = match.entity_dimension(f.classes(spark, sf), f.subclasses(spark, sf), ["situacao", "benchmark"])
    return dim


def sentinel_join(spark, sf):
    dim = match.entity_dimension(f.classes(spark, sf), f.subclasses(spark, sf), ["situacao"])
    keyed = match.attach_entity_key(f.quotas(spark, sf), dim.filter(F.col("situacao") == "OPEN"))
    return keyed.groupBy("fund_key").agg(F.count("*").alias("days"), F.max("dt_comptc").alias("last_day"))


def anti_parent(spark, sf):
    big = f.table(spark, sf, "orders").filter(F.col("o_totalprice") > 400000).withColumnRenamed("o_custkey", "c_custkey")
    out = match.drop_parents_with_children(f.table(spark, sf, "customer"), big, "c_custkey")
    return out.select("c_custkey", "c_name", "c_mktsegment")


def hierarchy_chain(spark, sf):
    child = f.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parent = f.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    grand = f.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return match.hierarchy_chain(child, parent, grand, "l_orderkey", "o_custkey", [])


def star_enrich(spark, sf):
    latest = dedup.latest_record(
        f.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_orderstatus"),
        "c_custkey",
        "o_orderdate",
        ["o_orderkey"],
    ).select("c_custkey", "o_orderstatus")
    nation = f.table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = f.table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    out = match.star(
        f.table(spark, sf, "customer"),
        [(latest, ["c_custkey"]), (nation, ["c_nationkey"]), (region, ["n_regionkey"])],
    )
    return out.select("c_custkey", "o_orderstatus", "n_name", "r_name")


def composite_lookup(spark, sf):
    """Lines per pair, counted before the lookup: a frequent pair is one row in the join, and pairs are nearly unique."""
    li, keys = f.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"]
    rows = li.count()
    pairs = spread(li, keys, rows).groupBy(*keys).agg(F.count("*").alias("lines"))
    supply = spread(li.filter(F.col("l_returnflag") == "R"), keys, rows).groupBy(*keys).agg(F.min("l_quantity").alias("min_returned"))
    return match.lookup(pairs, supply, keys)


def discriminated_semi(spark, sf):
    cls = f.classes(spark, sf).filter(F.col("tributacao_alvo") == "ASIA")
    sub = f.subclasses(spark, sf).filter(F.col("publico_alvo") == "RETAIL")
    kept = match.keep_known_entities(f.quotas(spark, sf), cls, sub)
    return kept.select("cnpj_fundo_classe", "id_subclasse", "dt_comptc", "nr_cotst", f.rounded("vl_patrim_liq", 2).alias("vl_patrim_liq"))


def override_attributes(spark, sf):
    cls, sub = f.classes(spark, sf), f.subclasses(spark, sf)
    dim = match.entity_dimension(cls, sub, ["situacao"]).select("fund_key", "cnpj_classe", "id_subclasse_cvm")
    up = cls.select("cnpj_classe", "benchmark", F.col("denom_social_classe").alias("nome"))
    down = sub.select(
        "id_subclasse_cvm",
        F.nullif("benchmark", F.lit("DAILY")).alias("benchmark"),
        F.col("denom_social_subclasse").alias("nome"),
    )
    return match.override_attributes(dim, up, down, ["benchmark", "nome"])


_PASS_VALUES = ["segment", "owner"]


def _per(key: Column, n: int) -> Column:
    """Keys of groups of ``n``: as many as the keys allow, so their number grows with the table."""
    return F.floor(key / n).cast("bigint")


def _pass_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    base = f.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("entity_id"),
        _per(F.col("c_custkey"), 7).alias("k1"),
        (F.col("c_custkey") % 7).alias("k2"),
    )
    o = f.table(spark, sf, "orders")
    attrs = o.select(
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string")).alias("code"),
        _per(F.col("o_custkey"), 7).alias("k1"),
        (F.col("o_orderkey") % 11).alias("k2"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("segment"),
        F.col("o_orderpriority").alias("owner"),
        "o_orderkey",
    )
    return base, attrs


def two_pass_match(spark, sf):
    base, attrs = _pass_inputs(spark, sf)
    return match.two_pass_match(base, attrs, "entity_id", "code", ["k1", "k2"], _PASS_VALUES, ["o_orderkey"])


def match_breakdown(spark, sf):
    base, attrs = _pass_inputs(spark, sf)
    return match.match_breakdown(base, attrs, "entity_id", "code", ["k1", "k2"], _PASS_VALUES, ["o_orderkey"])


def set_difference(spark, sf):
    sold = f.table(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40))
    return select.missing_keys(f.table(spark, sf, "part").select("p_partkey"), sold.select(F.col("l_partkey").alias("p_partkey")), ["p_partkey"])


def bag_union(spark, sf):
    cust = f.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    supp = f.table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("supplier")
    )
    out = select.stack_relaxed([cust, supp])
    return out.groupBy("nation").agg(
        F.count("*").alias("accounts"), F.count("supplier").alias("suppliers"), f.rounded(F.sum("balance"), 2).alias("balance")
    )


def distinct_keys(spark, sf):
    return f.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


def empty_lookup(spark, sf):
    nothing = select.empty_frame(spark, struct("c_mktsegment string, fee double"))
    out = match.lookup(f.table(spark, sf, "customer"), nothing, ["c_mktsegment"])
    return out.select("c_custkey", "c_mktsegment", "fee")


# --- registries as text, for the typed dimensions ---------------------------


def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _registries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as classes, suppliers as funds, parts as subclasses of every third class."""
    status = F.when(F.col("c_acctbal") >= 0, "OPEN").otherwise("CLOSED")
    classes = f.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ID_Registro_Classe"),
        _per(F.col("c_custkey"), 15).alias("ID_Registro_Fundo"),
        F.concat(F.lit("CN/"), F.col("c_custkey").cast("string")).alias("CNPJ_Classe"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("Denominacao_Social"),
        status.alias("Situacao"),
        F.when(F.col("c_custkey") % 5 != 0, F.date_format(F.date_add(F.lit("1999-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int")), "yyyy-MM-dd"))
        .otherwise("n/d")
        .alias("Data_Inicio_Situacao"),
        F.lit("N").alias("Exclusivo"),
        F.col("c_mktsegment").alias("Publico_Alvo"),
        F.lit("Aberto").alias("Forma_Condominio"),
    )
    funds = f.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("ID_Registro_Fundo"),
        F.concat(F.lit("F-"), F.col("s_suppkey").cast("string")).alias("CNPJ_Fundo"),
        F.concat(F.col("s_name"), F.lit(" ")).alias("Denominacao_Social"),
    )
    subs = f.table(spark, sf, "part").select(
        (_per(F.col("p_partkey"), 4) * 3).alias("ID_Registro_Classe"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ID_Subclasse"),
        F.concat(F.lit(" "), F.col("p_name")).alias("Denominacao_Social"),
        F.lit("OPEN").alias("Situacao"),
        F.lit("2001-02-03").alias("Data_Inicio_Situacao"),
        F.lit("S").alias("Exclusivo"),
        F.col("p_brand").alias("Publico_Alvo"),
        F.col("p_type").alias("Forma_Condominio"),
    )
    return _text(classes), _text(funds), _text(subs)


def _drop_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the attribute drop: classes by customer, subclasses by part number."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return f.table(spark, sf, "orders").select(
        F.concat(F.lit("F-"), _per(c, 15).cast("string")).alias("CNPJ do Fundo"),
        F.concat(F.lit("CN/"), c.cast("string")).alias("cnpj classe"),
        F.when(k % 4 == 0, F.lit(" Subclasse")).otherwise(F.lit("CLASSE ")).alias("Estrutura"),
        F.when(k % 8 == 0, F.concat(F.lit(" P"), (k / 8).cast("bigint").cast("string"))).alias("Código CVM Subclasse"),
        F.concat(F.when(k % 3 == 0, F.lit("Multi ")).otherwise(F.lit("Renda Fixa ")), "o_orderpriority").alias("Tipo ANBIMA"),
        F.col("o_orderstatus").alias("Composição dos Fundos"),
        F.when(k % 7 != 0, F.col("o_orderpriority")).alias("Tributação Alvo"),
        (k % 1000).cast("string").alias("Aplicacao Inicial Minima"),
        F.when(k % 9 == 0, F.lit("30.0")).otherwise((k % 60).cast("string")).alias("Prazo Pagamento Resgate (dias)"),
        "o_orderkey",
    )


def _fee_history(spark: SparkSession, sf: str, value: str, since: str, shown) -> DataFrame:
    li = f.table(spark, sf, "lineitem")
    return _text(
        li.select(
            F.concat(F.lit("F-"), F.col("l_suppkey").cast("string")).alias("CNPJ_FUNDO"),
            F.when(F.col("l_orderkey") % 10 != 0, F.date_format("l_shipdate", "yyyy-MM-dd")).alias(since),
            shown.alias(value),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
        )
    ).withColumn("line", F.lpad("line", 20, "0"))


def _lookups(spark: SparkSession, sf: str):
    return dimensions.fee_and_benchmark_lookups(
        spark,
        _fee_history(spark, sf, "TAXA_ADM", "DT_INI_TAXA_ADM", F.col("l_quantity")),
        _fee_history(spark, sf, "VL_TAXA_PERFM", "DT_INI_TAXA_PERFM", F.col("l_discount") * 100),
        _fee_history(spark, sf, "RENTAB_FUNDO", "DT_INI_RENTAB", F.col("l_returnflag")),
        order=["line"],
    )


def latest_attribute(spark, sf):
    history = _fee_history(spark, sf, "TAXA_ADM", "DT_INI_TAXA_ADM", F.col("l_quantity"))
    return dimensions.latest_attribute(
        history, spark, "TAXA_ADM", "DT_INI_TAXA_ADM", "taxa_adm", as_percent=True, order=["line"]
    )


def attribute_drop(spark, sf):
    return attributes.parent_attributes(_drop_table(spark, sf), ["o_orderkey"])


def attribute_drop_children(spark, sf):
    return attributes.child_attributes(_drop_table(spark, sf), ["o_orderkey"]).drop("o_orderkey")


def _class_dimension(spark, sf):
    classes, funds, subs = _registries(spark, sf)
    attrs = attributes.parent_attributes(_drop_table(spark, sf), ["o_orderkey"])
    return dimensions.class_dimension(classes, funds, subs, attrs, _lookups(spark, sf))


def _fees_rounded(dim: DataFrame) -> DataFrame:
    return dim.withColumns({c: f.rounded(c, 9) for c in dimensions.FEES})


def class_dimension(spark, sf):
    return _fees_rounded(_class_dimension(spark, sf))


def fixed_income_subset(spark, sf):
    return _fees_rounded(dimensions.fixed_income(_class_dimension(spark, sf)))


def treated_dimension(spark, sf):
    stored = materialise(dimensions.fixed_income(_class_dimension(spark, sf)), "class_funds_fixed_income")
    return _fees_rounded(dimensions.treated(stored))


def _subclass_dimension(spark, sf):
    classes, funds, subs = _registries(spark, sf)
    attrs = attributes.child_attributes(_drop_table(spark, sf), ["o_orderkey"])
    return dimensions.subclass_dimension(subs, classes, funds, attrs, _lookups(spark, sf), [])


def subclass_dimension(spark, sf):
    return _fees_rounded(_subclass_dimension(spark, sf))


def treated_subclass_dimension(spark, sf):
    reference = dimensions.fixed_income(_class_dimension(spark, sf))
    sub = dimensions.fixed_income(_subclass_dimension(spark, sf))
    return _fees_rounded(dimensions.treated(sub, stats_from=reference))


_ID = "lpad(regexp_replace({0}, '\\D', '', 'g'), 14, '0')"
_DROP_SQL = f"""drops AS (SELECT {_ID.format("'F-' || CAST(o_custkey // 15 AS VARCHAR)")} AS cnpj_fundo,
  lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS cnpj_classe,
  CASE WHEN o_orderkey % 4 = 0 THEN 'sub' ELSE 'cls' END AS kind,
  CASE WHEN o_orderkey % 8 = 0 THEN 'P' || CAST(o_orderkey // 8 AS VARCHAR) END AS codigo_cvm_subclasse,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Multi ' ELSE 'Renda Fixa ' END || o_orderpriority AS classificacao_anbima,
  o_orderstatus AS composicao_fundos, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS tributacao_alvo,
  CAST(o_orderkey % 1000 AS VARCHAR) AS aplicacao_minima,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 60 END AS prazo_de_resgate, o_orderkey FROM orders)"""
_ATTRS = ", ".join(ATTRIBUTE_COLUMNS)
_FEE_SQL = """{0} AS (SELECT cnpj_fundo, v AS {1} FROM (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 14, '0') AS cnpj_fundo, {2} AS v,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY CASE WHEN l_orderkey % 10 <> 0 THEN CAST(l_shipdate AS DATE) END DESC NULLS LAST,
      l_orderkey * 10 + l_linenumber, {2}) AS rn FROM lineitem) WHERE rn = 1)"""
_LOOKUP_SQL = ",\n".join(
    [
        _FEE_SQL.format("adm", "taxa_adm", "l_quantity / 100"),
        _FEE_SQL.format("perf", "taxa_perform", "l_discount * 100 / 100"),
        _FEE_SQL.format("rent", "benchmark", "l_returnflag"),
    ]
)
_PARENT_SQL = f"""pattrs AS (SELECT cnpj_fundo, cnpj_classe, {_ATTRS} FROM (
  SELECT *, row_number() OVER (PARTITION BY cnpj_fundo, cnpj_classe ORDER BY o_orderkey) AS rn FROM drops WHERE kind = 'cls') WHERE rn = 1)"""
_CLASS_SQL = f"""cls AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS cnpj_fundo, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS cnpj_classe,
  s_name AS denom_social_fundo, c_name AS denom_social_classe, CASE WHEN c_acctbal >= 0 THEN 'OPEN' ELSE 'CLOSED' END AS situacao,
  CASE WHEN c_custkey % 5 <> 0 THEN DATE '1999-01-01' + CAST(c_custkey % 900 AS INTEGER) END AS data_de_inicio, 'N' AS exclusivo,
  c_mktsegment AS publico_alvo, 'Aberto' AS condominio
 FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey // 15
 WHERE c_custkey NOT IN (SELECT p_partkey // 4 * 3 FROM part)),
full_cls AS (SELECT cls.*, {_ATTRS}, taxa_adm, taxa_perform, benchmark FROM cls
 LEFT JOIN pattrs USING (cnpj_fundo, cnpj_classe) LEFT JOIN adm USING (cnpj_fundo) LEFT JOIN perf USING (cnpj_fundo) LEFT JOIN rent USING (cnpj_fundo))"""
_SUB_SQL = f"""p1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codigo_cvm_subclasse ORDER BY {_ATTRS}) AS rn
  FROM drops WHERE kind = 'sub' AND codigo_cvm_subclasse IS NOT NULL) WHERE rn = 1),
p2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_fundo, cnpj_classe ORDER BY {', '.join(a + ' NULLS FIRST' for a in ATTRIBUTE_COLUMNS)}) AS rn
  FROM drops WHERE kind = 'sub' AND codigo_cvm_subclasse IS NULL) WHERE rn = 1),
sub AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS cnpj_fundo, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS cnpj_classe,
  'P' || CAST(p_partkey AS VARCHAR) AS id_subclasse_cvm, p_name AS denom_social_subclasse, 'OPEN' AS situacao, DATE '2001-02-03' AS data_de_inicio,
  'S' AS exclusivo, p_brand AS publico_alvo, p_type AS condominio
 FROM part LEFT JOIN customer ON c_custkey = p_partkey // 4 * 3 LEFT JOIN supplier ON s_suppkey = c_custkey // 15),
full_sub AS (SELECT sub.*, {', '.join(f'coalesce(p1.{a}, p2.{a}) AS {a}' for a in ATTRIBUTE_COLUMNS)}, taxa_adm, taxa_perform, benchmark FROM sub
 LEFT JOIN p1 ON p1.codigo_cvm_subclasse = sub.id_subclasse_cvm
 LEFT JOIN p2 ON p2.cnpj_fundo = sub.cnpj_fundo AND p2.cnpj_classe = sub.cnpj_classe
 LEFT JOIN adm ON adm.cnpj_fundo = sub.cnpj_fundo LEFT JOIN perf ON perf.cnpj_fundo = sub.cnpj_fundo LEFT JOIN rent ON rent.cnpj_fundo = sub.cnpj_fundo)"""
_FEES_SQL = "* REPLACE (round(taxa_adm, 9) + 0.0 AS taxa_adm, round(taxa_perform, 9) + 0.0 AS taxa_perform)"


def _treated_sql(rows: str) -> str:
    def stats(c: str) -> str:
        return f"""(SELECT avg({c}) - 3 * coalesce(stddev_samp({c}), 0) AS lo, avg({c}) + 3 * coalesce(stddev_samp({c}), 0) AS hi,
  (SELECT {c} FROM base WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode FROM base)"""

    def filled(c: str, s: str) -> str:
        return f"round(CASE WHEN {s}.mode IS NOT NULL AND ({c} IS NULL OR {c} < {s}.lo OR {c} > {s}.hi) THEN {s}.mode ELSE {c} END, 9) + 0.0 AS {c}"

    return f"""SELECT t.* REPLACE ({filled('taxa_adm', 'a')}, {filled('taxa_perform', 'p')}, coalesce(benchmark, 'CDI') AS benchmark)
FROM {rows} t, {stats('taxa_adm')} a, {stats('taxa_perform')} p"""


_DIM_SQL = f"WITH {_DROP_SQL},\n{_PARENT_SQL},\n{_LOOKUP_SQL},\n{_CLASS_SQL}"
_BASE_SQL = "base AS (SELECT * FROM full_cls WHERE classificacao_anbima LIKE 'Renda Fixa%')"
_SUBDIM_SQL = f"WITH {_DROP_SQL},\n{_LOOKUP_SQL},\n{_SUB_SQL}"

_PASS_SQL = """WITH base AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id, c_custkey // 7 AS k1, c_custkey % 7 AS k2 FROM customer),
attrs AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS code, o_custkey // 7 AS k1, o_orderkey % 11 AS k2,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS segment, o_orderpriority AS owner, o_orderkey FROM orders),
p1 AS (SELECT * FROM attrs WHERE code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code ORDER BY o_orderkey) = 1),
p2 AS (SELECT * FROM attrs WHERE code IS NULL QUALIFY row_number() OVER (PARTITION BY k1, k2 ORDER BY o_orderkey) = 1),
m AS (SELECT b.*, p1.segment AS s1, p1.owner AS o1, p2.segment AS s2, p2.owner AS o2 FROM base b
  LEFT JOIN p1 ON p1.code = b.entity_id LEFT JOIN p2 ON p2.k1 = b.k1 AND p2.k2 = b.k2)
"""

QUERIES = {
    "entity_union": (
        entity_union,
        f.with_ctes(
            """SELECT cnpj_classe, id_subclasse_cvm, situacao, benchmark, fund_key, cnpj_classe AS cnpj_fundo_classe_join,
 coalesce(id_subclasse_cvm, '__CLASSE__') AS id_subclasse_join FROM dim""",
            "dim",
        ),
    ),
    "sentinel_join": (
        sentinel_join,
        f.with_ctes(
            """SELECT fund_key, count(*) AS days, max(dt_comptc) AS last_day FROM quotas q JOIN dim d
 ON q.cnpj_fundo_classe = d.cnpj_classe AND coalesce(q.id_subclasse, '__CLASSE__') = coalesce(d.id_subclasse_cvm, '__CLASSE__')
 WHERE situacao = 'OPEN' GROUP BY fund_key""",
            "quotas",
            "dim",
        ),
    ),
    "anti_parent": (
        anti_parent,
        """SELECT c_custkey, c_name, c_mktsegment FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 400000)""",
    ),
    "hierarchy_chain": (
        hierarchy_chain,
        """SELECT l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_name, c_nationkey FROM lineitem
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey""",
    ),
    "star_enrich": (
        star_enrich,
        """SELECT c_custkey, o_orderstatus, n_name, r_name FROM customer
LEFT JOIN (SELECT o_custkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1) ON o_custkey = c_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    ),
    "composite_lookup": (
        composite_lookup,
        """SELECT l_partkey, l_suppkey, count(*) AS lines, min(l_quantity) FILTER (l_returnflag = 'R') AS min_returned
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    ),
    "discriminated_semi": (
        discriminated_semi,
        f.with_ctes(
            """SELECT cnpj_fundo_classe, id_subclasse, dt_comptc, nr_cotst, round(vl_patrim_liq, 2) + 0.0 AS vl_patrim_liq FROM quotas
WHERE (id_subclasse IS NULL AND cnpj_fundo_classe IN (SELECT cnpj_classe FROM classes WHERE tributacao_alvo = 'ASIA'))
   OR id_subclasse IN (SELECT id_subclasse_cvm FROM subclasses WHERE publico_alvo = 'RETAIL')""",
            "quotas",
            "classes",
            "subclasses",
        ),
    ),
    "override_attributes": (
        override_attributes,
        f.with_ctes(
            """SELECT fund_key, d.cnpj_classe, d.id_subclasse_cvm, coalesce(nullif(s.benchmark, 'DAILY'), c.benchmark) AS benchmark,
 coalesce(s.denom_social_subclasse, c.denom_social_classe) AS nome
FROM dim d LEFT JOIN classes c ON c.cnpj_classe = d.cnpj_classe LEFT JOIN subclasses s ON s.id_subclasse_cvm = d.id_subclasse_cvm""",
            "dim",
        ),
    ),
    "two_pass_match": (
        two_pass_match,
        _PASS_SQL + "SELECT entity_id, k1, k2, coalesce(s1, s2) AS segment, coalesce(o1, o2) AS owner FROM m",
    ),
    "match_breakdown": (
        match_breakdown,
        _PASS_SQL
        + """SELECT CAST(count(*) FILTER (s1 IS NOT NULL) AS BIGINT) AS pass1_matched,
 CAST(count(*) FILTER (s1 IS NULL AND s2 IS NOT NULL) AS BIGINT) AS pass2_matched,
 CAST(count(*) FILTER (s1 IS NULL AND s2 IS NULL) AS BIGINT) AS unmatched,
 (SELECT count(*) FROM attrs WHERE code IS NULL) - (SELECT count(*) FROM p2) AS ambiguity_dropped FROM m""",
    ),
    "set_difference": (
        set_difference,
        """SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40""",
    ),
    "bag_union": (
        bag_union,
        """SELECT nation, count(*) AS accounts, count(supplier) AS suppliers, round(sum(balance), 2) + 0.0 AS balance FROM (
 SELECT c_nationkey AS nation, c_acctbal AS balance, NULL AS supplier FROM customer
 UNION ALL SELECT s_nationkey, s_acctbal, s_name FROM supplier) GROUP BY nation""",
    ),
    "distinct_keys": (distinct_keys, "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem"),
    "empty_lookup": (empty_lookup, "SELECT c_custkey, c_mktsegment, CAST(NULL AS DOUBLE) AS fee FROM customer"),
    "latest_attribute": (latest_attribute, f"WITH {_LOOKUP_SQL} SELECT cnpj_fundo, taxa_adm FROM adm"),
    "attribute_drop": (attribute_drop, f"WITH {_DROP_SQL},\n{_PARENT_SQL} SELECT * FROM pattrs"),
    "attribute_drop_children": (
        attribute_drop_children,
        f"WITH {_DROP_SQL} SELECT codigo_cvm_subclasse, cnpj_fundo, cnpj_classe, {_ATTRS} FROM drops WHERE kind = 'sub'",
    ),
    "class_dimension": (class_dimension, f"{_DIM_SQL} SELECT {_FEES_SQL} FROM full_cls"),
    "fixed_income_subset": (
        fixed_income_subset,
        f"{_DIM_SQL} SELECT {_FEES_SQL} FROM full_cls WHERE classificacao_anbima LIKE 'Renda Fixa%'",
    ),
    "treated_dimension": (treated_dimension, f"{_DIM_SQL},\n{_BASE_SQL} {_treated_sql('base')}"),
    "subclass_dimension": (subclass_dimension, f"{_SUBDIM_SQL} SELECT {_FEES_SQL} FROM full_sub"),
    "treated_subclass_dimension": (
        treated_subclass_dimension,
        f"""{_DIM_SQL},\n{_BASE_SQL},\n{_SUB_SQL}
{_treated_sql("(SELECT * FROM full_sub WHERE classificacao_anbima LIKE 'Renda Fixa%')")}""",
    ),
}
