"""The shared test tables seen as entities, daily series and reference series.

Each frame has a SQL twin in :data:`CTES`.  Suppliers are the entities: an
even key is a parent, an odd key a child of the even key below it.
"""

from __future__ import annotations

from datetime import date
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reference import INDEX_LEVEL, PERCENT_PER_DAY, PERCENT_PER_MONTH
from ..operators.score import Eligibility, MetricSpec, ScoringConfig
from ..session import spread

AS_OF = date(2001, 10, 31)
ANCHORS = (date(1999, 12, 31), date(2000, 12, 31))
WINDOW = 60
SIGMA = 3.0

UNITS = {
    "p1": ("1-URGENT", INDEX_LEVEL),
    "p2": ("2-HIGH", INDEX_LEVEL),
    "p3": ("3-MEDIUM", INDEX_LEVEL),
    "p4": ("4-NOT SPECIFIED", INDEX_LEVEL),
    "p5": ("5-LOW", INDEX_LEVEL),
    "daily_rate": ("DAILY", PERCENT_PER_DAY),
    "monthly_rate": ("MONTHLY", PERCENT_PER_MONTH),
}
CODES = [code for code, _ in UNITS.values()]
RATES = {"AFRICA": 0.0, "AMERICA": 0.15, "ASIA": 0.20, "EUROPE": None}
PROFILES = {
    "RETAIL": ["RETAIL"],
    "QUALIFIED": ["RETAIL", "QUALIFIED"],
    "PROFESSIONAL": ["RETAIL", "QUALIFIED", "PROFESSIONAL"],
}
SCORING = ScoringConfig(
    metrics={
        "information_ratio": MetricSpec("positive", 0.60),
        "sortino_ratio": MetricSpec("positive", 0.25),
        "tax_efficiency": MetricSpec("positive", 0.15),
    },
    eligibility=Eligibility(situacao="OPEN", nr_cotst_min=0, existing_time_min_days=252, equity_min_brl=20_000.0),
    top_n=5,
    rates=RATES,
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def padded(c: Column) -> Column:
    return F.lpad(c.cast("string"), 14, "0")


def quotas(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series per supplier with the canonical series columns.

    Lines are exchanged once, by supplier and day, so a supplier with a third
    of all lines is spread over its days.  Nearly every line is a day or an
    order of its own: counting the orders in steps on the map side would hold
    all lines of a task, twice, and save nothing.
    """
    price, lines = F.col("l_extendedprice"), table(spark, sf, "lineitem")
    dated = lines.withColumn("dt_comptc", F.col("l_shipdate").cast("date"))
    daily = (
        spread(dated, ["l_suppkey", "dt_comptc"], lines.count())
        .groupBy("l_suppkey", "dt_comptc")
        .agg(
            F.avg(price / F.col("l_quantity")).alias("vl_quota"),
            F.sum(price).alias("vl_patrim_liq"),
            F.count_distinct("l_orderkey").alias("nr_cotst"),
        )
    )
    key = F.col("l_suppkey")
    return daily.select(
        padded(key - key % 2).alias("cnpj_fundo_classe"),
        F.when(key % 2 == 1, F.concat(F.lit("S"), key.cast("string"))).alias("id_subclasse"),
        "dt_comptc",
        "vl_quota",
        "vl_patrim_liq",
        "nr_cotst",
    )


def keyed_quotas(spark: SparkSession, sf: str) -> DataFrame:
    """The daily series under its entity key."""
    return quotas(spark, sf).select(
        F.when(F.col("id_subclasse").isNull(), F.concat(F.lit("CLS_"), "cnpj_fundo_classe"))
        .otherwise(F.concat(F.lit("SUB_"), "id_subclasse"))
        .alias("fund_key"),
        "dt_comptc",
        "vl_quota",
        "vl_patrim_liq",
        "nr_cotst",
    )


def _entities(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    k = F.col("s_suppkey")
    return (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            k,
            padded(F.col("s_nationkey")).alias("cnpj_fundo"),
            padded(k - k % 2).alias("cnpj_classe"),
            F.concat(F.lit("S"), k.cast("string")).alias("id_subclasse_cvm"),
            F.col("s_name").alias("name"),
            F.when(F.col("s_acctbal") >= 0, "OPEN").otherwise("CLOSED").alias("situacao"),
            F.when(F.col("s_nationkey") % 4 <= 1, "RETAIL")
            .when(F.col("s_nationkey") % 4 == 2, "QUALIFIED")
            .otherwise("PROFESSIONAL")
            .alias("publico_alvo"),
            F.get(F.array(*[F.lit(c) for c in CODES]), (k % len(CODES)).cast("int")).alias("benchmark"),
            F.col("r_name").alias("tributacao_alvo"),
            F.col("n_name").alias("classificacao_anbima"),
            F.date_add(F.lit(date(1995, 1, 1)), ((k * 37) % 2500).cast("int")).alias("data_de_inicio"),
        )
    )


def classes(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _entities(spark, sf)
        .filter(F.col("s_suppkey") % 2 == 0)
        .drop("s_suppkey", "id_subclasse_cvm")
        .withColumnRenamed("name", "denom_social_classe")
    )


def subclasses(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _entities(spark, sf)
        .filter(F.col("s_suppkey") % 2 == 1)
        .drop("s_suppkey")
        .withColumnRenamed("name", "denom_social_subclasse")
    )


def reference_long(spark: SparkSession, sf: str) -> DataFrame:
    """``(code, data, valor)``: order values by priority, and two line rates."""
    levels = (
        table(spark, sf, "orders")
        .groupBy(
            F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)).alias("code"),
            F.col("o_orderdate").cast("date").alias("data"),
        )
        .agg(F.avg("o_totalprice").alias("valor"))
    )
    rates = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("data"))
        .agg(F.avg("l_tax").alias("daily_rate"), F.avg("l_discount").alias("monthly_rate"))
        .unpivot(["data"], ["daily_rate", "monthly_rate"], "code", "valor")
    )
    return levels.unionByName(rates)


_UNIT_ROWS = ", ".join(f"('{c}', '{code}', '{unit}')" for c, (code, unit) in UNITS.items())
_CODE_LIST = ", ".join(f"'{c}'" for c in CODES)
_WIDE_COLUMNS = ", ".join(f"max(valor) FILTER (code = '{c}') AS {c}" for c in UNITS)

# Name -> (names it builds on, SQL).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "quotas": (
        (),
        """SELECT lpad(CAST(l_suppkey - l_suppkey % 2 AS VARCHAR), 14, '0') AS cnpj_fundo_classe,
       CASE WHEN l_suppkey % 2 = 1 THEN 'S' || CAST(l_suppkey AS VARCHAR) END AS id_subclasse,
       CAST(l_shipdate AS DATE) AS dt_comptc,
       avg(l_extendedprice / l_quantity) AS vl_quota,
       sum(l_extendedprice) AS vl_patrim_liq,
       count(DISTINCT l_orderkey) AS nr_cotst
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    ),
    "keyed": (
        ("quotas",),
        """SELECT CASE WHEN id_subclasse IS NULL THEN 'CLS_' || cnpj_fundo_classe ELSE 'SUB_' || id_subclasse END AS fund_key,
       dt_comptc, vl_quota, vl_patrim_liq, nr_cotst FROM quotas""",
    ),
    "entities": (
        (),
        f"""SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 14, '0') AS cnpj_fundo,
       lpad(CAST(s_suppkey - s_suppkey % 2 AS VARCHAR), 14, '0') AS cnpj_classe,
       'S' || CAST(s_suppkey AS VARCHAR) AS id_subclasse_cvm, s_name AS name,
       CASE WHEN s_acctbal >= 0 THEN 'OPEN' ELSE 'CLOSED' END AS situacao,
       CASE WHEN s_nationkey % 4 <= 1 THEN 'RETAIL' WHEN s_nationkey % 4 = 2 THEN 'QUALIFIED' ELSE 'PROFESSIONAL' END AS publico_alvo,
       ([{_CODE_LIST}])[CAST(s_suppkey % {len(CODES)} AS INTEGER) + 1] AS benchmark,
       r_name AS tributacao_alvo, n_name AS classificacao_anbima,
       DATE '1995-01-01' + CAST((s_suppkey * 37) % 2500 AS INTEGER) AS data_de_inicio
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "classes": (
        ("entities",),
        "SELECT * EXCLUDE (s_suppkey, id_subclasse_cvm, name), name AS denom_social_classe FROM entities WHERE s_suppkey % 2 = 0",
    ),
    "subclasses": (
        ("entities",),
        "SELECT * EXCLUDE (s_suppkey, name), name AS denom_social_subclasse FROM entities WHERE s_suppkey % 2 = 1",
    ),
    "dim": (
        ("classes", "subclasses"),
        """SELECT cnpj_classe, CAST(NULL AS VARCHAR) AS id_subclasse_cvm, situacao, publico_alvo, benchmark, tributacao_alvo,
       data_de_inicio, 'CLS_' || cnpj_classe AS fund_key, cnpj_fundo, denom_social_classe AS nome FROM classes
UNION ALL
SELECT cnpj_classe, id_subclasse_cvm, situacao, publico_alvo, benchmark, tributacao_alvo,
       data_de_inicio, 'SUB_' || id_subclasse_cvm, cnpj_fundo, denom_social_subclasse FROM subclasses""",
    ),
    "daily": (
        ("keyed", "dim"),
        f"""SELECT k.* FROM keyed k JOIN dim USING (fund_key) WHERE dt_comptc <= DATE '{AS_OF}'""",
    ),
    "returns": (
        ("daily",),
        """SELECT *, CASE WHEN vl_quota > 0 AND lag(vl_quota) OVER w > 0 THEN ln(vl_quota / lag(vl_quota) OVER w) END AS log_ret
FROM daily WINDOW w AS (PARTITION BY fund_key ORDER BY dt_comptc)""",
    ),
    "flagged": (
        ("returns",),
        f"""SELECT *, coalesce(cnt >= {WINDOW} AND sd > 1e-12 * abs(mn) AND abs((log_ret - mn) / sd) > {SIGMA}, FALSE) AS is_jump FROM (
  SELECT *, count(log_ret) OVER w AS cnt, avg(log_ret) OVER w AS mn, stddev_samp(log_ret) OVER w AS sd
  FROM returns WINDOW w AS (PARTITION BY fund_key ORDER BY dt_comptc ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW))""",
    ),
    "eom": (
        ("flagged",),
        """SELECT fund_key, CAST(date_trunc('month', dt_comptc) AS DATE) AS year_month,
       arg_max_null(vl_quota, dt_comptc) AS vl_quota_eom FROM flagged WHERE NOT is_jump GROUP BY ALL""",
    ),
    "monthly": (
        ("eom",),
        """SELECT fund_key, year_month, vl_quota_eom, known / lag(known) OVER (PARTITION BY fund_key ORDER BY year_month) - 1 AS monthly_ret
FROM (SELECT *, last_value(vl_quota_eom IGNORE NULLS) OVER (PARTITION BY fund_key ORDER BY year_month
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known FROM eom)""",
    ),
    "reflong": (
        (),
        """SELECT 'p' || substr(o_orderpriority, 1, 1) AS code, CAST(o_orderdate AS DATE) AS data, avg(o_totalprice) AS valor
FROM orders GROUP BY ALL
UNION ALL SELECT 'daily_rate', CAST(l_shipdate AS DATE), avg(l_tax) FROM lineitem GROUP BY ALL
UNION ALL SELECT 'monthly_rate', CAST(l_shipdate AS DATE), avg(l_discount) FROM lineitem GROUP BY ALL""",
    ),
    "wide": (
        ("reflong",),
        f"SELECT data, {_WIDE_COLUMNS} FROM reflong WHERE data <= DATE '{AS_OF}' GROUP BY data",
    ),
    "refmonthly": (
        ("reflong",),
        f"""SELECT year_month, bench AS benchmark_code, CASE unit WHEN '{PERCENT_PER_DAY}' THEN comp WHEN '{PERCENT_PER_MONTH}' THEN pub
       ELSE lvl / lag(lvl) OVER (PARTITION BY code ORDER BY year_month) - 1 END AS monthly_bench_ret
FROM (SELECT code, bench, unit, CAST(date_trunc('month', data) AS DATE) AS year_month,
        product(1 + valor / 100) - 1 AS comp, arg_min(valor, data) / 100 AS pub, arg_max(valor, data) AS lvl
      FROM reflong JOIN (VALUES {_UNIT_ROWS}) u(code, bench, unit) USING (code)
      WHERE valor IS NOT NULL AND data <= DATE '{AS_OF}' GROUP BY ALL)
QUALIFY monthly_bench_ret IS NOT NULL""",
    ),
    "excess": (
        ("monthly", "dim", "refmonthly"),
        """SELECT fund_key, year_month, monthly_ret - monthly_bench_ret AS excess FROM monthly JOIN dim USING (fund_key)
JOIN refmonthly r USING (year_month) WHERE r.benchmark_code = dim.benchmark AND monthly_ret IS NOT NULL""",
    ),
    "stats": (
        ("excess",),
        """SELECT fund_key, avg(excess) AS excess_mean, stddev_samp(excess) AS excess_std,
       stddev_samp(least(excess, 0)) AS downside_std FROM excess GROUP BY fund_key""",
    ),
    "latest": (
        ("daily",),
        """SELECT fund_key, arg_max(vl_patrim_liq, dt_comptc) AS equity, arg_max(nr_cotst, dt_comptc) AS nr_cotst
FROM daily GROUP BY fund_key""",
    ),
    "metrics": (
        ("dim", "stats", "latest"),
        f"""SELECT fund_key, cnpj_classe, id_subclasse_cvm, situacao, publico_alvo, tributacao_alvo, equity,
       coalesce(nr_cotst, 0) AS nr_cotst, greatest(date_diff('day', data_de_inicio, DATE '{AS_OF}'), 0) AS existing_time,
       CASE WHEN excess_std > 1e-12 * abs(excess_mean) THEN excess_mean / excess_std * sqrt(12) END AS information_ratio,
       CASE WHEN downside_std > 1e-12 * abs(excess_mean) THEN excess_mean * 12 / (downside_std * sqrt(12)) END AS sortino_ratio,
       CASE tributacao_alvo WHEN 'AFRICA' THEN 1.0 WHEN 'AMERICA' THEN 0.85 WHEN 'ASIA' THEN 0.8 END::DOUBLE AS tax_efficiency
FROM dim LEFT JOIN stats USING (fund_key) LEFT JOIN latest USING (fund_key)""",
    ),
    "zs": (
        ("metrics",),
        """SELECT m.*, elig, (information_ratio - i_m) / nullif(i_s, 0) AS z_information_ratio,
       (sortino_ratio - s_m) / nullif(s_s, 0) AS z_sortino_ratio, (tax_efficiency - t_m) / nullif(t_s, 0) AS z_tax_efficiency
FROM (SELECT *, coalesce(situacao = 'OPEN' AND nr_cotst > 0 AND existing_time >= 252 AND equity >= 20000, FALSE) AS elig FROM metrics) m,
     (SELECT avg(information_ratio) i_m, stddev_samp(information_ratio) i_s, avg(sortino_ratio) s_m, stddev_samp(sortino_ratio) s_s,
             avg(tax_efficiency) t_m, stddev_samp(tax_efficiency) t_s FROM metrics
      WHERE situacao = 'OPEN' AND nr_cotst > 0 AND existing_time >= 252 AND equity >= 20000)""",
    ),
    "composed": (
        ("zs",),
        "SELECT *, CASE WHEN elig THEN 0.6 * z_information_ratio + 0.25 * z_sortino_ratio + 0.15 * z_tax_efficiency END AS comp FROM zs",
    ),
    "scored": (
        ("composed",),
        """SELECT *, CASE WHEN comp IS NOT NULL THEN CAST(round_even(
         (rank() OVER (ORDER BY comp NULLS LAST) + (count(*) OVER (PARTITION BY comp) - 1) / 2.0)
         / (SELECT count(comp) FROM composed) * 100.0, 2) AS DOUBLE) END AS score FROM composed""",
    ),
}


def with_ctes(query: str, *names: str) -> str:
    """``query`` behind the WITH clause it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + f"\n{query}"
