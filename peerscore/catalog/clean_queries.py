"""De-duplication, normalisation, parsing, predicates, imputation and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts, text
from ..operators import dedup, impute, quality, select
from ..schemas import struct
from . import frames as f


def keep_first_dedup(spark, sf):
    li = f.table(spark, sf, "lineitem")
    rest = [c for c in li.columns if c not in ("l_orderkey", "l_linenumber")]
    out = dedup.keep_first(li, ["l_orderkey", "l_linenumber"], rest)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def latest_record(spark, sf):
    o = f.table(spark, sf, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("since"),
        casts.percent(F.col("o_totalprice")).alias("rate"),
    )
    out = dedup.latest_record(o, "o_custkey", "since", ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "since", f.rounded("rate").alias("rate"))


def any_row_dedup(spark, sf):
    e = f.table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"), "event_type", "value")
    return dedup.any_per_key(e, ["day", "event_type"])


def normalise_ids(spark, sf):
    return f.table(spark, sf, "customer").select(
        "c_custkey",
        text.clean_id(F.col("c_name")).alias("id14"),
        text.clean_id(F.concat("c_name", F.lit("/"), "c_name")).alias("cut14"),
        text.clean_id(F.col("c_mktsegment")).alias("zeros"),
        text.clean_id_or_null(F.col("c_mktsegment")).alias("nothing"),
        text.clean_id_or_null(F.col("c_name")).alias("id_or_null"),
    )


def normalise_text(spark, sf):
    return f.table(spark, sf, "documents").select("doc_id", text.normalise_text(F.col("text")).alias("normal"))


def trimmed_text(spark, sf):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit("\t "))
    return f.table(spark, sf, "part").select("p_partkey", text.text_trim(padded).alias("name"), text.text_trim(F.col("p_size")).alias("size"))


def prefix_filter(spark, sf):
    return select.with_prefix(f.table(spark, sf, "part"), "p_name", "small").select("p_partkey", "p_name")


def equality_filter(spark, sf):
    noisy = f.table(spark, sf, "customer").withColumn("segment", F.concat(F.lit(" "), F.initcap("c_mktsegment"), F.lit("  ")))
    kept = select.with_label(noisy, select.find_column(noisy, "Segmento", " SEGMENT "), "building")
    return select.with_label(kept, select.find_column(noisy, "no such"), "x").select("c_custkey", "c_name")


def membership(spark, sf):
    return select.among(f.table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey")


def point_in_time(spark, sf):
    o = f.table(spark, sf, "orders").withColumn(
        "day", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    )
    return select.on_or_before(o, "day", f.ANCHORS[0]).select("o_orderkey", "day")


def _raw_events(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return f.table(spark, sf, "events").select(
        "event_id",
        F.when(e % 11 == 0, F.date_format("ts", "dd/MM/yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.when(e % 7 == 0, F.concat(F.col("value").cast("string"), F.lit("x")))
        .when(e % 7 == 1, F.concat(F.lit(" "), F.col("value").cast("string")))
        .when(e % 7 == 2, F.lit("N/A"))
        .otherwise(F.col("value").cast("string"))
        .alias("amount"),
        F.when(e % 5 == 0, F.concat(F.col("user_id").cast("string"), F.lit(".0"))).otherwise(F.col("user_id").cast("string")).alias("holders"),
    )


def typed_parse(spark, sf):
    return select.typed(
        _raw_events(spark, sf),
        {
            "day": F.coalesce(casts.iso_date(F.col("day")), casts.dmy_date(F.col("day"))),
            "amount": casts.to_double(casts.null_tokens(F.col("amount"))),
            "holders": casts.to_long(F.col("holders")),
        },
    )


def iso_only(spark, sf):
    return _raw_events(spark, sf).select("event_id", casts.iso_date(F.col("day")).alias("day"))


def canonical_projection(spark, sf):
    part = f.table(spark, sf, "part").select(
        "p_size", F.col(select.find_column(f.table(spark, sf, "part"), "P_PARTKEY ")).alias("key"), "p_brand"
    )
    return select.conform(part, struct("key bigint, p_brand string, absent double, p_size bigint"))


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Event values and line discounts with holes, in one frame."""
    return f.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"),
        F.nullif(F.col("user_id").cast("double"), F.lit(3.0)).alias("user"),
    )


def mode_bounds(spark, sf):
    out = impute.mode_bounds(_gappy(spark, sf), ["value", "user"])
    return out.select("column", *[f.rounded(c).alias(c) for c in ("mode", "mean", "std", "lo", "hi")])


def mode_impute(spark, sf):
    rows = _gappy(spark, sf)
    out = impute.impute_with_mode(rows, ["value", "user"], impute.mode_bounds(rows, ["value", "user"]))
    return out.select("event_id", f.rounded("value").alias("value"), f.rounded("user").alias("user"))


def impute_across_frames(spark, sf):
    """Bounds from purchases only, applied to every event."""
    kinds = f.table(spark, sf, "events").select("event_id", "event_type")
    stats = impute.mode_bounds(
        _gappy(spark, sf).join(kinds.filter(F.col("event_type") == "click"), "event_id", "left_semi"), ["value"]
    )
    out = impute.impute_with_mode(_gappy(spark, sf), ["value"], stats)
    return out.select("event_id", f.rounded("value").alias("value"))


def mapped_labels(spark, sf):
    o = f.table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("label"))
    return impute.map_labels(o, "label", {"1-URGENT": "TOP", "2-HIGH": "TOP", "3-MEDIUM": "MID"}, "NONE")


def profile_keys(spark, sf):
    e = f.table(spark, sf, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("R")))
    return quality.key_counts(e, ["l_orderkey", "flag"])


def profile_nulls(spark, sf):
    docs = f.table(spark, sf, "documents").join(f.table(spark, sf, "labels"), "doc_id", "left")
    out = quality.null_counts(docs, ["doc_id", "text", "quality", "toxic", "absent"])
    return out.select("column", "nulls", f.rounded("pct").alias("pct"))


def profile_dups(spark, sf):
    return quality.top_duplicates(f.table(spark, sf, "lineitem"), "l_orderkey", 10)


def quality_profile(spark, sf):
    """Key, null and duplicate profile of four tables as one long table."""
    plan = {
        "lineitem": ["l_orderkey", "l_linenumber"],
        "orders": ["o_orderkey"],
        "events": ["user_id"],
        "labels": ["doc_id"],
    }
    parts = [
        quality.profile_table(t, name, keys, t.columns)
        for name, keys in plan.items()
        for t in [f.table(spark, sf, name)]
    ]
    out = select.stack_relaxed(parts)
    return out.select("table", "check", "item", "n", f.rounded("value").alias("value"))


def lineage_counts(spark, sf):
    """Before, after and dropped rows of a keep-first, with the date range that is left."""
    li = f.table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return quality.lineage(
        li, "lineitem", F.col("day") <= F.lit(f.ANCHORS[0]), ["l_orderkey", "l_linenumber"], "day", {"suppliers": "l_suppkey"}
    )


_GAPPY = """gappy AS (SELECT event_id, event_type, CASE WHEN event_id % 13 <> 0 THEN value END AS value, nullif(CAST(user_id AS DOUBLE), 3.0) AS "user" FROM events)"""


def _bounds(c: str, where: str = "TRUE") -> str:
    q = f'"{c}"'
    return f"""SELECT '{c}' AS "column", (SELECT {q} FROM gappy WHERE {q} IS NOT NULL AND {where} GROUP BY {q} ORDER BY count(*) DESC, {q} LIMIT 1) AS mode,
 avg({q}) AS mean, coalesce(stddev_samp({q}), 0) AS std, avg({q}) - 3 * coalesce(stddev_samp({q}), 0) AS lo, avg({q}) + 3 * coalesce(stddev_samp({q}), 0) AS hi
FROM gappy WHERE {where}"""


def _filled(c: str) -> str:
    q = f'g."{c}"'
    return f'round(CASE WHEN {q} IS NULL OR {q} < b_{c}.lo OR {q} > b_{c}.hi THEN b_{c}.mode ELSE {q} END, 6) + 0.0 AS "{c}"'


def _profile_sql(table: str, keys: list[str], columns: list[str]) -> str:
    klist = ", ".join(keys)
    counts = f"(SELECT count(*) AS r, (SELECT count(*) FROM (SELECT DISTINCT {klist} FROM {table})) AS d FROM {table})"
    parts = [
        f"""SELECT '{table}' AS "table", 'keys' AS "check", item, n, CAST(NULL AS DOUBLE) AS value
 FROM (SELECT unnest(['rows', 'distinct_keys', 'duplicates']) AS item, unnest([r, d, r - d]) AS n FROM {counts})"""
    ]
    for c in columns:
        parts.append(
            f"""SELECT '{table}', 'nulls', '{c}', count(*) - count({c}), round((count(*) - count({c})) / count(*) * 100.0, 6) + 0.0 FROM {table}"""
        )
    if len(keys) == 1:
        k = keys[0]
        parts.append(
            f"""SELECT * FROM (SELECT '{table}', 'top_duplicates', CAST({k} AS VARCHAR), count(*), CAST(NULL AS DOUBLE) FROM {table}
 GROUP BY {k} HAVING count(*) > 1 ORDER BY count(*) DESC, {k} LIMIT 10)"""
        )
    return "\nUNION ALL ".join(parts)


_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()
_PROFILE = "\nUNION ALL ".join(
    [
        _profile_sql("lineitem", ["l_orderkey", "l_linenumber"], _LINEITEM),
        _profile_sql(
            "orders", ["o_orderkey"], "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
        ),
        _profile_sql("events", ["user_id"], "event_id ts user_id event_type value props".split()),
        _profile_sql("labels", ["doc_id"], "doc_id quality toxic".split()),
    ]
)

QUERIES = {
    "keep_first_dedup": (
        keep_first_dedup,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice,
 l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    ),
    "latest_record": (
        latest_record,
        """SELECT o_custkey, o_orderkey, since, round(o_totalprice / 100, 6) + 0.0 AS rate
FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS since FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY since DESC NULLS LAST, o_orderkey) = 1""",
    ),
    "any_row_dedup": (
        any_row_dedup,
        "SELECT CAST(ts AS DATE) AS day, event_type, min(value) AS value FROM events GROUP BY ALL",
    ),
    "normalise_ids": (
        normalise_ids,
        r"""SELECT c_custkey, lpad(regexp_replace(c_name, '\D', '', 'g'), 14, '0') AS id14,
 lpad(regexp_replace(c_name || '/' || c_name, '\D', '', 'g'), 14, '0') AS cut14, '00000000000000' AS zeros,
 CAST(NULL AS VARCHAR) AS nothing, lpad(regexp_replace(c_name, '\D', '', 'g'), 14, '0') AS id_or_null FROM customer""",
    ),
    "normalise_text": (
        normalise_text,
        r"SELECT doc_id, lower(trim(regexp_replace(strip_accents(text), '\s+', ' ', 'g'))) AS normal FROM documents",
    ),
    "trimmed_text": (trimmed_text, "SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part"),
    "prefix_filter": (prefix_filter, "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'small')"),
    "equality_filter": (equality_filter, "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "membership": (membership, "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"),
    "point_in_time": (
        point_in_time,
        f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) <= DATE '{f.ANCHORS[0]}'""",
    ),
    "typed_parse": (
        typed_parse,
        """SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 7 > 2 THEN value END AS amount,
 CASE WHEN event_id % 5 <> 0 THEN user_id END AS holders FROM events""",
    ),
    "iso_only": (iso_only, "SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS day FROM events"),
    "canonical_projection": (
        canonical_projection,
        "SELECT p_partkey AS key, p_brand, CAST(NULL AS DOUBLE) AS absent, CAST(p_size AS BIGINT) AS p_size FROM part",
    ),
    "mode_bounds": (
        mode_bounds,
        f"""WITH {_GAPPY} SELECT "column", {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in ('mode', 'mean', 'std', 'lo', 'hi'))}
FROM ({_bounds('value')} UNION ALL {_bounds('user')})""",
    ),
    "mode_impute": (
        mode_impute,
        f"""WITH {_GAPPY} SELECT event_id, {_filled('value')}, {_filled('user')}
FROM gappy g, ({_bounds('value')}) b_value, ({_bounds('user')}) b_user""",
    ),
    "impute_across_frames": (
        impute_across_frames,
        f"""WITH {_GAPPY} SELECT event_id, {_filled('value')} FROM gappy g, ({_bounds('value', "event_type = 'click'")}) b_value""",
    ),
    "mapped_labels": (
        mapped_labels,
        """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'TOP' WHEN '2-HIGH' THEN 'TOP' WHEN '3-MEDIUM' THEN 'MID'
 WHEN '5-LOW' THEN 'NONE' ELSE o_orderpriority END AS label FROM orders""",
    ),
    "profile_keys": (
        profile_keys,
        """SELECT r AS rows, d AS distinct_keys, r - d AS duplicates FROM (SELECT count(*) AS r,
 (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, nullif(l_returnflag, 'R') FROM lineitem)) AS d FROM lineitem)""",
    ),
    "profile_nulls": (
        profile_nulls,
        """WITH j AS (SELECT d.doc_id, text, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)),
c AS (SELECT count(*) AS r, count(doc_id) AS a, count(text) AS b, count(quality) AS q, count(toxic) AS t FROM j)
SELECT "column", nulls, round(nulls / r * 100.0, 6) + 0.0 AS pct FROM (SELECT r, unnest(['doc_id', 'text', 'quality', 'toxic', 'absent']) AS "column",
 unnest([r - a, r - b, r - q, r - t, NULL]) AS nulls FROM c)""",
    ),
    "profile_dups": (
        profile_dups,
        "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, l_orderkey LIMIT 10",
    ),
    "quality_profile": (quality_profile, _PROFILE),
    "lineage_counts": (
        lineage_counts,
        f"""SELECT 'lineitem' AS "table", (SELECT count(*) FROM lineitem) AS rows_read, count(*) AS rows_cut,
 count(DISTINCT (l_orderkey, l_linenumber)) AS rows_kept, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates,
 min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day, count(DISTINCT l_suppkey) AS suppliers
FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '{f.ANCHORS[0]}'""",
    ),
}
