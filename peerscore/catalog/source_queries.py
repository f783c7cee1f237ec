"""Scans, sinks and landing-zone bookkeeping over data derived from the tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from datetime import date, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts
from ..plans import daily_series, series_store
from ..schemas import MANIFEST, QUOTA_SERIES
from ..session import scratch_path
from ..sources import archives, delimited, landing, series, tables, zip_members
from . import frames as f

_ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _orders_as_text(spark: SparkSession, sf: str) -> DataFrame:
    return f.table(spark, sf, "orders").select(
        *[F.col(c).cast("string").alias(c) for c in _ORDER_FIELDS if c != "o_orderdate"],
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
    )


def _orders_typed(df: DataFrame) -> DataFrame:
    return df.select(
        casts.to_long(F.col("o_orderkey")).alias("o_orderkey"),
        casts.to_long(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        casts.to_double(F.col("o_totalprice")).alias("o_totalprice"),
        casts.iso_date(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority",
    )


def _zipped(root: str | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """One archive per batch of rows, with four data members and one to be skipped, below ``root`` or as content."""

    def zip_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = list(batch.columns)
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.txt", "not data")
                for n in range(4):
                    columns = names[::-1] if n % 2 else names
                    lines = [";".join(columns), *[";".join(r) for r in batch.iloc[n::4][columns].itertuples(index=False)]]
                    archive.writestr(f"part{n}.CSV" if n % 2 else f"part{n}.csv", "\r\n".join(lines).encode("latin-1"))
            path = f"{root or ''}/orders-{batch.iloc[0, 0]}.zip"
            content = held.getvalue()
            if root:
                system, name = zip_members.file_system(path)
                with system.open_output_stream(name) as out:
                    out.write(content)
                content = b""
            yield pd.DataFrame({"path": [path], "content": [content]})

    return zip_batches


def archive_expand(spark, sf):
    """Orders packed into archives by the executors, then read member by member and typed again."""
    root = scratch_path(spark, "archives")
    reached = zip_members.file_system(root)
    zips = _orders_as_text(spark, sf).mapInPandas(_zipped(root if reached else None), "path string, content binary")
    if reached is None:
        return _orders_typed(archives.expand_archives(zips, _ORDER_FIELDS))
    reached[0].create_dir(reached[1])
    zips.write.format("noop").mode("overwrite").save()
    return _orders_typed(archives.read_archives(spark, root, _ORDER_FIELDS))


def delimited_scan(spark, sf):
    path = scratch_path(spark, "delimited")
    rows = _orders_as_text(spark, sf).withColumn("o_clerk", F.concat(F.lit("São Tomé "), F.col("o_custkey")))
    rows = rows.withColumn("missing", F.lit("N/A"))
    # Two kinds of files with the columns in opposite orders.
    for n, names in enumerate((rows.columns, rows.columns[::-1])):
        rows.filter(F.col("o_orderkey").cast("bigint") % 2 == n).select(*names).write.mode("append").option("sep", ";").option(
            "header", True
        ).option("encoding", delimited.ENCODING).option("quote", "").csv(path)
    back = delimited.read_delimited(spark, path)
    return _orders_typed(back.withColumn("o_orderpriority", F.struct("o_orderpriority", "o_clerk", "missing"))).select(
        *_ORDER_FIELDS[:-1], "o_orderpriority.*"
    )


_LEGACY_HEADER = ["CNPJ_FUNDO", "DT_COMPTC", "VL_QUOTA", "VL_PATRIM_LIQ", "RESG_DIA"]
_CURRENT_HEADER = [
    "TP_FUNDO_CLASSE", "CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_TOTAL", "VL_QUOTA", "VL_PATRIM_LIQ", "CAPTC_DIA", "NR_COTST",
]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as raw archive lines of two eras; every third order is legacy."""
    li = f.table(spark, sf, "lineitem")
    legacy = F.col("l_orderkey") % 3 == 0
    key, price = F.col("l_suppkey").cast("string"), F.col("l_extendedprice").cast("string")
    discount = F.when(F.col("l_discount") != 0, F.col("l_discount").cast("string"))
    raw = {
        "TP_FUNDO_CLASSE": F.when(~legacy, "FI"),
        "CNPJ_FUNDO_CLASSE": F.when(~legacy, F.concat(F.lit("00.CN-"), key)),
        "CNPJ_FUNDO": F.when(legacy, F.concat(F.lit("00.CN-"), key)),
        "ID_SUBCLASSE": F.when(~legacy & (F.col("l_suppkey") % 2 == 1), F.concat(F.lit("S"), key)),
        "DT_COMPTC": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "VL_TOTAL": F.when(~legacy, price),
        "VL_QUOTA": F.col("l_quantity").cast("string"),
        "VL_PATRIM_LIQ": price,
        "CAPTC_DIA": F.when(~legacy, discount),
        "RESG_DIA": F.when(legacy, discount),
        "NR_COTST": F.when(~legacy, F.when(F.col("l_linenumber") == 7, "7.0").otherwise(F.col("l_linenumber").cast("string"))),
    }
    return li.select(
        F.when(legacy, daily_series.LEGACY_PRIORITY).otherwise(daily_series.CURRENT_PRIORITY).alias("source_priority"),
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("path"),
        F.col("l_linenumber").alias("member_no"),
        (F.col("l_partkey") * 100 + F.col("l_quantity")).cast("bigint").alias("line_no"),
        F.when(legacy, archives.field_mask(_LEGACY_HEADER, daily_series.RAW_FIELDS))
        .otherwise(archives.field_mask(_CURRENT_HEADER, daily_series.RAW_FIELDS))
        .cast("bigint")
        .alias("fields"),
        *[raw[name].alias(name) for name in daily_series.RAW_FIELDS],
    )


def schema_unify(spark, sf):
    return daily_series.unify_eras(_lines(spark, sf)).select(*QUOTA_SERIES.fieldNames())


def canonical_series(spark, sf):
    return daily_series.quota_series(_lines(spark, sf), f.AS_OF)


def series_update(spark, sf):
    """The series built from archives of which a year's had errors, then brought up to date by their corrections."""
    root = scratch_path(spark, "series-store")
    lines = _lines(spark, sf)
    month, order = F.substring("DT_COMPTC", 1, 7), F.col("path").cast("int")
    lines = lines.withColumn("line_no", F.col("member_no").cast("bigint")).withColumn("member_no", order)
    lines = lines.withColumn("path", F.concat_ws("-", "source_priority", month))
    wrong = F.col("path").contains("-1995-")

    def now(paths):
        return lines.filter(F.col("path").isin(list(paths)))

    def before(paths):
        return now(paths).filter(~wrong | (F.col("member_no") % 3 > 0)).withColumn("VL_QUOTA", F.when(wrong, "1").otherwise(F.col("VL_QUOTA")))

    paths = [r["path"] for r in lines.select("path").distinct().orderBy("path").collect()]
    series_store.build(spark, root, before, paths, f.AS_OF)
    series_store.update(spark, root, now, [p for p in paths if "-1995-" in p], f.AS_OF)
    return series_store.read_series(spark, root).drop("month")


def source_priority(spark, sf):
    """How many surviving rows each era contributes."""
    out = daily_series.quota_series(_lines(spark, sf), f.AS_OF)
    return out.groupBy(F.coalesce("tp_fundo_classe", F.lit("legacy")).alias("era")).agg(F.count("*").alias("rows"))


def json_series(spark, sf):
    """Event counters as JSON record arrays, one value per user and date."""
    value = F.get_json_object("props", "$.k")
    raw = f.table(spark, sf, "events").select(
        "user_id",
        "event_id",
        F.concat(
            F.lit('[{"data":"'), F.date_format("ts", "dd/MM/yyyy"), F.lit('","valor":"'), value, F.lit('"},{"data":"n/d","valor":"1"}]')
        ).alias("records"),
    )
    return series.parse_rate_records(series.explode_record_arrays(raw, "records"), keys=["user_id"], order=["event_id"])


def level_drop_scan(spark, sf):
    drop = f.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("Índice"),
        # Some rows hold what is no date or no number for the publisher, but is for a lenient cast.
        F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "yyyy"))
        .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias(series.LEVEL_DATE_COLUMN),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.col("o_totalprice").cast("string"), F.lit("d")))
        .when(F.col("o_orderkey") % 7 == 1, F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias(series.LEVEL_VALUE_COLUMN),
    )
    return series.level_rows(drop)


def _order_months(spark: SparkSession, sf: str) -> DataFrame:
    return f.table(spark, sf, "orders").select("*", F.trunc("o_orderdate", "month").alias("month"))


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return f.table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(day).alias("start"), F.max(day).alias("end"))


def month_spine(spark, sf):
    return landing.month_spine(_spans(spark, sf))


def year_windows(spark, sf):
    return landing.year_windows(_spans(spark, sf), 2)


def coverage_gaps(spark, sf):
    """Years of the order calendar in which a month lacks large urgent orders."""
    whole = _spans(spark, sf).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    landed = _order_months(spark, sf).filter((F.month("o_orderdate") % 5 != 0) | (F.year("o_orderdate") % 2 == 0)).select("month").distinct()
    return landing.years_to_backfill(landing.month_spine(whole), landed)


def key_resolution(spark, sf):
    files = f.table(spark, sf, "part").select(
        F.concat(F.lit("/drops/"), F.upper("p_name"), F.lit("."), F.col("p_partkey").cast("string"), F.lit(".XLS")).alias("name")
    )
    expected = f.table(spark, sf, "part").filter(F.col("p_partkey") % 3 == 0).select(
        F.concat(F.lower("p_name"), F.lit("."), (F.col("p_partkey") * 2).cast("string")).alias("stem"),
        F.col("p_brand").alias("key"),
    )
    return landing.resolve_keys(files, expected)


def _landed_months(spark: SparkSession, sf: str) -> DataFrame:
    """One "file" per order month; its hash is over the rows of the month."""
    return (
        _order_months(spark, sf)
        .groupBy("month")
        .agg(F.bit_xor(F.xxhash64(*_ORDER_FIELDS)).alias("digest"), F.count("*").alias("byte_size"))
        .select(
            F.lit("orders").alias("source"),
            F.date_format("month", "yyyy-MM").alias("competence"),
            F.concat(F.lit("orders/"), F.date_format("month", "yyyy-MM")).alias("path"),
            F.sha2(F.col("digest").cast("string"), 256).alias("sha256"),
            "byte_size",
        )
    )


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Yesterday's manifest: some months unknown, some changed, some that have since vanished."""
    month = F.substring("competence", 6, 2).cast("int")
    seen = _landed_months(spark, sf).withColumn("month", month)
    known = seen.filter(F.col("month") % 5 != 0).withColumn(
        "sha256", F.when(F.col("month") % 3 == 0, F.sha2(F.col("sha256"), 256)).otherwise(F.col("sha256"))
    )
    gone = seen.filter(F.col("month") == 7).withColumn("competence", F.concat(F.lit("old-"), F.col("competence")))
    null_text = F.lit(None).cast("string")
    return known.unionByName(gone).select(
        "source",
        F.col("path").alias("url"),
        "competence",
        null_text.alias("etag"),
        null_text.alias("last_modified"),
        "sha256",
        "byte_size",
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(datetime(2001, 1, 1)).cast("timestamp").alias("ingested_at"),
        F.lit("fetched").alias("status"),
    ).select(*MANIFEST.fieldNames())


def file_changes(spark, sf):
    out = landing.classify_changes(_landed_months(spark, sf), _manifest(spark, sf), datetime(2001, 1, 2))
    return out.select("source", "competence", "url", "byte_size", F.col("ingested_at").cast("date").alias("day"), "status")


def manifest_semi(spark, sf):
    parts = _order_months(spark, sf).withColumn("competence", F.date_format("month", "yyyy-MM"))
    return landing.with_manifest(parts, _manifest(spark, sf), "orders").select("o_orderkey", "competence")


def partitioned_sink(spark, sf):
    """Two reference dates written, one of them replaced, both read back."""
    root = scratch_path(spark, "sink")
    orders = f.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first, second = date(2001, 1, 31), date(2001, 2, 28)
    tables.write_table(orders, root, "silver", "orders", first)
    tables.write_table(orders, root, "silver", "orders", second)
    tables.write_table(orders.filter(F.col("o_orderstatus") == "F"), root, "silver", "orders", second)
    return tables.read_dates(spark, root, "silver", "orders").withColumn("as_of", F.col("as_of").cast("date"))


def sorted_sink(spark, sf):
    """Line items published in the order of their dates, read back with their places in the files."""
    root, day = scratch_path(spark, "sink"), date(2001, 1, 31)
    lines = f.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_orderkey", "l_linenumber")
    tables.write_table(lines, root, "silver", "lines", day, order=["day", "l_orderkey", "l_linenumber"], by_range=True)
    return tables.file_positions(tables.read_table(spark, root, "silver", "lines", day))


_LINE_SQL = """u AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE 'FI' END AS tp_fundo_classe,
 lpad('00' || CAST(l_suppkey AS VARCHAR), 14, '0') AS cnpj_fundo_classe,
 CASE WHEN l_orderkey % 3 <> 0 AND l_suppkey % 2 = 1 THEN 'S' || CAST(l_suppkey AS VARCHAR) END AS id_subclasse,
 CAST(l_shipdate AS DATE) AS dt_comptc, CASE WHEN l_orderkey % 3 <> 0 THEN l_extendedprice END AS vl_total,
 l_quantity AS vl_quota, l_extendedprice AS vl_patrim_liq,
 CASE WHEN l_orderkey % 3 <> 0 AND l_discount <> 0 THEN l_discount END AS captc_dia,
 CASE WHEN l_orderkey % 3 = 0 AND l_discount <> 0 THEN l_discount END AS resg_dia,
 CASE WHEN l_orderkey % 3 <> 0 AND l_linenumber <> 7 THEN CAST(l_linenumber AS BIGINT) END AS nr_cotst,
 CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE 1 END AS pr, l_orderkey, l_linenumber, l_partkey * 100 + l_quantity AS ln FROM lineitem)"""
_SERIES_COLS = ", ".join(QUOTA_SERIES.fieldNames())
_KEPT_SQL = f"""WITH {_LINE_SQL}, kept AS (SELECT * FROM u WHERE dt_comptc <= DATE '{f.AS_OF}'
 QUALIFY row_number() OVER (PARTITION BY cnpj_fundo_classe, id_subclasse, dt_comptc ORDER BY pr, l_orderkey, l_linenumber, ln) = 1)"""
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority"
_SPANS_SQL = "spans AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY 1)"

QUERIES = {
    "archive_expand": (archive_expand, f"{_ORDERS_SQL} FROM orders"),
    "delimited_scan": (
        delimited_scan,
        f"{_ORDERS_SQL}, 'São Tomé ' || CAST(o_custkey AS VARCHAR) AS o_clerk, CAST(NULL AS VARCHAR) AS missing FROM orders",
    ),
    "schema_unify": (schema_unify, f"WITH {_LINE_SQL} SELECT {_SERIES_COLS} FROM u"),
    "canonical_series": (canonical_series, f"{_KEPT_SQL} SELECT {_SERIES_COLS} FROM kept"),
    "series_update": (series_update, f"{_KEPT_SQL} SELECT {_SERIES_COLS} FROM kept"),
    "source_priority": (
        source_priority,
        f"{_KEPT_SQL} SELECT coalesce(tp_fundo_classe, 'legacy') AS era, count(*) AS rows FROM kept GROUP BY 1",
    ),
    "json_series": (
        json_series,
        """SELECT user_id, CAST(ts AS DATE) AS data, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS valor FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) = 1""",
    ),
    "level_drop_scan": (
        level_drop_scan,
        """SELECT CAST(o_orderdate AS DATE) AS data, CASE WHEN count(*) FILTER (o_orderkey % 7 <= 1) = 0 THEN min(o_totalprice) END AS valor
FROM orders WHERE o_orderkey % 5 > 1 GROUP BY 1""",
    ),
    "month_spine": (
        month_spine,
        f"""WITH {_SPANS_SQL} SELECT o_custkey, CAST(m AS DATE) AS month FROM (SELECT o_custkey,
 unnest(generate_series(date_trunc('month', a)::TIMESTAMP, date_trunc('month', b)::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM spans)""",
    ),
    "year_windows": (
        year_windows,
        f"""WITH {_SPANS_SQL}, k AS (SELECT *, unnest(range(0, 10)) AS k FROM spans),
s AS (SELECT o_custkey, b, CASE WHEN k >= 1 AND month(a) = 2 AND day(a) = 29 THEN make_date(year(a) + 2 * k, 2, 28) ELSE CAST(a + to_years(CAST(2 * k AS INTEGER)) AS DATE) END AS s,
 CASE WHEN month(a) = 2 AND day(a) = 29 THEN make_date(year(a) + 2 * k + 2, 2, 28) ELSE CAST(a + to_years(CAST(2 * k + 2 AS INTEGER)) AS DATE) END AS n FROM k)
SELECT o_custkey, s AS window_start, CAST(least(n - 1, b) AS DATE) AS window_end FROM s WHERE s <= b""",
    ),
    "coverage_gaps": (
        coverage_gaps,
        """SELECT DISTINCT CAST(year(m) AS INTEGER) AS year FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)
WHERE m NOT IN (SELECT date_trunc('month', o_orderdate) FROM orders WHERE month(o_orderdate) % 5 <> 0 OR year(o_orderdate) % 2 = 0)""",
    ),
    "key_resolution": (
        key_resolution,
        """SELECT name, coalesce(a.stem, b.stem) AS stem, key, CASE WHEN name IS NULL THEN 'missing' WHEN key IS NULL THEN 'unknown' ELSE 'resolved' END AS state
FROM (SELECT '/drops/' || upper(p_name) || '.' || CAST(p_partkey AS VARCHAR) || '.XLS' AS name, lower(p_name) || '.' || CAST(p_partkey AS VARCHAR) AS stem FROM part) a
FULL JOIN (SELECT lower(p_name) || '.' || CAST(p_partkey * 2 AS VARCHAR) AS stem, p_brand AS key FROM part WHERE p_partkey % 3 = 0) b ON a.stem = b.stem""",
    ),
    "file_changes": (
        file_changes,
        """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS c, any_value(month(o_orderdate)) AS mm, count(*) AS n FROM orders GROUP BY 1)
SELECT 'orders' AS source, c AS competence, 'orders/' || c AS url, n AS byte_size, DATE '2001-01-02' AS day,
 CASE WHEN mm % 5 = 0 OR mm % 3 = 0 THEN 'fetched' ELSE 'not_modified' END AS status FROM m
UNION ALL SELECT 'orders', 'old-' || c, 'orders/' || c, n, DATE '2001-01-02', 'not_found' FROM m WHERE mm = 7""",
    ),
    "manifest_semi": (
        manifest_semi,
        "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS competence FROM orders WHERE month(o_orderdate) % 5 <> 0",
    ),
    "partitioned_sink": (
        partitioned_sink,
        """SELECT o_orderkey, o_orderstatus, o_totalprice, DATE '2001-01-31' AS as_of FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, DATE '2001-02-28' FROM orders WHERE o_orderstatus = 'F'""",
    ),
    "sorted_sink": (
        sorted_sink,
        """SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber,
 row_number() OVER (ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber) AS position FROM lineitem""",
    ),
}
