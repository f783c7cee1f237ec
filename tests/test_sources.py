import dataclasses
import hashlib
import io
import json
import zipfile
from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from peerscore import session
from peerscore.operators.select import empty_frame
from peerscore.plans import daily_series
from peerscore.schemas import MANIFEST, QUOTA_SERIES
from peerscore.sources import archives, attributes, delimited, landing, lines, series, tables, zip_members

CURRENT = "TP_FUNDO_CLASSE;CNPJ_FUNDO_CLASSE;ID_SUBCLASSE;DT_COMPTC;VL_TOTAL;VL_QUOTA;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST"
LEGACY = "CNPJ_FUNDO;DT_COMPTC;VL_TOTAL;VL_QUOTA;VL_PATRIM_LIQ;CAPTC_DIA;RESG_DIA;NR_COTST"


def make_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for name, lines in members.items():
            z.writestr(name, "\n".join(lines).encode("latin-1"))
    path.write_bytes(held.getvalue())
    return str(path)


def test_delimited_text_is_tolerant(spark, tmp_path):
    f = tmp_path / "x.csv"
    f.write_bytes('A;B;C\n1;"q;ção\n2;NA;N/A;extra\n3\n'.encode("latin-1"))
    df = delimited.read_delimited(spark, str(f), keep_order=True)
    got = [(r.A, r.B, r.C) for r in df.orderBy(delimited.ORDER_COLUMN).collect()]
    assert got == [("1", '"q', "ção"), ("2", None, None), ("3", None, None)]
    assert [t for _, t in df.dtypes[:3]] == ["string"] * 3


def test_archive_lines_keep_member_and_line_order(spark, tmp_path):
    p = make_zip(tmp_path / "a.zip", {"b.csv": ["H", "é1", "", "2"], "readme.txt": ["no"], "a.CSV": ["H;I", "3;4"], "void.csv": []})
    got = archives.read_archives(spark, p, ["H", "I"]).orderBy("member_no", "line_no").collect()
    assert [(r.member, r.member_no, r.line_no, r.fields, r.H, r.I) for r in got] == [
        ("b.csv", 0, 1, 1, "é1", None), ("b.csv", 0, 3, 1, "2", None), ("a.CSV", 2, 1, 3, "3", "4"),
    ]
    one = archives.read_archives(spark, p, ["I", "Z"], member="a.CSV")
    assert [(r.I, r.Z) for r in one.collect()] == [("4", None)]


def test_archive_lines_may_be_ragged_or_hold_null_tokens(spark, tmp_path):
    p = make_zip(tmp_path / "a.zip", {"a.csv": ["A;B;C", "1;2;3;4", "5", "N/A;;NA", "n/a;x;", ";;;;"]})
    got = archives.read_archives(spark, p, ["C", "A", "B"]).orderBy("line_no").collect()
    assert [(r.A, r.B, r.C) for r in got] == [
        ("1", "2", "3"), ("5", None, None), (None, None, None), ("n/a", "x", None), (None, None, None),
    ]


def test_archive_lines_come_in_blocks(spark, tmp_path):
    n = 300_000  # several blocks, the last line without an end
    p = make_zip(tmp_path / "a.zip", {"a.csv": ["A;B", *[f"{i};some text to fill the line" for i in range(n)]]})
    got = archives.read_archives(spark, p, ["A"]).agg(F.count("*"), F.sum(F.col("A").cast("long")), F.max("line_no"), F.count_distinct("line_no"))
    assert tuple(got.first()) == (n, n * (n - 1) // 2, n, n)


def test_members_are_read_by_tasks_of_their_own(spark, tmp_path):
    members = {f"m{i}.csv": ["A;B", *[f"{i};{n}" for n in range(i)]] for i in range(6)}
    p = make_zip(tmp_path / "a.zip", members)
    df = archives.read_archives(spark, p, ["A", "B"])
    assert df.rdd.getNumPartitions() == 6
    got = df.withColumn("task", F.spark_partition_id()).groupBy("member").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks"))
    assert {r.member: (r.n, r.tasks) for r in got.collect()} == {f"m{i}.csv": (i, 1) for i in range(1, 6)}
    assert archives.read_archives(spark, p, ["A"], member="none.csv").collect() == []
    (tmp_path / "none").mkdir()
    assert archives.read_archives(spark, str(tmp_path / "none"), ["A"]).collect() == []


def test_archives_beyond_two_gigabytes(spark, tmp_path):
    """An archive that stands behind 5 GB of nothing, which takes no room on disk."""
    p = tmp_path / "large.zip"
    with open(p, "wb") as f:
        f.truncate(5 << 30)
    with zipfile.ZipFile(p, "a", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "A;B\n1;2\n")
        z.writestr(zipfile.ZipInfo("b.csv"), "A;B\n3;4\n")  # stored
    got = archives.read_archives(spark, str(p), ["A", "B"]).orderBy("member_no").collect()
    assert [(r.member, r.A, r.B) for r in got] == [("a.csv", "1", "2"), ("b.csv", "3", "4")]


def test_blocks_of_a_member_are_bounded_and_checked(tmp_path):
    p = make_zip(tmp_path / "a.zip", {"a.csv": ["A", "0" * (3 * lines.BLOCK_BYTES), "1"]})
    (member,) = zip_members.members_of(p)
    blocks = list(zip_members.blocks_of(member))
    assert max(map(len, blocks)) <= lines.BLOCK_BYTES and sum(map(len, blocks)) == 3 * lines.BLOCK_BYTES + 4
    with pytest.raises(ValueError, match="checksum"):
        list(zip_members.blocks_of(dataclasses.replace(member, crc=1)))
    with pytest.raises(ValueError, match="no member"):
        list(zip_members.blocks_of(dataclasses.replace(member, offset=1)))


def test_paths_that_ranged_reads_reach():
    assert zip_members.file_system("/a b/c.zip")[1] == "/a b/c.zip" == zip_members.file_system("file:/a b/c.zip")[1] == zip_members.file_system("file:///a b/c.zip")[1]
    assert zip_members.file_system("viewfs://x/a.zip") is None


def test_whole_content_gives_the_same_lines(spark, tmp_path):
    p = make_zip(tmp_path / "a.zip", {"b.csv": ["H;I", "1;2"], "a.CSV": ["I", "3", "", "4"]})
    files = spark.read.format("binaryFile").load(p)
    ranged = archives.read_archives(spark, p, ["H", "I"]).drop("source_priority")
    whole = archives.expand_archives(files, ["H", "I"])
    assert ranged.schema == whole.schema
    assert sorted(map(tuple, ranged.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def _row(*fields):
    return ";".join(fields)


def _series(spark, tmp_path, current=None, legacy=None, as_of=date(2025, 12, 31)):
    lines = None
    for era, members, priority in (("old", legacy, daily_series.LEGACY_PRIORITY), ("new", current, daily_series.CURRENT_PRIORITY)):
        if members:
            part = archives.read_archives(
                spark, make_zip(tmp_path / era / "raw.zip", members), daily_series.RAW_FIELDS, priority=priority
            )
            lines = part if lines is None else lines.unionByName(part)
    return daily_series.quota_series(lines, as_of)


def test_current_era(spark, tmp_path):
    out = _series(spark, tmp_path, {"x.csv": [
        CURRENT,
        _row("FI", "00.123.456/0001-99", "S1", "2024-05-02", "10.5", "1.25", "9", "1", "2", "7"),
        _row("FI", "00.123.456/0001-99", "", "2024-05-02", "bad", "1.5", "9", "1", "2", "7.0"),
    ]})
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in QUOTA_SERIES.fields]
    got = {r.id_subclasse: r for r in out.collect()}
    assert got["S1"].cnpj_fundo_classe == "00123456000199"
    assert (got["S1"].dt_comptc, got["S1"].vl_total, got["S1"].nr_cotst) == (date(2024, 5, 2), 10.5, 7)
    assert (got[None].vl_total, got[None].nr_cotst) == (None, None)


def test_legacy_era_and_headers_in_the_wrong_folder(spark, tmp_path):
    line = _row("1-2", "2020-01-02", "1", "2", "3", "4", "5", "6")
    for where in ({"legacy": {"x.csv": [LEGACY, line]}}, {"current": {"x.csv": [LEGACY, line]}}):
        r = _series(spark, tmp_path / str(len(str(where))), **where).collect()[0]
        assert (r.tp_fundo_classe, r.id_subclasse, r.cnpj_fundo_classe, r.vl_quota, r.nr_cotst) == (None, None, "00000000000012", 2.0, 6)


def test_unknown_header_contributes_nothing(spark, tmp_path):
    assert _series(spark, tmp_path, {"x.csv": ["FOO;BAR", "1;2"]}).count() == 0


def test_first_row_in_source_order_survives(spark, tmp_path):
    new = {"x.csv": [CURRENT, _row("FI", "12", "", "2024-05-02", "", "1.0", "", "", "", ""), _row("FI", "12", "", "2024-05-02", "", "2.0", "", "", "", ""),
                     _row("FI", "12", "", "2024-05-03", "", "3.0", "", "", "", ""), _row("FI", "12", "", "2030-01-01", "", "9.0", "", "", "", "")]}
    out = _series(spark, tmp_path / "a", new)
    assert {(r.dt_comptc.day, r.vl_quota) for r in out.collect()} == {(2, 1.0), (3, 3.0)}
    old = {"x.csv": [LEGACY, _row("12", "2024-05-02", "", "7.0", "", "", "", "")]}
    out = _series(spark, tmp_path / "b", new, old)
    assert {(r.dt_comptc.day, r.vl_quota) for r in out.collect()} == {(2, 7.0), (3, 3.0)}


def test_json_series_lose_repeats(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"data": "01/02/2024", "valor": "0.5"}, {"data": "bad", "valor": "1"}]))
    (tmp_path / "b.json").write_text(json.dumps([{"data": "01/02/2024", "valor": "0.5"}, {"data": "02/02/2024", "valor": "x"}]))
    (tmp_path / "c.json").write_text("[]")
    got = series.read_json_series(spark, str(tmp_path)).orderBy("data").collect()
    assert [tuple(r) for r in got] == [(date(2024, 2, 1), 0.5), (date(2024, 2, 2), None)]


def test_level_drop(rows):
    df = rows("`Índice` string, `Data de Referência` string, `Número Índice` string",
              ("a", "2024-01-02", "10.5"), ("a", None, "1"), ("a", "2024-01-02", "10.5"), ("a", "2024-01-03", "x"))
    assert {tuple(r) for r in series.level_rows(df).collect()} == {(date(2024, 1, 2), 10.5), (date(2024, 1, 3), None)}
    assert series.level_rows(rows("x int", (1,))).count() == 0


DROP = "`CNPJ do Fundo` string, `cnpj_classe` string, `Estrutura` string, `Codigo CVM Subclasse` string, `Tipo ANBIMA` string, `Prazo Pagamento Resgate em dias` string, line int"


def test_attribute_drop(rows):
    df = rows(DROP, ("1", "2", " Classe ", None, "B", "30", 2), ("1", "2", "CLASSE", None, "A", "x", 1), ("1", "3", "Subclasse", " S1 ", "C", "5", 3))
    top = attributes.parent_attributes(df, ["line"]).collect()
    assert [(r.cnpj_classe, r.classificacao_anbima, r.tributacao_alvo, r.prazo_de_resgate) for r in top] == [("00000000000002", "A", None, None)]
    sub = attributes.child_attributes(df, ["line"]).collect()
    assert [(r.codigo_cvm_subclasse, r.classificacao_anbima, r.prazo_de_resgate) for r in sub] == [("S1", "C", 5)]
    assert attributes.parent_attributes(df.drop("cnpj_classe")).count() == 0
    assert attributes.child_attributes(df.drop("Codigo CVM Subclasse")).count() == 0


def test_change_detection(spark, tmp_path):
    def put(where, body):
        p = tmp_path / where
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(body)
        return hashlib.sha256(body).hexdigest()

    same = put("daily/competence=2024-01/raw.zip", b"same")
    put("daily/competence=2024-02/raw.zip", b"new body")
    put("daily/competence=2024-03/raw.zip", b"first time")
    snap = put("registry/raw.zip", b"snap")
    put("registry/_manifest.json", b"{}")
    landed = landing.landed_files(spark, str(tmp_path))
    assert landed.count() == 4

    def known(source, competence, sha):
        return (source, "u", competence, "etag", None, sha, 1, None, datetime(2024, 1, 1), "fetched")

    manifest = spark.createDataFrame(
        [known("daily", "2024-01", same), known("daily", "2024-02", "old"), known("daily", "2023-12", "x"), known("registry", None, snap)],
        MANIFEST,
    )
    expected = spark.createDataFrame([("daily", "2024-01"), ("daily", "2024-04")], "source string, competence string")
    now = datetime(2025, 1, 1)
    got = {(r.source, r.competence): r for r in landing.classify_changes(landed, manifest, now, expected).collect()}
    assert {k: r.status for k, r in got.items()} == {
        ("daily", "2024-01"): "not_modified", ("daily", "2024-02"): "fetched", ("daily", "2024-03"): "fetched",
        ("daily", "2023-12"): "not_found", ("daily", "2024-04"): "not_found", ("registry", None): "not_modified",
    }
    assert {r.ingested_at for r in got.values()} == {now}
    assert got["daily", "2024-01"].etag == "etag" and got["daily", "2024-02"].etag is None
    assert got["daily", "2024-02"].byte_size == 8 and got["daily", "2024-02"].url.endswith("competence=2024-02/raw.zip")
    assert got["daily", "2023-12"].sha256 == "x" and got["daily", "2024-04"].sha256 is None


def test_partitions_need_a_manifest(spark, rows):
    parts = rows("competence string, v int", ("2024-01", 1), ("2024-02", 2))
    manifest = spark.createDataFrame(
        [("daily", "u", "2024-01", None, None, "s", 1, None, None, "fetched"), ("other", "u", "2024-02", None, None, "s", 1, None, None, "fetched")],
        MANIFEST,
    )
    assert [r.v for r in landing.with_manifest(parts, manifest, "daily").collect()] == [1]


def _bounds(rows, start, end):
    return rows("start date, end date", (start, end))


def test_month_spine(rows):
    months = [r.month for r in landing.month_spine(_bounds(rows, date(2023, 11, 30), date(2024, 2, 1))).orderBy("month").collect()]
    assert months == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]
    assert landing.month_spine(_bounds(rows, date(2024, 2, 1), date(2024, 1, 31))).count() == 0


def test_lookback(spark):
    r = landing.lookback_bounds(spark, date(2025, 12, 31), 3).collect()[0]
    assert (r.start, r.end) == (date(2025, 10, 1), date(2025, 12, 1))


@pytest.mark.parametrize(
    "start,end,years,want",
    [
        (date(2000, 1, 1), date(2025, 12, 31), 10, [(date(2000, 1, 1), date(2009, 12, 31)), (date(2010, 1, 1), date(2019, 12, 31)), (date(2020, 1, 1), date(2025, 12, 31))]),
        (date(2024, 1, 1), date(2020, 1, 1), 10, []),
        (date(2024, 5, 5), date(2024, 5, 5), 10, [(date(2024, 5, 5), date(2024, 5, 5))]),
        (date(2000, 2, 29), date(2021, 1, 1), 10, [(date(2000, 2, 29), date(2010, 2, 27)), (date(2010, 2, 28), date(2020, 2, 27)), (date(2020, 2, 28), date(2021, 1, 1))]),
        (date(1996, 2, 29), date(2001, 1, 1), 4, [(date(1996, 2, 29), date(2000, 2, 28)), (date(2000, 2, 29), date(2001, 1, 1))]),
    ],
)
def test_year_windows(rows, start, end, years, want):
    got = landing.year_windows(_bounds(rows, start, end), years).orderBy("window_start").collect()
    assert [tuple(r) for r in got] == want


def test_backfill_years(rows):
    spine = landing.month_spine(_bounds(rows, date(2023, 11, 1), date(2024, 12, 1)))
    landed = spine.filter(~F.col("month").isin(date(2024, 3, 1), date(2024, 7, 1)))
    assert [r.year for r in landing.years_to_backfill(spine, landed).collect()] == [2024]


def test_file_names_resolve(rows):
    files = rows("name string", ("IMAB-HISTORICO.xls",), ("/x/imab5-historico.XLSX",), ("other.xls",))
    expected = rows("stem string, key string", ("imab-historico", "ima_b"), ("imab5-historico", "ima_b_5"), ("irfm-historico", "irf_m"))
    got = {(r.name, r.key, r.state) for r in landing.resolve_keys(files, expected).collect()}
    assert got == {
        ("IMAB-HISTORICO.xls", "ima_b", "resolved"), ("/x/imab5-historico.XLSX", "ima_b_5", "resolved"),
        ("other.xls", None, "unknown"), (None, "irf_m", "missing"),
    }


def test_sink_replaces_one_reference_date(spark, rows, tmp_path):
    one, two = date(2024, 1, 31), date(2024, 2, 29)
    root = str(tmp_path)
    tables.write_table(rows("v int", (1,)), root, "gold", "t", one)
    tables.write_table(rows("v int", (2,)), root, "gold", "t", two)
    tables.write_table(rows("v int", (3,)), root, "gold", "t", two)
    assert [r.v for r in tables.read_table(spark, root, "gold", "t", one).collect()] == [1]
    assert [r.v for r in tables.read_table(spark, root, "gold", "t", two).collect()] == [3]
    assert {(r.v, r.as_of) for r in tables.read_dates(spark, root, "gold", "t").collect()} == {(1, one), (3, two)}
    tables.write_table(rows("v int", (4,)).filter("v > 4"), root, "gold", "t", two)
    assert tables.read_table(spark, root, "gold", "t", two).collect() == []
    with pytest.raises(FileNotFoundError, match="no complete version"):
        tables.read_table(spark, root, "gold", "missing", one)


def test_a_job_lost_in_mid_write_leaves_the_old_rows(spark, rows, tmp_path):
    root, day = str(tmp_path), date(2024, 1, 31)
    read = lambda: sorted(r.v for r in tables.read_table(spark, root, "gold", "t", day).collect())
    tables.write_table(rows("v int", (1,), (2,)), root, "gold", "t", day)
    reading = tables.read_table(spark, root, "gold", "t", day)
    lost = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 70, F.col("id").cast("int")).otherwise(F.raise_error(F.lit("lost"))).alias("v"))
    with pytest.raises(Exception, match="lost"):
        tables.write_table(lost, root, "gold", "t", day)
    assert read() == [1, 2] and len(tables.versions(spark, root, "gold", "t", day)) == 1
    tables.write_table(rows("v int", (3,)), root, "gold", "t", day)
    # Who read before the switch can go on.
    assert read() == [3] and sorted(r.v for r in reading.collect()) == [1, 2]
    for v in (4, 5):
        tables.write_table(rows("v int", (v,)), root, "gold", "t", day)
    assert read() == [5] and len(tables.versions(spark, root, "gold", "t", day)) == tables.KEPT
    left = [p.name for p in (tmp_path / "gold" / "t" / f"as_of={day}").iterdir() if p.name.startswith("v-")]
    assert len(left) == tables.KEPT + 1  # and what the lost job left


def test_sorted_files_skip_row_groups(spark, tmp_path):
    day = date(2024, 1, 31)
    df = spark.range(4000, numPartitions=4).select((F.col("id") * 7919 % 4000).alias("k"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # one file would do for these rows
    try:
        path = tables.write_table(df, str(tmp_path), "silver", "t", day, order=["k"], by_range=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    placed = tables.file_positions(spark.read.parquet(path)).collect()
    assert sorted((r.position, r.k) for r in placed) == [(i + 1, i) for i in range(4000)]
    bounds = [pq.read_metadata(p).row_group(0).column(0).statistics for p in sorted(Path(path).glob("*.parquet"))]
    assert len(bounds) > 1 and all(a.max < b.min for a, b in zip(bounds, bounds[1:]))
    within = tables.write_table(df, str(tmp_path), "silver", "u", day, order=["k"])
    for p in Path(within).glob("*.parquet"):
        keys = pq.read_table(p)["k"].to_pylist()
        assert keys == sorted(keys)


def test_materialised_table_lies_in_the_shared_folder(spark, rows):
    df = session.materialise(rows("v int, w string", (1, "a")), "t")
    assert df.inputFiles()[0].replace("file://", "").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert df.collect() == rows("v int, w string", (1, "a")).collect()


def test_empty_frame_has_its_schema(spark):
    assert empty_frame(spark, MANIFEST).schema == MANIFEST


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A;B\n1;2\n", encoding="latin-1")
    (tmp_path / "b.csv").write_text("B;A\n9;8\n", encoding="latin-1")
    (tmp_path / "c.csv").write_text("B;Ç\n5;6\n", encoding="latin-1")
    got = delimited.read_delimited(spark, str(tmp_path), keep_order=True).orderBy("_source_order")
    assert [(r.A, r.B, r["Ç"]) for r in got.collect()] == [("1", "2", None), ("8", "9", None), (None, "5", "6")]


def test_levels_are_read_strictly(rows):
    names = f"`{series.LEVEL_DATE_COLUMN}` string, `{series.LEVEL_VALUE_COLUMN}` string"
    df = rows(names, ("2024-01-02", "1.5"), ("2024", "1"), (" 2024-01-03", "1"), ("2024-01-04", "1d"), ("2024-01-05", " 2"))
    got = {str(r.data): r.valor for r in series.level_rows(df).collect()}
    assert got == {"2024-01-02": 1.5, "2024-01-04": None, "2024-01-05": None}
