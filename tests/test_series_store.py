"""The series store after corrections against a full build."""

from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from peerscore.operators.select import empty_frame
from peerscore.plans import daily_series, series_store
from peerscore.schemas import MANIFEST
from peerscore.sources import landing
from peerscore.sources.lines import field_mask

AS_OF = date(2024, 12, 31)
HEADER = ["CNPJ_FUNDO_CLASSE", "DT_COMPTC", "VL_QUOTA"]


def _lines(spark, archives):
    """``archive -> rows of (entity, day, quota)`` as lines of the current era."""
    rows = [(1, path, 0, n, field_mask(HEADER, daily_series.RAW_FIELDS), e, d, q) for path, held in archives.items() for n, (e, d, q) in enumerate(held)]
    df = spark.createDataFrame(rows, "source_priority int, path string, member_no int, line_no long, fields long, CNPJ_FUNDO_CLASSE string, DT_COMPTC string, VL_QUOTA string")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in daily_series.RAW_FIELDS if c not in HEADER])


def _reader(spark, archives):
    return lambda paths: _lines(spark, {p: archives[p] for p in paths})


def _rows(df):
    return sorted((r.cnpj_fundo_classe, r.dt_comptc, r.vl_quota) for r in df.collect())


def _files(root):
    found = Path(series_store.series_path(str(root)))
    return {d.name: sorted(p.name for p in d.glob("*.parquet")) for d in found.glob("month=*")}


def test_a_correction_rewrites_its_months_only(spark, tmp_path):
    root = str(tmp_path)
    archives = {
        "a": [("1", "2024-01-02", "1"), ("1", "2024-01-03", "2"), ("2", "2024-02-01", "3")],
        "b": [("1", "2024-02-05", "4"), ("2", "2024-02-01", "99")],  # loses to "a"
        "c": [("1", "2024-03-01", "5"), ("1", "2024-04-01", "6")],
    }
    series_store.build(spark, root, _reader(spark, archives), sorted(archives), AS_OF)
    whole = lambda: _rows(daily_series.quota_series(_lines(spark, archives), AS_OF))
    read = lambda: _rows(series_store.read_series(spark, root))
    assert read() == whole()
    before = _files(tmp_path)
    # A late correction: a line of January changes, that of February goes, so another archive's wins.
    archives["a"] = [("1", "2024-01-02", "10"), ("1", "2024-01-03", "2")]
    months = series_store.update(spark, root, _reader(spark, archives), ["a"], AS_OF)
    after = _files(tmp_path)
    assert months == [date(2024, 1, 1), date(2024, 2, 1)] and read() == whole()
    assert {m for m in before if before[m] != after[m]} == {"month=2024-01-01", "month=2024-02-01"}
    # A month without lines goes, a new one comes.
    archives["c"] = [("1", "2024-03-01", "5"), ("3", "2024-05-01", "7"), ("3", "2025-01-01", "8")]
    assert series_store.update(spark, root, _reader(spark, archives), ["c"], AS_OF) == [date(2024, m, 1) for m in (3, 4, 5)]
    assert read() == whole() and "month=2024-04-01" not in _files(tmp_path)
    del archives["b"]
    assert series_store.update(spark, root, _reader(spark, archives), [], AS_OF, removed=["b"]) == [date(2024, 2, 1)]
    assert read() == whole()
    assert series_store.update(spark, root, _reader(spark, archives), [], AS_OF) == []


def test_changed_archives_follow_the_manifest(spark):
    landed = lambda **sha: spark.createDataFrame([("daily", k, s, 1, f"/{k}.zip") for k, s in sha.items()], "source string, competence string, sha256 string, byte_size long, path string")
    first = landing.classify_changes(landed(m1="x", m2="y"), empty_frame(spark, MANIFEST), datetime(2024, 1, 1))
    assert series_store.changed_archives(first, ["daily"]) == ["/m1.zip", "/m2.zip"]
    second = landing.classify_changes(landed(m1="x", m2="z"), first, datetime(2024, 1, 2))
    assert series_store.changed_archives(second, ["daily"]) == ["/m2.zip"] and series_store.changed_archives(second, ["other"]) == []
