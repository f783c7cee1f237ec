"""The whole job for one reference date: landed files to published tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import StepCounts
from ..operators.select import empty_frame
from ..schemas import CHILD_ATTRIBUTES, FUND_METRICS, PARENT_ATTRIBUTES, SERIES_ROWS
from ..session import discard, materialise
from ..sources.archives import read_archives
from ..sources.attributes import child_attributes, parent_attributes
from ..sources.delimited import ORDER_COLUMN
from ..sources.tables import read_table, write_table
from .daily_series import CURRENT_PRIORITY, LEGACY_PRIORITY, RAW_FIELDS, quota_series, quota_series_of
from .dimensions import class_dimension, fee_and_benchmark_lookups, fixed_income, subclass_dimension, treated
from .entity_series import TABLE, read_entity_series, write_entity_series
from .fund_metrics import fund_metrics
from .landing_zone import DAILY, LINE_COLUMN, MEMBERS, Zone, daily_archives, level_series, member, products, rate_series
from .quality_report import quality_report
from .reference_series import index_series, missing_essentials
from .settings import PROFILES, REFERENCE_COLUMNS, SCORING, SERIES_LOOKBACK_MONTHS
from .top_list import displayed, top_list
from .validation import calendar_year_return


@dataclass(frozen=True)
class Landed:
    """What the landing zone holds, as raw frames.

    Registry and history frames are text columns by header name.  ``order``
    names the columns that give their source order.
    """

    classes: DataFrame
    funds: DataFrame
    subclasses: DataFrame
    current_archives: str | list[str]
    legacy_archives: str | list[str] | None = None
    admin_fees: DataFrame | None = None
    performance_fees: DataFrame | None = None
    benchmarks: DataFrame | None = None
    parent_attributes: DataFrame | None = None
    child_attributes: DataFrame | None = None
    reference: dict[str, DataFrame] = field(default_factory=dict)
    order: tuple[str, ...] = ()


def landed_at(zone: Zone, as_of: date, months: int = SERIES_LOOKBACK_MONTHS) -> Landed:
    """What a run reads of a landing zone: only payloads its manifest knows."""
    drop = products(zone)
    monthly, yearly = daily_archives(zone, as_of, months)
    if not monthly:
        raise RuntimeError(f"no monthly archive of {DAILY} has landed up to {as_of}")
    return Landed(
        **{name: member(zone, name) for name in MEMBERS},
        current_archives=monthly,
        legacy_archives=yearly or None,
        parent_attributes=None if drop is None else parent_attributes(drop, [ORDER_COLUMN]),
        child_attributes=None if drop is None else child_attributes(drop, [ORDER_COLUMN]).drop(ORDER_COLUMN),
        reference=rate_series(zone) | level_series(zone),
        order=(LINE_COLUMN,),
    )


def run_zone(spark: SparkSession, root: str, manifest: DataFrame, out: str, as_of: date) -> dict[str, str]:
    """:func:`run` on what has landed below ``root`` according to ``manifest``."""
    return run(spark, landed_at(Zone(spark, root, manifest), as_of), out, as_of)


def daily_lines(spark: SparkSession, landed: Landed) -> DataFrame:
    lines = read_archives(spark, landed.current_archives, RAW_FIELDS, priority=CURRENT_PRIORITY)
    if landed.legacy_archives:
        lines = read_archives(spark, landed.legacy_archives, RAW_FIELDS, priority=LEGACY_PRIORITY).unionByName(lines)
    return lines


def run(spark: SparkSession, landed: Landed, out: str, as_of: date) -> dict[str, str]:
    """Build and publish every table of ``as_of``; returns table name -> path.

    Each published table is written once and read back by its consumers.
    """
    paths: dict[str, str] = {}
    steps = StepCounts()

    def publish(layer: str, name: str, df: DataFrame) -> DataFrame:
        # Series are sorted by date; the wide one is small enough to be dealt by it, too.
        by_date = {"index_series": ["data"], "quota_series": ["dt_comptc"], "quota_series_fixed_income": ["dt_comptc"]}
        paths[name] = write_table(df, out, layer, name, as_of, order=by_date.get(name, ()), by_range=name == "index_series")
        return read_table(spark, out, layer, name, as_of)

    pieces = {c: landed.reference.get(c, empty_frame(spark, SERIES_ROWS)) for c in REFERENCE_COLUMNS}
    absent = [r.code for r in missing_essentials(pieces).collect()]
    if absent:
        raise RuntimeError(f"essential reference series without rows: {absent}")

    parent_attrs = landed.parent_attributes
    if parent_attrs is None:
        parent_attrs = empty_frame(spark, PARENT_ATTRIBUTES)
    child_attrs = landed.child_attributes
    if child_attrs is None:
        child_attrs = empty_frame(spark, CHILD_ATTRIBUTES)
    lookups = fee_and_benchmark_lookups(
        spark, landed.admin_fees, landed.performance_fees, landed.benchmarks, landed.order
    )
    cls = publish(
        "silver",
        "class_funds",
        class_dimension(landed.classes, landed.funds, landed.subclasses, parent_attrs, lookups, landed.order, steps.of("class_funds")),
    )
    sub = publish(
        "silver",
        "subclass_funds",
        subclass_dimension(landed.subclasses, landed.classes, landed.funds, child_attrs, lookups, landed.order, steps.of("subclass_funds")),
    )
    def derive(layer: str, name: str, build: Callable[..., DataFrame], *args: object, **more: object) -> DataFrame:
        return publish(layer, name, build(*args, **more, watch=steps.of(name)))

    cls_fi = derive("silver", "class_funds_fixed_income", fixed_income, cls)
    sub_fi = derive("silver", "subclass_funds_fixed_income", fixed_income, sub)
    cls_t = derive("silver", "class_funds_fixed_income_treated", treated, cls_fi)
    sub_t = derive("silver", "subclass_funds_fixed_income_treated", treated, sub_fi, stats_from=cls_fi)
    series = derive("silver", "quota_series", quota_series, daily_lines(spark, landed), as_of)
    series_fi = derive("silver", "quota_series_fixed_income", quota_series_of, series, cls_fi, sub_fi)
    # Scores and anchors read the listed entities' series, exchanged once for both.
    paths[TABLE] = write_entity_series(series_fi, out, as_of)
    by_entity = read_entity_series(spark, out, as_of)
    reference = derive("silver", "index_series", index_series, pieces, as_of)

    stored: list[DataFrame] = []

    def store(df: DataFrame) -> DataFrame:
        stored.append(materialise(df, "entity_metrics"))
        return stored[-1]

    scored = fund_metrics(cls_t, sub_t, by_entity, reference, as_of, store=store)
    counted = steps.of("fund_metrics")(scored, "entities", scored=F.count("score"))
    metrics = publish("gold", "fund_metrics", counted.select(*FUND_METRICS.fieldNames()))
    for df in stored:
        discard(df)
    check = publish("gold", "validacao", steps.of("validacao")(calendar_year_return(cls_t, sub_t, by_entity, as_of.year), "entities"))
    publish("gold", "top_list", steps.of("top_list")(displayed(top_list(metrics, cls_t, sub_t, PROFILES, SCORING.top_n)), "ranked"))
    publish(
        "gold",
        "data_quality",
        quality_report(
            {
                "class_funds": cls,
                "subclass_funds": sub,
                "class_funds_fixed_income": cls_fi,
                "subclass_funds_fixed_income": sub_fi,
                "class_funds_fixed_income_treated": cls_t,
                "subclass_funds_fixed_income_treated": sub_t,
                "quota_series_fixed_income": series_fi,
                "validacao": check,
                "index_series": reference,
                "fund_metrics": metrics,
            }
        ).unionByName(steps.report(spark)),
    )
    return paths
