"""Mixing sources to target weights with a curriculum that changes over time.

Every source has a weight schedule over training time 0..1, linear between
knots.  Its integral says how much of the source's target is due by a time; the
inverse of that cumulative demand gives every taken document its training
position, and documents are range-sorted by position.  Built from DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, discard, materialise, running_total

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words the mix takes, as a share of all words.
SHARE = 1.5
#: A source is taken this many times over at most.
PASSES = 2
#: Stretches a source's documents are cut into, to find where a prefix ends.
STRETCHES = 4096
#: Rounds of the SQL twin: a remainder halves with each.
_SQL_ROUNDS = 40
_END = (1 << 63) - 1
#: Relative weight over training time by place in the repeating order: heavy
#: sources come early, light ones late, the middle ones evenly.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 0.2), (0.7, 1.0), (1.0, 2.6)),
    ((0.0, 1.0), (1.0, 1.0)),
)


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``(source, source_size, place, target)`` from ``(source, source_size)``, one row per source.

    Sources are numbered by code point, null last.  A target stops at
    ``passes`` times its source's size; what is over is shared again by weight
    among the others until none is above.  That ends at a level ``x`` with
    target = min(cap, weight * x), so with sources in the order of cap / weight
    the capped ones come first, and running sums find how many they are.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("place"))
    rows = (
        sources.withColumn("place", F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int"))
        .withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * float(passes))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    every = Window.partitionBy()
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every) * share
    rows = rows.withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0))).withColumn(
        "_open", F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("_level", (total - F.col("_capped")) / F.col("_open"))
    # The level is that of the first source it does not fill; if it fills all, all are capped.
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(every).getField("_level")
    return rows.select(
        "source",
        "source_size",
        "place",
        F.least("_cap", F.coalesce(F.col("_weight") * level, F.col("_cap"))).alias("target"),
    )


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_source``, ``_size`` (words; null text: 0) and ``_uid``, which tells rows apart."""
    return docs.select(
        "*",
        F.col("source").cast("string").alias("_source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
        F.monotonically_increasing_id().alias("_uid"),
    )


def _is_taken() -> Column:
    """Whether a round of :func:`_round` took the document: not above the round's limit, and before its cut."""
    return F.exists("_rounds", lambda r: (F.col("_size") <= r["limit"]) & (F.col("_before") < r["cut"]))


def _round(stood: DataFrame, state: DataFrame, first: bool) -> DataFrame:
    """``state`` after one more round: of the open documents up to a limit, the longest prefix that fits the gap is taken.

    The limit is the gap at first, so larger documents step aside, and half of
    it afterwards.  Then a document that ends the prefix leaves less than half
    of the gap, or no document up to the limit is left.  ``_moved`` says whether
    the round took anything.  The cut is searched among totals of stretches,
    then inside the one where it lies.
    """
    limit = F.col("_gap") if first else F.col("_gap") / 2
    known = state.withColumn("_limit", limit)
    open_ = stood.join(known, F.col("_place_of") == F.col("_of")).filter((F.col("_size") > 0) & (F.col("_size") <= F.col("_limit")) & ~_is_taken())
    up_to = Window.partitionBy("_of").rowsBetween(Window.unboundedPreceding, 0)
    over = F.col("_run") > F.col("_gap")
    stretches = open_.groupBy("_of", "_gap", "_stretch").agg(F.sum("_size").alias("_n"))
    summed = stretches.withColumn("_run", F.sum("_n").over(up_to.orderBy("_stretch")))
    ends = materialise(
        summed.groupBy("_of").agg(F.min(F.when(over, F.col("_stretch"))).alias("_last"), F.coalesce(F.max(F.when(~over, F.col("_run"))), F.lit(0)).alias("_whole_ones")),
        "mixing-stretches",
    )
    inside = open_.join(ends.withColumnRenamed("_of", "_at"), (F.col("_of") == F.col("_at")) & (F.col("_stretch") == F.col("_last")))
    inside = inside.withColumn("_run", F.col("_whole_ones") + F.sum("_size").over(up_to.orderBy("_before")))
    cuts = inside.groupBy("_at").agg(F.min(F.when(over, F.col("_before"))).alias("_cut"), F.max(F.when(~over, F.col("_run"))).alias("_in_last"))
    found = ends.join(cuts, F.col("_of") == F.col("_at"), "left").select(
        F.col("_of").alias("_at"), F.coalesce("_cut", F.lit(_END)).alias("cut"), F.coalesce("_in_last", "_whole_ones").alias("_took")
    )
    taken_now = F.array(F.struct(F.col("_limit").alias("limit"), "cut"))
    moved = F.col("_at").isNotNull()
    return known.join(found, F.col("_of") == F.col("_at"), "left").select(
        "_of",
        (F.col("_gap") - F.coalesce("_took", F.lit(0))).alias("_gap"),
        F.when(moved, F.concat("_rounds", taken_now)).otherwise(F.col("_rounds")).alias("_rounds"),
        moved.alias("_moved"),
    )


def _filled(rows: DataFrame) -> DataFrame:
    """``_more`` and ``_gap`` after one document more of a source has filled what its remainder lacks, as well as it can."""
    room = rows.filter(~F.col("_more") & (F.col("_size") > 0) & (F.col("_size") < 2 * F.col("_gap")))
    best = materialise(
        room.groupBy("_place_of").agg(
            F.min_by(F.struct("_uid", "_size"), F.struct(F.abs(F.col("_size") - F.col("_gap")), "_order", "_uid")).alias("_best")
        ).select(F.col("_place_of").alias("_filled"), F.col("_best._uid").alias("_pick"), F.col("_best._size").alias("_by")),
        "mixing-fill",
    )
    return (
        rows.join(best, F.col("_place_of") == F.col("_filled"), "left")
        .withColumn("_more", F.col("_more") | F.coalesce(F.col("_uid") == F.col("_pick"), F.lit(False)))
        .withColumn("_gap", F.col("_gap") - F.coalesce(F.col("_by"), F.lit(0)))
        .drop("_filled", "_pick", "_by")
    )


def taken(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``(_uid, doc_id, _size, source_size, target, _place, _place_of, _order, _times)`` for rows of :func:`sized`.

    A source is taken whole as often as its target holds its size.  The rest is
    filled with documents in the order of md5(doc_id): those larger than what is
    missing step aside, the others are taken as far as they fit, and so on with
    those up to half of what is then missing, until none fits.  Two single
    documents that come nearest to the rest end it, so no document left could
    bring a source nearer to its target.
    """
    names = rows.groupBy("_source").agg(F.sum("_size").alias("source_size")).withColumnRenamed("_source", "source")
    plan = materialise(targets(names, weights, share, passes).withColumn("_place_of", F.xxhash64("source")), "mixing-targets")
    light = rows.select("_source", "_size", "_uid", "doc_id", F.md5(F.col("doc_id").cast("string")).alias("_order"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    planned = light.join(plan, light["_source"].eqNullSafe(plan["source"])).select(
        "_uid", "doc_id", "_size", "_order", "source_size", "target", "_place_of", F.col("place").alias("_place"), whole.alias("_whole")
    )
    order = [F.col("_place_of"), F.col("_order").asc_nulls_last(), F.col("_size"), F.col("_uid")]
    summed = running_total(planned, order, "_size", "_sum", "mixing-ranges")
    first = materialise(summed.groupBy("_place_of").agg(F.min("_sum").alias("_base")).withColumnRenamed("_place_of", "_of"), "mixing-bases")
    stretch = F.when(F.col("source_size") > 0, F.floor((F.col("_sum") - F.col("_base")) / F.col("source_size") * STRETCHES)).otherwise(0)
    stood = materialise(
        summed.join(first, F.col("_place_of") == F.col("_of"))
        .withColumn("_before", F.col("_sum") - F.col("_base")).withColumn("_stretch", stretch.cast("int")).drop("_sum", "_base", "_of"),
        "mixing-stood",
    )
    rest = F.col("target") - whole * F.col("source_size")
    no_rounds = F.array().cast("array<struct<limit:double,cut:bigint>>")
    state = materialise(plan.select(F.col("_place_of").alias("_of"), rest.alias("_gap"), no_rounds.alias("_rounds")), "mixing-gaps")
    moved, n = True, 0
    while moved:
        after = materialise(_round(stood, state.select("_of", "_gap", "_rounds"), first=n == 0), "mixing-gaps")
        discard(state)
        state, n = after, n + 1
        moved = not state.filter("_moved").isEmpty()
    empty = (F.col("_size") == 0) & (F.col("_before") <= F.col("target") - F.col("_whole") * F.col("source_size"))
    rows = stood.join(state, F.col("_place_of") == F.col("_of")).withColumn("_more", empty | (F.col("_size") > 0) & _is_taken())
    rows = rows.drop("_of", "_rounds", "_moved", "_stretch", "_before")
    rows = _filled(materialise(_filled(materialise(rows, "mixing-first")), "mixing-filled"))
    return rows.withColumn("_times", F.col("_whole") + F.col("_more").cast("int")).select(
        "_uid", "doc_id", "_size", "source_size", "target", "_place", "_place_of", "_order", "_times"
    )


def _time_of(share: Column, place: Column, schedules=SCHEDULES) -> Column:
    """The time by which a source has to give ``share`` (0..1) of its target: its cumulative demand, inverted."""
    out = None
    for n, knots in enumerate(schedules):
        areas = [0.0]
        for (t0, w0), (t1, w1) in zip(knots[:-1], knots[1:]):
            areas.append(areas[-1] + (t1 - t0) * (w0 + w1) / 2)
        due, when = share * areas[-1], None
        for (t0, w0), (t1, w1), a0, a1 in zip(knots[:-1], knots[1:], areas[:-1], areas[1:]):
            slope = (w1 - w0) / (t1 - t0)
            # slope / 2 * s**2 + w0 * s = due - a0, solved for s without cancellation.
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * (due - a0), F.lit(0.0)))
            spent = F.lit(t0) + 2 * (due - a0) / (root + w0)
            when = F.when(due <= a1, F.least(spent, F.lit(t1))) if when is None else when.when(due <= a1, F.least(spent, F.lit(t1)))
        when = when.otherwise(F.lit(knots[-1][0]))
        out = F.when(place == n, when) if out is None else out.when(place == n, when)
    return out


def schedule(choices: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """``(_uid, occurrence, position)``: one row for each time a document is taken, with its training position.

    A source's occurrences stand one after the other, first pass before second,
    and the middle of an occurrence among the source's taken words is the share
    of its demand it meets.
    """
    each = choices.filter("_times > 0").select(
        "_uid", "_size", "_place", "_place_of", "_order", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("occurrence")
    )
    order = [F.col("_place_of"), F.col("occurrence"), F.col("_order").asc_nulls_last(), F.col("_size"), F.col("_uid")]
    stood = materialise(running_total(each, order, "_size", "_sum", "mixing-occurrences"), "mixing-stood")
    ends = materialise(
        stood.groupBy("_place_of").agg(F.min("_sum").alias("_base"), F.sum("_size").alias("_all")).withColumnRenamed("_place_of", "_of"),
        "mixing-ends",
    )
    part = F.when(F.col("_all") > 0, (F.col("_sum") - F.col("_base") + F.col("_size") / 2) / F.col("_all")).otherwise(F.lit(0.5))
    return stood.join(ends, F.col("_place_of") == F.col("_of")).select(
        "_uid", "occurrence", _time_of(part, F.col("_place"), schedules).alias("position")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, schedules=SCHEDULES) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, first_position)``, one row per row of ``docs``.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are
    ignored.  Defined results: null texts have size 0 and are taken 0 words; a
    null source is a source of its own, numbered last; a source without words
    has target 0; rows that repeat are taken each for itself; an empty table
    gives no rows.  ``first_position`` is null for documents not taken.
    """
    rows = materialise(sized(docs.select("doc_id", "text", "source")).drop("text"), "mixing-sized")
    choices = materialise(taken(rows, weights, share, passes), "mixing-choices")
    first = schedule(choices, schedules).filter("occurrence = 0").select(F.col("_uid").alias("_u"), "position")
    return choices.join(first, F.col("_uid") == F.col("_u"), "left").select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("_times")).alias("taken"),
        F.col("position").alias("first_position"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, schedules=SCHEDULES) -> DataFrame:
    """The rows the mix takes, repeats included, with all columns of ``docs``, range-sorted by training position."""
    whole = docs.select(F.struct("*").alias("row"), "doc_id", F.col("text").cast("string").alias("text"), "source")
    rows = materialise(sized(whole).drop("text", "source"), "mixing-documents")
    choices = materialise(taken(rows.drop("row"), weights, share, passes), "mixing-choices")
    placed = materialise(schedule(choices, schedules).withColumnRenamed("_uid", "_u"), "mixing-schedule")
    return (
        rows.join(placed, F.col("_uid") == F.col("_u"))
        .repartitionByRange("position", "_uid", "occurrence")
        .sortWithinPartitions("position", "_uid", "occurrence")
        .select("row.*")
    )


def _time_sql(schedules=SCHEDULES) -> str:
    """:func:`_time_of` in SQL, for columns ``part`` and ``place``."""
    cases = []
    for n, knots in enumerate(schedules):
        areas = [0.0]
        for (t0, w0), (t1, w1) in zip(knots[:-1], knots[1:]):
            areas.append(areas[-1] + (t1 - t0) * (w0 + w1) / 2)
        inner = ""
        for (t0, w0), (t1, w1), a0, a1 in zip(knots[:-1], knots[1:], areas[:-1], areas[1:]):
            due, slope = f"(part * {areas[-1]!r}::DOUBLE - {a0!r}::DOUBLE)", (w1 - w0) / (t1 - t0)
            root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {due}, 0))"
            inner += f" WHEN part * {areas[-1]!r}::DOUBLE <= {a1!r}::DOUBLE THEN least({t0!r}::DOUBLE + 2 * {due} / ({root} + {w0!r}::DOUBLE), {t1!r}::DOUBLE)"
        cases.append(f"WHEN place = {n} THEN CASE{inner} ELSE {knots[-1][0]!r}::DOUBLE END")
    return f"CASE {' '.join(cases)} END"


def mix_sql(documents: str = "documents", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> str:
    """:func:`mix` for DuckDB, with ``first_position`` rounded to six places; rows that repeat a doc_id may tie."""
    word = "[^\\x20\\x09-\\x0D]+"
    weight = " ".join(f"WHEN {n} THEN {float(w)!r}::DOUBLE" for n, w in enumerate(weights))

    def fill(rows: str, out: str) -> str:
        return f"""best_{out} AS (SELECT src, arg_min(uid, (abs(size - gap), o, uid)) AS pick, arg_min(size, (abs(size - gap), o, uid)) AS by_
  FROM {rows} WHERE NOT more AND size > 0 AND size < 2 * gap GROUP BY src),
{out} AS (SELECT f.* REPLACE (more OR coalesce(uid = pick, FALSE) AS more, gap - coalesce(by_, 0) AS gap)
  FROM {rows} f LEFT JOIN best_{out} b ON f.src IS NOT DISTINCT FROM b.src)"""

    rounds = ""
    for n in range(_SQL_ROUNDS):
        limit = "gap" if n == 0 else "gap / 2"
        fits = f"NOT more AND size > 0 AND size <= {limit}"
        rounds += f"""
r{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (take) REPLACE (more OR take AS more, gap - coalesce(sum(size) FILTER (take) OVER (PARTITION BY src), 0) AS gap)
  FROM (SELECT *, {fits} AND sum(CASE WHEN {fits} THEN size ELSE 0 END) OVER (PARTITION BY src ORDER BY before, size, uid ROWS UNBOUNDED PRECEDING) <= gap AS take FROM r{n})),"""

    return f"""WITH docs AS (SELECT doc_id, source AS src, row_number() OVER () AS uid, md5(CAST(doc_id AS VARCHAR)) AS o,
  CAST(len(regexp_extract_all(coalesce(text, ''), '{word}')) AS BIGINT) AS size FROM {documents}),
sources AS (SELECT src, CAST(sum(size) AS BIGINT) AS n, (row_number() OVER (ORDER BY src NULLS LAST) - 1) % {len(weights)} AS place FROM docs GROUP BY src),
weighed AS (SELECT *, CASE place {weight} END AS w, n * {float(passes)!r}::DOUBLE AS cap FROM sources),
levels AS (SELECT *, cap / w AS ratio,
  ((sum(n) OVER ())::DOUBLE * {share!r}::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM weighed WINDOW b AS (ORDER BY cap / w, src NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (SELECT src, n, place, least(cap, coalesce(w * (SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio), cap)) AS target FROM levels),
ordered AS (SELECT d.*, n, place, target, CASE WHEN n > 0 THEN CAST(floor(target / n) AS INTEGER) ELSE 0 END AS whole,
  coalesce(sum(size) OVER (PARTITION BY d.src ORDER BY o NULLS LAST, size, uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN plan p ON d.src IS NOT DISTINCT FROM p.src),
r0 AS MATERIALIZED (SELECT *, size = 0 AND before <= target - whole * n AS more, target - whole * n AS gap FROM ordered),{rounds}
{fill(f"r{_SQL_ROUNDS}", "once")},
{fill("once", "twice")},
chosen AS (SELECT *, whole + CAST(more AS INTEGER) AS times FROM twice),
each AS (SELECT *, unnest(range(0, times)) AS occurrence FROM chosen),
stood AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY src ORDER BY occurrence, o NULLS LAST, size, uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done,
  sum(size) OVER (PARTITION BY src) AS whole_size FROM each),
timed AS (SELECT uid, place, CASE WHEN whole_size > 0 THEN (done + size / 2) / whole_size ELSE 0.5 END AS part FROM stood WHERE occurrence = 0)
SELECT doc_id, size, n AS source_size, target, CAST(size * times AS BIGINT) AS taken, round(t, 6) AS first_position
FROM chosen LEFT JOIN (SELECT uid, {_time_sql()} AS t FROM timed) USING (uid)"""
