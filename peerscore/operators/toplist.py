"""Top-N per audience profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def by_profile(scored: DataFrame, profiles: Mapping[str, Sequence[str]], audience: str = "publico_alvo") -> DataFrame:
    """Scored entities once per profile that may hold them; profiles overlap."""
    open_to: dict[str, list[str]] = {}
    for profile, audiences in profiles.items():
        for a in audiences:
            open_to.setdefault(a, []).append(profile)
    known = F.create_map(
        *[x for a, ps in open_to.items() for x in (F.lit(a), F.array(*[F.lit(p) for p in ps]))]
    )
    return scored.filter(F.col("score").isNotNull()).withColumn(
        "profile", F.explode(F.try_element_at(known, F.col(audience)))
    )


def top_n_by_audience(
    scored: DataFrame,
    profiles: Mapping[str, Sequence[str]],
    top_n: int,
    tiebreak: Sequence[str] = ("fund_key",),
    audience: str = "publico_alvo",
) -> DataFrame:
    """Adds ``profile`` and ``rank`` and keeps the best ``top_n`` of each profile.

    The group limit runs before the exchange, so a profile that holds most
    entities sends ``top_n`` rows per map task.
    """
    w = Window.partitionBy("profile").orderBy(F.col("score").desc_nulls_last(), *tiebreak)
    return (
        by_profile(scored, profiles, audience)
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= top_n)
    )


def profile_universe(
    scored: DataFrame, profiles: Mapping[str, Sequence[str]], audience: str = "publico_alvo"
) -> DataFrame:
    """Eligible entities per profile, 0 for a profile without any."""
    spark = scored.sparkSession
    names = spark.createDataFrame([(p,) for p in profiles], "profile string")
    counts = by_profile(scored, profiles, audience).groupBy("profile").agg(F.count("*").alias("universe"))
    return names.join(counts, "profile", "left").withColumn("universe", F.coalesce("universe", F.lit(0)))
