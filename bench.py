"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query
runs once unmeasured and then ``RUNS`` times; the best time counts.  Results
go to the ``noop`` sink, so the whole query runs and nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from peerscore.catalog import CATALOG
from peerscore.session import build_session

HEADLINE = [
    "fund_metrics",
    "top_n_by_audience",
    "jump_flags",
    "period_returns",
    "information_ratio",
    "reference_wide",
    "anchor_returns",
    "canonical_series",
    "keep_first_dedup",
    "two_pass_match",
    "treated_dimension",
    "mode_impute",
    "quality_profile",
    "archive_expand",
    "event_value_percentile",
]
RUNS = 2


def totals(spark) -> tuple[int, int]:
    """Rows read and shuffle bytes written by all stages so far, from Spark's own status store."""
    jvm, context = spark._jvm, spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    none = spark.sparkContext._gateway.new_array(jvm.double, 0)
    stages = context.statusStore().stageList(None, False, False, none, jvm.java.util.ArrayList())
    found = [stages.apply(i) for i in range(stages.size())]
    return sum(s.inputRecords() for s in found), sum(s.shuffleWriteBytes() for s in found)


def timed(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app_name="peerscore-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__retainedStages="100000",
        spark__checkpoint__dir=os.environ.get("SCRATCH_DIR") or tempfile.mkdtemp(prefix="spark-scratch-"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rows_in, shuffle_bytes = {}, {}, {}
    for name in HEADLINE:
        build = CATALOG[name][0]
        before = totals(spark)
        timed(build, spark, sf_dir)
        rows_in[name], shuffle_bytes[name] = (now - then for now, then in zip(totals(spark), before))
        seconds[name] = round(min(timed(build, spark, sf_dir) for _ in range(RUNS)), 3)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_in": rows_in,
                "shuffle_bytes": shuffle_bytes,
                "sf": float(found.group(1)) if found else None,
                "lineitem_rows": lines,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
