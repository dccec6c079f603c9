"""Time the clean-and-model job and the headline reports; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from reviewmill import REPORTS, Stage, build_session, build_star, clean_reviews
from reviewmill.operators.sentiment import sample_lexicon
from reviewmill.plans import kpi, measures
from reviewmill.sources.sample import raw_reviews


def run(result) -> None:
    """Compute every row without sending any to the driver."""
    result.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cores}]",
        spark__sql__shuffle__partitions=cores,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # Inputs here are tiny: keep every core busy instead of merging partitions.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
        return result

    stage = Stage(spark)
    raw = raw_reviews(spark, folder)
    lexicon = sample_lexicon(spark)
    cleaned = timed("clean_reviews", lambda: clean_reviews(raw, lexicon, stage))
    star = timed("build_star", lambda: build_star(cleaned, stage))
    for name, report in REPORTS.items():
        timed(name, lambda report=report: run(report(star, stage)))
    timed("k1_app_summary", lambda: run(kpi.app_summary(cleaned)))
    timed("k2_kpi_table", lambda: run(kpi.kpi_table(cleaned, stage)))
    timed("b1_measures", lambda: run(measures.measures(star, ["app_name", "month_name"])))
    timed("b2_rating_trend", lambda: run(measures.rating_trend(star)))
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder)}))
    spark.stop()


if __name__ == "__main__":
    main()
