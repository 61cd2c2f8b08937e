"""Times the headline queries and the whole health job; prints one JSON line.

The published numbers to beat do not exist, so the health job is timed twice:
as it is, and as a run that takes one action after the other and computes
shared results again for each (``many_actions``).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sluice.domains import vehicles as domain  # noqa: E402
from sluice.operators.dedupe import duplicate_keys  # noqa: E402
from sluice.operators.quality import row_checks  # noqa: E402
from sluice.sinks.files import publish  # noqa: E402
from verification.queries import (  # noqa: E402
    BUSINESS_DATE,
    QUERIES,
    curation,
    health_run,
    new_folder,
)

HEADLINES = (
    "clean_telemetry",
    "clean_service",
    "reject_reason_counts",
    "enriched",
    "daily_summary",
    "service_kpis",
    "risk_story",
    "daily_revenue",
    "gate_metrics",
    "archive_ingest",
)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def many_actions(spark: SparkSession, sf_dir: str) -> None:
    """The same outputs with a count, check or write at a time, 23 in all."""
    c = curation(spark, sf_dir)
    clean = {n: getattr(c, n).valid.cache() for n in ("telemetry", "service", "vehicles", "dealers")}
    enriched = c.enriched.cache()
    for frame in (c.raw.telemetry, c.raw.service, c.raw.vehicles, c.raw.dealers):
        frame.count()
    for frame in (enriched, c.daily_summary, c.service_kpis, c.rejects):
        frame.count()
    for broken in row_checks(domain.SEVERITIES).values():
        enriched.filter(broken).count()
    duplicate_keys(enriched, domain.EVENT_KEY).count()
    enriched.count()
    c.daily_summary.agg(F.sum("telemetry_event_count")).collect()
    root = new_folder(spark, "many-actions")
    for name, frame in {
        "vehicle_telemetry_clean": clean["telemetry"],
        "service_events_clean": clean["service"],
        "vehicle_health_enriched": enriched,
        "daily_vehicle_health_summary": c.daily_summary,
        "service_kpi_summary": c.service_kpis,
        "rejects": c.rejects,
    }.items():
        publish(frame, root, domain.OUTPUTS[name], BUSINESS_DATE)
    for frame in (*clean.values(), enriched):
        frame.unpersist()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sluice-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query also pays for starting Spark and its compiler.
    consume(QUERIES["daily_summary"](spark, sf_dir))
    times = {
        name: timed(lambda name=name: consume(QUERIES[name](spark, sf_dir))) for name in HEADLINES
    }
    times["health_job"] = timed(lambda: health_run(spark, sf_dir))
    compared = {"many_actions": timed(lambda: many_actions(spark, sf_dir))}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "compared_with": compared,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
