"""Time the headline queries: one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tideline.plans import catalog
from tideline.session import build_session

HEADLINE = [
    "gap_statistics",
    "gaps_internal",
    "remaining_gaps",
    "covered_intervals",
    "segment_ids",
    "sessions",
    "resample_mean_dense",
    "resample_energetic",
    "resample_dominant",
    "resample_intervals",
    "asof_nearest",
    "geotag_events",
    "true_wind_provenance",
    "pressure_removal",
    "hampel_blank",
    "clean_chain",
    "position_merge",
    "source_share",
    "dedup_records",
    "time_parse_mixed",
    "interval_union",
    "interval_intersection",
    "cast_table",
    "cross_leg_casts",
    "profile_product",
    "instrument_product",
    "spectrum_bands",
    "spectrum_product",
    "dbscan_noise",
    "detector_product",
    "wind_rose",
    "distribution",
    "audit_summary",
    "layout_overlaps",
    "ingest_delimited",
    "ingest_profiles",
    "ingest_archives",
    "stream_resample",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="spark-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["wind_rose"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
