"""Headline queries on ``local[$BENCH_CPUS]`` at ``$BENCH_SF_DIR``; prints one JSON line.

Each query is built and written to the no-op sink, so every row and column is
computed. Staging tables are written first and timed as ``stage``; the load of
all imports and exports, whose stored facts the extracts read, as ``load``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aforo.session import build_session
from checks.queries import QUERIES, loaded
from checks.views import STORED, stored_path

HEADLINE = [
    "dim_backfill", "dim_first_file_wins", "assign_surrogate_ids", "country_iso2", "dim_lookup_join",
    "fact_importacion", "fact_exportacion", "trade_by_chapter", "extract_import_by_file",
    "extract_export_by_file", "search_documents", "replace_by_file", "predominant_year", "outbox_append",
    "pending_anti_join", "control_state", "profile_cardinality", "fill_rate", "scan_xlsx", "stream_stage_files",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name: str, job) -> None:
        began = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    timed("stage", lambda: [stored_path(spark, sf_dir, name) for name in STORED])
    timed("load", lambda: loaded(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
