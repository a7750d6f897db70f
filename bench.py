"""Time the headline queries; prints one JSON line.

Every query runs once to warm up and three times timed; the median counts.  All
columns of all rows are computed (``noop`` sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks import registry
from duologue import build_session

HEADLINE = [
    "best_clip_per_speaker",
    "voice_report",
    "source_accented_english",
    "turn_normalise",
    "validate_turns",
    "assemble_timeline",
    "scale_to_target",
    "corpus_progress",
    "run_plan_summary",
    "budget_admission",
    "consecutive_failures",
    "token_usage_rollup",
    "content_verdict_normalise",
    "script_schedule",
    "alignment_merge",
    "upload_batches",
    "stream_best_clip",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus)
    spark.sparkContext.setLogLevel("OFF")
    queries = registry.queries()

    def run(name: str) -> float:
        begin = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    timings: dict[str, float] = {}
    for name in wanted:
        run(name)
        timings[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
