"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lectern.catalog import QUERIES  # noqa: E402
from lectern.session import build_session  # noqa: E402

HEADLINE = (
    "b1_paragraphs", "b2_sentences", "b4_text_chunks", "b4_text_chunks_tight", "b5_span_batches",
    "b6_overlapping_windows", "b8_reassembly", "b10_prompts", "c3_timeline", "c7_subtitle_text",
    "m2_text_transform", "m7_running_costs", "m8_budgets", "m10_decisions", "e2_e3_decisions", "e4_blocks",
    "f3_sentence_review", "f5_review_report", "f6_line_changes", "f8_work_selection", "f11_stable_ids",
    "g1_merged_blocks", "g3_condensed_texts", "h1_run_states", "h3_slots_in_use", "h6_stage_matrix",
    "i1_live_states", "i2_live_slots",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "sum of median warm seconds over the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
