"""Times the headline queries: one JSON line on stdout.

Folder from BENCH_SF_DIR, cores from BENCH_CPUS. Every query is run to the end (all columns of
all rows) into Spark's no-op sink; the best of two runs counts, so that JVM warm-up does not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusloom.plans.catalogue import QUERIES  # noqa: E402
from corpusloom.session import local_session, remove_intermediate  # noqa: E402
from corpusloom.sources.readers import SCAN_PARTITIONS  # noqa: E402

HEADLINE = [
    "training_text",
    "conv_render",
    "conv_render_tools",
    "preference_sides",
    "rl_subset",
    "response_parse",
    "reward_single",
    "reward_agent",
    "gt_verify",
    "rep_penalty",
    "frame_pad_label",
    "span_mask",
    "tail_pack",
    "epoch_shuffle",
    "batch_resume",
    "sample_n",
    "eos_cut",
    "gae",
    "whiten",
    "group_adv",
    "ratio_clip",
    "dpo_margin",
    "ppo_value",
    "distill_kl",
    "nucleus",
    "exact_dedup",
    "contamination",
    "length_profile",
    "word_freq",
    "pretoken_freq",
    "choice_argmax",
    "metric_log",
    "stream_split",
    "stream_deltas",
    "pretrain_job",
    "chat_job",
    "preference_job",
    "conv_history_n",
    "tool_lookup_default",
    "distill_kl_long",
    "length_sketch",
    "text_span_mask",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cores, int(cores), "bench")
    spark.conf.set(SCAN_PARTITIONS, cores)  # each table is one file with one row group
    times: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        remove_intermediate(spark)
        print(f"{name} {runs[0]:.2f} {runs[1]:.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
