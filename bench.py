"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS pick the tables and the number of local cores. Each
query is planned and run to the end (every row produced, none kept) twice, and
the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "render_llama render_gemma render_chatml assemble_conversations response_spans mask_stats "
    "standardize_sharegpt prompt_messages annotation_messages entities_json fill_template "
    "normalize_entity_fields annotation_training_rows head_slice cap_per_source sample_to_share "
    "seeded_shuffle train_eval_split mix_report length_stats truncate_examples pack_sequences "
    "plan_requests request_payload contract_status validate_annotations generation_progress "
    "pending_requests check_grounding check_context_shape label_balance batch_label_coverage "
    "shard_roundtrip shard_manifest reasoning_chat_rows"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from chatloom.session import SESSION_CONF
    from checks.queries import QUERIES

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chatloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
