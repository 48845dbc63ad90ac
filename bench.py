"""Headline queries, wall seconds of the second run each, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dropsieve.plans.registry import queries  # noqa: E402
from dropsieve.session import build_session  # noqa: E402

HEADLINE = (
    "sample_overview",
    "cell_metrics",
    "nuclear_summary",
    "qc_loss_breakdown",
    "knee_ranks",
    "top_features",
    "metric_quantiles",
    "peak_counts",
    "tss_enrichment",
    "atac_pass",
    "log_normalised",
    "knn",
    "shared_neighbours",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    took = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of warm wall time over the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
