"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON.

Each query runs once to warm up and then RUNS times, its whole result written to Spark's no-op sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)

from varloom.plans import registry
from varloom.session import local_session

HEADLINE = (
    "kernel_classify", "annotations_spec", "clinvar_exact", "ps1_pm5", "pm1_hotspot", "nmd_escaping", "constraint_join", "distinct_loci", "merge_regions",
    "exon_scope", "store_merge", "de_novo", "compound_het", "affected_shared_hom", "classify_case", "phenotype_scores", "candidate_rank", "reanalysis_diff",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus=cpus, partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    named, took = registry.queries(), {}
    if unknown := [name for name in HEADLINE if name not in named]:
        raise ValueError(f"not registered: {', '.join(unknown)}")
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            spark.catalog.clearCache()  # a run pays for the views that its query keeps
            began = time.perf_counter()
            named[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "median seconds, summed over queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
