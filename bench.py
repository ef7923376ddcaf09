"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from statistics import median

from palisade.plans.queries import QUERIES
from palisade.session import local_session

RUNS = 3  # the median of so many counts, of the learners a single one
HEADLINE = """
signature_rules signature_hits hybrid_summary
missing_report duplicate_rows class_distribution numeric_summary
impute_mean impute_median first_of_duplicates rows_inside_iqr one_hot scale_standard scale_robust
preprocessed_rows f_scores information_scores uncorrelated_features feature_stage
three_way_split stratified_split oversampled_counts
ensemble_probability hard_vote fused_label fusion_report
metrics_summary model_comparison classification_report roc_curve precision_recall_curve
best_threshold_f1 per_class_metrics labels_encoded
""".split()
# With BENCH_LEARNERS=1: all five learners with their default settings, which takes far longer than the rest.
LEARNERS = "training_job learner_kernel_machine reused_learners batch_inference".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE + LEARNERS * (os.environ.get("BENCH_LEARNERS") == "1")
    spark = local_session(cpus, app="palisade-bench")
    # Start-up and the first compilation are not part of any query.
    QUERIES["metrics_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(RUNS if name in HEADLINE else 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    spark.stop()
    result = {
        "metric": "total time of the headline queries, median of runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
