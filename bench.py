"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query does all of its work each time; nothing is shared between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from nomina.scratch import drop_scratch  # noqa: E402
from workload import QUERIES  # noqa: E402
from workload.compare import session  # noqa: E402

HEADLINE = [
    "clean_text",
    "clean_documents",
    "cascade_label",
    "labelled_lines",
    "pseudo_labels",
    "pseudo_label_coverage",
    "rule_stats",
    "rule_audit",
    "top_keywords",
    "draft_rules",
    "document_token_counts",
    "document_top_ngrams",
    "unmatched_words",
    "lemma_join",
    "qa_sample",
    "training_set",
    "finetune_dataset",
    "stratified_split",
    "ordered_holdout",
    "document_tfidf_weights",
    "ml_backfill",
    "class_report",
    "stream_labels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # Start the JVM, the Python workers and the readers once.
    QUERIES["coverage"](spark, "/root/testdata/sf0.001").collect()

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
