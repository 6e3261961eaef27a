"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postgauge.registry.queries import QUERIES  # noqa: E402
from postgauge.session import build_session  # noqa: E402

HEADLINE = (
    "normalized_text",
    "word_term_stats",
    "word_bigram_vocab",
    "char_wb_vocab",
    "tfidf_vectors",
    "group_split",
    "fold_assignment",
    "flagship_metrics",
    "mnb_predictions",
    "cnb_char_predictions",
    "lr_predictions",
    "svm_predictions",
    "embedding_lr",
    "metric_records",
    "roc_curve",
    "cv_nb_folds",
    "latest_runs",
    "answer_validate",
    "answer_matrix_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
