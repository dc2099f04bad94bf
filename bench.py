"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Where the
smallest tables (sf0.001) lie beside them, each relational query is run on those first, so that the timed run
measures work instead of class loading. Results are consumed in full.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from firmlens.catalog import QUERIES  # noqa: E402
from firmlens.session import get_spark  # noqa: E402

HEADLINE = [
    "src_csv_panel", "src_glob_econ", "src_term_structure", "sink_upsert_predictions",
    "prep_default_fill", "win_lead_label_12", "win_lead_label_calendar", "win_current_previous_event",
    "join_result_table", "join_merge_predictions", "join_country_metrics", "join_calendar_spine", "join_window_panel",
    "agg_latest_per_firm", "agg_class_weights", "agg_window_sizes", "agg_data_profile",
    "split_expanding_kfold", "split_window_guards",
    "met_ovo", "met_roc_auc", "met_pr_auc", "met_roc_auc_ovr_macro", "met_monthly_series", "met_12m_series",
    "met_series_by_econ", "met_ar_vs_reference", "met_quality_table",
    "bt_relational_core", "attr_linear", "attr_feature_stability", "stream_daily_drop",
    "ml_fit_multiclass", "bt_expanding_12m",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "firmlens-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k", "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")

    def run(name: str, where: str) -> None:
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        if os.path.isdir(small) and not name.startswith(("ml_", "bt_expanding")):
            run(name, small)
        start = time.perf_counter()
        run(name, folder)
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
