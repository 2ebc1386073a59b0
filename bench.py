"""Times queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

    python bench.py            headline queries, one warm-up and one timed run each
    python bench.py d85 d08    queries whose key starts with one of these
    python bench.py all        every query, one run each
"""

from __future__ import annotations

import json
import os
import sys
import time

from gondola.plans import QUERIES
from gondola.session import local_session, scratch

HEADLINE = [
    "d70_sales_facts", "d71_abc_by_revenue", "d73_store_product_abc", "d74_stock_coverage", "d76_adherence_score", "d77_store_tiers",
    "d54_purchase_profile", "d55_rfm_segments", "d57_preferences", "d59_product_persona", "d62_combo_cashback", "d64_reimbursement",
    "d65_manager_bonus", "d85_product_rules", "d86_category_rules", "d88_attribution", "d91_substitutes", "d01_fuse_sources",
    "d08_closure", "d14_cascade_match", "d36_repair_vocabulary", "d40_size_tiers", "d72_dense_top_k", "d97_bm25_top_k",
    "d105_tuning_lines", "d108_quality_score", "d113_send_list", "t01_profile", "t04_upsert", "n6_document_texts",
]


def run(spark, key: str, folder: str) -> float:
    start = time.perf_counter()
    with scratch(spark):
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    args = sys.argv[1:]
    everything = args == ["all"]
    keys = list(QUERIES) if everything else [k for k in QUERIES if any(k.startswith(a) for a in args)] if args else HEADLINE
    spark = local_session(cores)
    times = {}
    for key in keys:
        if not everything:
            run(spark, key, folder)
        times[key] = round(run(spark, key, folder), 3)
        if everything:
            print(key, times[key], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
