"""Time headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all),
BENCH_RUNS (default 3): median of warm runs after one warm-up. Results are
counted through the noop sink, so every column is computed.
"""

import json
import os
import statistics
import time

from lathe.queries import load
from lathe.session import build_session

HEADLINE = [
    "catalog_standard_table",
    "two_stage_enrichment",
    "collection_flow",
    "dedup_keep_first_url",
    "dedup_scope_global",
    "append_old_wins",
    "merge_results_trimmed",
    "todo_anti",
    "lookup_list_join",
    "category_index",
    "running_index",
    "carry_forward_section",
    "top_n_per_category",
    "distinct_option_concat",
    "dynamic_pivot_sorted",
    "collection_variants",
    "dims_ei",
    "dims_wa",
    "dims_dsh",
    "rule_table_extraction",
    "spec_final_values",
    "section_split",
    "pipe_alias_spec",
    "family_rules",
    "price_parse",
    "clean_whitespace",
    "plain_words",
    "keyword_groups",
    "full_page_audit",
    "internal_links",
    "embedded_product_json",
    "upsert_by_category",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session("bench", f"local[{cpus}]", partitions, text_tasks=partitions)
    spark.sparkContext.setLogLevel("ERROR")
    entries, times = load(), {}
    for name in HEADLINE:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            entries[name].run(spark, sf).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf, "shuffle_partitions": partitions, "runs": runs}))


if __name__ == "__main__":
    main()
