"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line with seconds by query."""

from __future__ import annotations

import importlib.util
import json
import os
import time

from pyspark.sql import SparkSession

from captureframe.plans.catalogue import QUERIES

HEADLINES = ["scope_items", "concealed_rules", "interval_calc", "interval_flatten", "voxel_downsample", "dense_histogram", "segment_merge_short", "weighted_median_fusion", "majority_vote", "covisibility_pairs", "similarity_candidates", "nearest_neighbour", "range_join_segments", "qa_report", "tier_accuracy", "golden_diff", "secret_scrub", "token_bucket_batch"]
LLM = ["op1_nnpu_toxicity", "op2_context_mixing", "op3_best_fit_packing", "op4_positional_index", "op5_zip_warc", "op6_url_graph", "op7_ranked_token_files", "op8_line_templates", "op9_block_max_bm25", "op10_simhash"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    found = {name: QUERIES[name] for name in HEADLINES}
    if importlib.util.find_spec("captureframe.llm") and importlib.util.find_spec("captureframe.llm.queries"):
        from captureframe.llm.queries import QUERIES as more

        found |= {name: more[name] for name in LLM if name in more}
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # starts the executors
    took = {}
    for name, query in found.items():
        at = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - at, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
