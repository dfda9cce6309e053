"""Wall time of headline queries: one JSON line.

BENCH_SF_DIR: the tables (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8).
Each query is planned and run once, in full, into a sink that keeps nothing, after two of them have started the
session up (`warm_up_sec`, not part of the sum).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))
from strandloom.queries import QUERIES  # noqa: E402

HEADLINES = [
    "two_hop_customers_per_region", "lift_triples", "dense_node_ids", "edge_type_counts", "facts_of_customers", "snapshot_pivot", "entity_texts", "type_subsumption",
    "sequence_events", "sequence_first_occurrences", "escalation_events", "opposite_orders", "rank_pairs_about_middle", "suppliers_sharing_nation",
    "as_of_exact", "as_of_fallback", "moneyness_classes", "keyword_sectors", "interval_join", "unify_by_key", "hub_by_routes", "calendar_hubs", "finest_grain",
    "schema_axioms", "class_closure", "z_scores", "categorical_slots", "node_feature_entries", "edge_feature_entries", "node_vectors", "densify_round_trip",
    "graph_pattern", "split_adjusted_prices", "around_splits", "before_after", "market_coverage", "source_accounts", "enrichment_account",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The session's own start: classes, code generation and Python workers, once over the smallest of the plans; reported apart.
    began = time.perf_counter()
    QUERIES["facts_of_customers"](spark, folder).write.format("noop").mode("overwrite").save()
    QUERIES["densify_round_trip"](spark, folder).write.format("noop").mode("overwrite").save()
    warm_up = round(time.perf_counter() - began, 3)
    took: dict[str, float] = {}
    for name in HEADLINES:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "sum of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "warm_up_sec": warm_up, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
