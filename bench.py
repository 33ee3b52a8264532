"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vellumark.plans.queries import QUERIES  # noqa: E402
from vellumark.session import build_session  # noqa: E402

HEADLINE = (
    "src_csv_strings",
    "src_attachments",
    "sink_xml_chunks",
    "sink_delivery_ledger",
    "sink_run_metrics",
    "sink_upsert",
    "sink_package_zip",
    "join_attachments",
    "join_catalog_path",
    "agg_share_by_status",
    "agg_monthly_volume",
    "agg_completeness",
    "agg_duplicates",
    "agg_infer_relational",
    "agg_infer_json",
    "win_chunk_assign",
    "win_pack_greedy",
    "dq_checks",
    "pkg_payload_xml",
    "chunk_fixed",
    "chunk_sentence",
    "chunk_hybrid",
    "vec_embed",
    "vec_quantize_int8",
    "vec_cosine_topk",
    "enr_summary",
    "enr_keywords",
    "enr_entities",
    "enr_pii",
    "enr_synonyms",
    "ml_outliers",
    "ml_rarity_outliers",
    "ml_knn_label",
    "stream_chunk_export",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench", cpus, **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "6g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["agg_share_by_status"](spark, sf).collect()  # start-up is not part of a query
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
