"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_ALL=1 for every query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfspark.plans import QUERIES
from shelfspark.session import local_session

HEADLINE = """
flagship_marketplace_summary fil8_eligible_offers fil9_marketplace_rows jn2_named_sellers jn1_fragment_merge
agg1_star_histogram agg2_review_summary agg6_marketplace_rollup agg8_channel_stock agg15_job_log
win1_search_ranking win5_top_offer srt1_capped_results jn13_brand_guess jn14_archive_as_of
pag1_meta_table pag5_profile_fields pag6_listing_links fn12_slug fn16_clean_markup fn18_descriptions
fil2_message_validity jn18_task_results prj2_export_record fn28_deep_key_search st3_streaming_job_log st1_stateful_fragment_merge agg19_collection_members srt6_price_call_batches
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), app="bench")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
