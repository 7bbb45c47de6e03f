"""Headline-query benchmark: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).  Each
query is fully executed with the ``noop`` sink (no collect to the driver).
Every key runs cold: it starts stage tables of its own (``reelcast.stages.run``),
so its time holds all the stages of its chain.  ``warm`` holds a second run of each
key that finds its chain's stage tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "user_top_items", "order_action_weight", "agg_action_stat", "hot_factor", "explode_tfidf",
    "textrank_keywords", "topic_weights", "profile_recall", "cosine_in_cluster", "item_recall_final",
    "similar_recall", "title_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from reelcast.plans.queries import REGISTRY
    from reelcast.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    spark.range(1000).selectExpr("sum(id)").collect()   # JVM warm-up, not timed
    times, warm = {}, {}
    for name in HEADLINE:
        spark.conf.set("reelcast.stages.run", f"bench-{name}")
        for into in (times, warm):
            t0 = time.time()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            into[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s, warm {warm[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "warm": warm, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
