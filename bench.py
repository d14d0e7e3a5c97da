"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one line of JSON."""

import json
import os
import time

from corpusloom.plans.queries import queries
from corpusloom.session import build_session

NAMES = ["exact_dedup", "filter_all", "token_total", "token_total_body", "standardize_fineweb", "minhash_signature_8x16", "candidate_edges", "near_dedup_kept_8x16"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).count()
    took = {}
    for name in NAMES:
        began = time.time()
        queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
