"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the tables (default sf0.1), `BENCH_CPUS` the local cores.
Names on the command line restrict the run.
"""

import json
import os
import sys
import tempfile
import time

from kindred.registry import QUERIES
from kindred.session import build_session
from kindred.storage import release_staged

HEADLINE = (
    "dedupe_purchases",
    "item_pearson",
    "item_pearson_purchases",
    "user_pearson",
    "item_cf_basic",
    "item_cf_purchases",
    "user_cf",
    "minhash_signatures",
    "lsh_candidates",
    "lsh_similar_items",
    "jaccard_exact",
    "bias_baseline",
    "blend_four",
    "gbt_predict",
    "mf_predict",
    "ensemble_predict",
)


def main(names):
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        {
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["dedupe_ratings"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM
    times = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
        release_staged(spark)
    scale = os.path.basename(folder).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
