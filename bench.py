"""Time every registered query of the reference's operators and print one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. The stand-in source files and the stored
facts are written first; that counts into the total and is also given apart, as ``setup``.
"""

from __future__ import annotations

import json
import os
import time

from semestra.session import build_session
from semestra.standins import landing, registry
from semestra.standins.stored import stored_warehouse

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    landing.inputs(spark, sf_dir)
    stored_warehouse(spark, sf_dir)
    for name in (
        "stocks_dirty", "index_dirty", "part_codelists", "prices_dirty", "prices_faulty", "prices_empty", "dependency_dirty",
        "faulty_codelists", "faulty_products",
    ):
        landing.landed(spark, sf_dir, name)
    setup = time.perf_counter() - start

    times = {}
    for name in registry.QUERIES:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total time of all queries and their set-up",
        "value": round(setup + sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "setup": round(setup, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
