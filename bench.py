"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ALL=1 for every
registered query. The layers are built first and timed as ``build_silver`` and ``build_gold``;
each query is then run once, fully, into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import re
import time

from atende.plans.layers import GOLD, SILVER_WAVE, lake_for
from atende.registry import QUERIES
from atende.session import local_session

HEADLINE = re.compile(
    r"^(b2_cdc_dedup_latest|b12_|b14_merge_upsert_if_changed|b18_|d1_|d8_|d17_|d18_|e1_surrogate_key_seq|e8_|f3_|f7_|f10_"
    r"|f14_|g1_2|g2_5|g3_2|g4_2|g5_2|g6_5|g7_2|g8_2|g8_3|g9_1|g10_2|g11_2|g12_2|h1_|h4_|h8_|i1_|i2_dataset_operators$|i5_"
    r"|j1_|j6_|j8_|j16_|j23_)"
)


def main() -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    lake = lake_for(spark, source)
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("build_silver", lambda: lake.require(SILVER_WAVE))
    timed("build_gold", lambda: lake.require(GOLD))
    for name, query in QUERIES.items():
        if os.environ.get("BENCH_ALL") or HEADLINE.match(name):
            timed(name, lambda q=query: q(spark, source).write.format("noop").mode("overwrite").save())
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds,
                "sf": os.path.basename(source.rstrip("/")).removeprefix("sf"), "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
