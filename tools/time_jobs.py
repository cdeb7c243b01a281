"""Wall time of the persisted jobs (daily pipeline, mood job, k-means job)
over the driver tables: usage python tools/time_jobs.py <sf_dir> <scratch_dir>"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from moodlake.plans import jobs as J  # noqa: E402
from moodlake.plans import pipeline as PL  # noqa: E402
from moodlake.session import build_session  # noqa: E402
from moodlake.sources import fixture  # noqa: E402


def main():
    sf, base = sys.argv[1], sys.argv[2]
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.checkpoint.dir": os.path.join(base, "ckpt")})
    lake = J.Lake(spark, os.path.join(base, "lake"))
    t = {}

    def step(name, fn):
        s = time.time()
        fn()
        t[name] = round(time.time() - s, 2)

    raw = PL.bronze(spark, sf)
    step("bronze", lambda: J.run_bronze(lake, raw, "r1"))
    step("silver", lambda: J.run_silver(lake, "r1", fixture.BRONZE_TIEBREAK))
    step("artists_scd2", lambda: J.run_artists(lake, "r1", "2024-01-01 00:00:00"))
    step("silver_quality", lambda: J.run_silver_quality(lake, "r1", minimum=1))
    step("gold", lambda: J.run_gold(lake, "r1"))
    step("artists_scd2_second_run", lambda: J.run_artists(lake, "r2", "2024-01-02 00:00:00"))
    step("mood", lambda: J.run_mood(lake, "r1", "2024-01-01 00:00:00"))
    step("kmeans", lambda: J.run_kmeans(lake, "r1", 1))
    print(json.dumps({"sf": sf, "cpus": cpus, "seconds": t, "total": round(sum(t.values()), 2),
                      "rows": lake.counts}))


if __name__ == "__main__":
    main()
