"""Seconds per registered query, and for a whole run from CSV files to reports.

Stage tables are built and timed first (``stage_*``), as reports read written
tables. Each query then runs into a sink that discards rows. ``daily_run`` is
the full chain over the exported CSV files and shares nothing with the rest.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from scrapeloom.plans.daily_run import run_stages  # noqa: E402
from scrapeloom.session import build_session, shared_dir  # noqa: E402
from scrapeloom.sources import daily_csv  # noqa: E402
from scrapeloom.sources.tables import Warehouse  # noqa: E402
from workload.registry import QUERIES, export_days  # noqa: E402
from workload.stages import Stages  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not measured
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    stages = Stages(spark, sf_dir)
    timed("stage_raw", lambda: stages.raw)
    timed("stage_clean", lambda: stages.clean)
    timed("stage_entities", lambda: stages.resolution().entities)
    timed("stage_entities_similar_names", lambda: stages.resolution(90).entities)
    timed("stage_star", lambda: stages.star())
    for name, build in QUERIES.items():
        timed(name, lambda build=build: build(spark, sf_dir).write.format("noop").mode("overwrite").save())

    folder = export_days(stages)
    warehouse = Warehouse(spark, f"{shared_dir(spark)}/bench-tables")
    timed(
        "daily_run",
        lambda: run_stages(
            spark, folder, warehouse, "bench", recursive=True, source_name=daily_csv.day_folder_name()
        ),
    )
    print(
        json.dumps(
            {
                "metric": "seconds over all stages, queries and one daily run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "rows": stages.raw.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
