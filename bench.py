"""Time the bound queries: prints one JSON line.

`BENCH_SF_DIR` is the table folder, `BENCH_CPUS` the number of local cores.
Each query is run once to warm up and then timed once into a sink that keeps
nothing, so the whole result is computed and no row reaches the driver.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tracemill.operators import extract  # noqa: E402
from tracemill.operators.registry import DEFAULT  # noqa: E402
from tracemill.plans.queries import QUERIES  # noqa: E402
from tracemill.session import build_session  # noqa: E402
from tracemill.sources.corpus import corpus  # noqa: E402

SWEEP = (None, 8, 20, 40)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    began = time.perf_counter()
    work()
    return round(time.perf_counter() - began, 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "tracemill-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "20g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in only:
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = timed(lambda: run(QUERIES[name](spark, sf_dir)))

    report = {
        "metric": "total query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if len(only) == len(QUERIES):
        files = corpus(spark, sf_dir)
        n_files, n_results = files.count(), extract.extract_results(files, DEFAULT).count()
        sweep = {
            str(n or "none"): timed(lambda: run(extract.extract_results(files, DEFAULT, n))) for n in SWEEP
        }
        report["partition_sweep"] = sweep
        report["files_per_sec"] = round(n_files / sweep["none"])
        report["results_per_sec"] = round(n_results / sweep["none"])
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
