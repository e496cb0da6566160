"""Times the whole run and the reports, and prints one JSON line.

The inputs are written as CSV first, untimed. With the default BENCH_COPIES each video of
the test tables appears 40 times, under ids of its own, which makes 4.0 million
observations of 0.6 million videos from the tables at sf0.1. A run over an eighth of
the copies warms the JVM up.
"""

import json
import os
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

from viewtide import catalog, fixtures
from viewtide.plans import checks, pipeline
from viewtide.session import build_session
from viewtide.sources.stages import read_stage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
COPIES = int(os.environ.get("BENCH_COPIES", "40"))
REPEATS = 3


def write_inputs(spark, directory, copies):
    splits = fixtures.history_splits(spark, SF_DIR)
    paths = {table: f"{directory}/{table}.csv" for table in ("meta", "history")}
    fixtures.csv_meta(spark, SF_DIR, copies).repartition(CPUS).write.text(paths["meta"])
    fixtures.csv_history(spark, SF_DIR, splits, copies).repartition(CPUS).write.text(paths["history"])
    return paths


def timed(job):
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def fresh(query):
    """A new plan each time, so that none reuses another's shuffle files."""
    return query() if callable(query) else query.alias("q")


def together(queries):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda query: fresh(query).collect(), queries))


def main():
    spark = build_session("bench", {
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": str(CPUS),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    directory = tempfile.mkdtemp(prefix="viewtide-bench-")

    small = write_inputs(spark, f"{directory}/small", max(1, COPIES // 8))
    pipeline.run(spark, small, f"{directory}/small/out", catalog.AS_OF)
    full = write_inputs(spark, f"{directory}/full", COPIES)
    out = f"{directory}/full/out"
    phases = pipeline.run(spark, full, out, catalog.AS_OF)

    seconds = {f"phase_{name}": phases[name] for name in (
        "load", "load_checks", "denorm", "denorm_checks", "pre_agg", "pre_agg_checks", "report"
    )}
    total = sum(seconds.values())
    stage = {name: read_stage(spark, out, name) for name in ("meta", "history", "denorm")}
    queries = {
        **{f"report_{name}": report for name, report in pipeline.build_reports(spark, out, catalog.AS_OF).items()},
        "check_meta_without_history": checks.row_count(checks.meta_without_history(stage["meta"], stage["history"])),
        # Built anew each time, as it counts before it returns.
        "check_history_without_meta": lambda: checks.history_without_meta(stage["history"], stage["meta"]),
        "check_fact_decreased": checks.row_count(checks.fact_decreased(stage["denorm"])),
        "check_multi_updates_per_day": checks.multi_updates_per_day(stage["denorm"], limit=10),
        "check_updated_days": checks.updated_days(stage["denorm"]),
        "check_updates_per_video": checks.updates_per_video(stage["denorm"], limit=10),
        "check_changed_row_count": checks.changed_row_count(stage["denorm"]),
        "video_history": checks.video_history(stage["denorm"], "YT:08200000000"),
    }
    for name, query in queries.items():
        seconds[name] = min(timed(lambda: fresh(query).collect()) for _ in range(REPEATS))
    reports = [query for name, query in queries.items() if name.startswith("report_")]
    seconds["reports_together"] = min(timed(lambda: together(reports)) for _ in range(REPEATS))
    print(json.dumps({
        "metric": "whole run: load, denormalize, pre-aggregate, check and report",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "history_rows": stage["history"].count(),
        "meta_rows": stage["meta"].count(),
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
