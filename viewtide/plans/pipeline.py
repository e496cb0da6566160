"""The whole run: load, denormalize, pre-aggregate, report."""

import logging
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial, reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewtide.operators.constraints import assert_clean
from viewtide.operators.spread import CHUNK, ROWS_PER_CHUNK, find_splits
from viewtide.operators.transform import REPEATED, daily_from_steps, denorm, latest
from viewtide.plans import reports
from viewtide.schemas import CONSTRAINTS, VIDEO
from viewtide.sources.csv import REJECTED, check_rejects, good_rows, parse, rejects
from viewtide.sources.stages import REJECTS, REPORTS, read_stage, stage_path, write_report, write_stage

log = logging.getLogger(__name__)

# Tables have no phase of their own to create them: their columns are declared in
# `schemas`. Starting from "model" is starting from the beginning.
STAGES = ("model", "load", "denorm", "pre_agg", "report")

# What the marker of a stage in the output folder says of its tables.
MARKERS = "markers"
STARTED, CHECKED, UNCHECKED = "started", "checked", "unchecked"


class UncheckedStage(Exception):
    """A run was to start behind a stage that did not end with clean tables."""


def run(
    spark: SparkSession,
    src: dict[str, str] | None,
    out: str,
    as_of: date,
    from_stage: str | None = None,
    max_rejects: int = 0,
    check: bool = True,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> dict[str, float]:
    """Run the stages from `from_stage` on, and return how long each job took, in seconds.

    `src` gives the paths of the "meta" and "history" CSV files; it is needed only if the
    load runs. Jobs replace their output below `out`, so a run can be repeated, and a
    failing job ends the run. Each stage leaves a marker: "started" until its jobs and
    checks are done, then "checked", or "unchecked" with `check=False`. A run does not start
    behind a stage that is not checked, unless `check=False` says so. Videos with more than
    `rows_per_chunk` observations are worked on in several tasks.
    """
    seconds: dict[str, float] = {}
    stages = STAGES[STAGES.index(from_stage or STAGES[0]):]

    def phase(name: str, jobs: dict[str, Callable[[], None]]) -> None:
        start = time.perf_counter()
        _together(jobs, seconds)
        seconds[name] = time.perf_counter() - start
        log.info("%s took %.1f s", name, seconds[name])

    # Tables that were seen to be clean while they were written.
    clean: set[str] = set()

    def checks(name: str, *tables: str) -> None:
        if check:
            phase(f"{name}_checks", {
                f"check_{t}": (lambda: None) if t in clean else partial(_check, spark, out, t) for t in tables
            })
        mark(spark, out, name, CHECKED if check else UNCHECKED)

    written = [s for s in ("load", "denorm", "pre_agg") if s in stages]
    for stage in ("load", "denorm", "pre_agg"):
        if stage in written:
            mark(spark, out, stage, STARTED)
        elif check and (state := marker(spark, out, stage)) != CHECKED:
            raise UncheckedStage(f"{stage}: {state or 'no marker'}; run it again, or start with check=False")

    if "load" in stages:
        phase("load", {f"load_{t}": partial(load, spark, src[t], out, t, max_rejects) for t in ("meta", "history")})
        checks("load", "meta", "history")
    if "denorm" in stages:
        def write() -> None:
            if write_denorm(spark, out, rows_per_chunk) and marker(spark, out, "load") == CHECKED:
                clean.add("denorm")

        phase("denorm", {"write_denorm": write})
        checks("denorm", "denorm")
    if "pre_agg" in stages:
        phase("pre_agg", {
            "write_latest": partial(write_latest, spark, out),
            "write_daily": partial(write_daily, spark, out),
            "write_hours": partial(write_hours, spark, out),
        })
        checks("pre_agg", "latest", "daily")
    if "report" in stages:
        directory = stage_path(out, REPORTS)
        phase("report", {
            f"report_{name}": partial(write_report, report, directory, name)
            for name, report in build_reports(spark, out, as_of).items()
        })
    return seconds


def _together(jobs: dict[str, Callable[[], None]], seconds: dict[str, float]) -> None:
    """Submit independent Spark jobs at once, so that one fills the cores another leaves."""

    def timed(name: str) -> None:
        start = time.perf_counter()
        jobs[name]()
        seconds[name] = time.perf_counter() - start

    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(timed, name) for name in jobs]:
            done.result()


def mark(spark: SparkSession, out: str, stage: str, state: str) -> None:
    marked = spark.createDataFrame([(state,)], "state string")
    write_stage(marked.coalesce(1), stage_path(out, MARKERS), stage)


def marker(spark: SparkSession, out: str, stage: str) -> str | None:
    """What the stage's marker says; None without a marker."""
    try:
        found = spark.read.schema("state string").parquet(stage_path(stage_path(out, MARKERS), stage)).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found and found.state


def _check(spark: SparkSession, out: str, table: str) -> None:
    assert_clean(read_stage(spark, out, table), table)


def load(spark: SparkSession, path: str, out: str, table: str, max_rejects: int = 0) -> None:
    """Load one CSV input. Rejects are counted while the good rows are written, and the
    input is read a second time only if there are any."""
    parsed = parse(spark, path, table)
    seen = Observation()
    counted = parsed.observe(seen, F.count_if(REJECTED).alias("rejected"))
    write_stage(good_rows(counted, table), out, table)
    bad = rejects(parsed, table)
    rejects_dir = stage_path(out, REJECTS)
    # Nothing is observed in an input without lines.
    if not parsed.isEmpty() and seen.get["rejected"]:
        write_stage(bad, rejects_dir, table)
        check_rejects(read_stage(spark, rejects_dir, table), max_rejects)
    else:
        write_stage(spark.createDataFrame([], bad.schema), rejects_dir, table)


def write_denorm(spark: SparkSession, out: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> bool:
    """The files inherit the layout of the windows: rows of a video lie together, sorted
    by time. The steps are stored so that the daily increments need no window.

    Returns whether the table was seen to keep its constraints, from the neighbours in
    those windows, provided that each video is there once.
    """
    history = read_stage(spark, out, "history")
    splits = find_splits(history, rows_per_chunk=rows_per_chunk)
    kept = denorm(read_stage(spark, out, "meta"), history, splits, steps=True, repeats=True)
    missing = reduce(or_, [F.col(c).isNull() for c in CONSTRAINTS["denorm"].not_null])
    seen = Observation()
    faults = kept.observe(seen, F.count_if(F.col(REPEATED) | missing).alias("faults"))
    write_stage(faults.drop(CHUNK, REPEATED), out, "denorm")
    # Nothing is observed in a table without rows.
    return not history.isEmpty() and seen.get.get("faults") == 0


def write_latest(spark: SparkSession, out: str) -> None:
    write_stage(latest(read_stage(spark, out, "denorm")), out, "latest", sort_by=VIDEO)


def write_daily(spark: SparkSession, out: str) -> None:
    steps = daily_from_steps(read_stage(spark, out, "denorm"))
    write_stage(steps, out, "daily", sort_by=(*VIDEO, "day_updated_at"))


def write_hours(spark: SparkSession, out: str) -> None:
    """A few rows per day, in one file."""
    write_stage(reports.hour_table(read_stage(spark, out, "denorm")).coalesce(1), out, "hours")


def build_reports(spark: SparkSession, out: str, as_of: date) -> dict[str, DataFrame]:
    """The reports over the written stages, not yet run."""
    latest_videos = read_stage(spark, out, "latest")
    return {
        "category_totals": reports.category_totals(latest_videos),
        "daily_average": reports.daily_average(read_stage(spark, out, "daily")),
        "view_bins": reports.view_bins(latest_videos),
        "like_bins": reports.like_bins(latest_videos),
        "hourly_totals": reports.hourly_totals_of(read_stage(spark, out, "hours"), as_of),
    }
