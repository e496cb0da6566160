"""Every operator, report and check as a named query over the test tables."""

import posixpath
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide import fixtures
from viewtide.operators import transform
from viewtide.operators.constraints import duplicates, null_counts
from viewtide.operators.day_edges import daily_with_edges, with_day_edges
from viewtide.operators.quantiles import quantiles as group_quantiles
from viewtide.operators.spread import CHUNK, Splits
from viewtide.plans import checks, incremental, pipeline, reports, trends
from viewtide.schemas import CONSTRAINTS, HISTORY_COLUMNS
from viewtide.sources.csv import read_history, read_meta
from viewtide.sources.partitions import purge, read_days, write_all_partitions
from viewtide.sources.scratch import scratch_dir
from viewtide.sources.stages import read_report, read_stage, write_report, write_stage

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 31)
GID = 7
DAY = date(2024, 1, 6)
LAST_DAY = date(2024, 1, 9)
BIN_CAP = 1e6
MOMENT = datetime(2024, 1, 30, 12)


class Inputs:
    """The derived tables of one test data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, **limits: int):
        self.splits: Splits | None = fixtures.history_splits(spark, sf_dir, **limits)
        self.meta = fixtures.meta(spark, sf_dir)
        self.history = fixtures.history(spark, sf_dir, self.splits)

    def joined(self) -> DataFrame:
        return transform.denormalize(self.meta, self.history, self.splits)

    def diffs(self) -> DataFrame:
        return transform.with_diffs(self.joined())

    def denorm(self, mode: str = "increase") -> DataFrame:
        return transform.denorm(self.meta, self.history, self.splits, mode)

    def latest(self) -> DataFrame:
        return transform.latest(self.denorm())

    def daily(self) -> DataFrame:
        return transform.daily(self.denorm(), splits=None)

    def orphaned(self) -> DataFrame:
        """The history, with about every tenth observation under an id no video has."""
        unused = F.when(F.col("views") % 10 == 3, -1 - F.col("gid")).otherwise(F.col("gid"))
        return self.history.withColumn("gid", unused)


def queries() -> dict[str, Query]:
    return {
        **{name: _on_inputs(build) for name, build in _BY_INPUTS.items()},
        **{f"{name}_split": _on_inputs(_BY_INPUTS[name], rows_per_chunk=_FORCED) for name in _SPLIT},
        "load_meta": load_meta,
        "load_history": load_history,
        "load_rejects": load_rejects,
        "load_providers": load_providers,
        "load_provider_rejects": load_provider_rejects,
        "stage_roundtrip": stage_roundtrip,
        "stage_layout": stage_layout,
        "report_csv": report_csv,
        "pipeline_category_totals": pipeline_category_totals,
        "pipeline_daily_average": pipeline_daily_average,
        "pipeline_restart": pipeline_restart,
        "incremental_denorm": lambda spark, sf_dir: incremental_table(spark, sf_dir, "denorm"),
        "incremental_latest": lambda spark, sf_dir: incremental_table(spark, sf_dir, "latest", at_once=True),
        "incremental_daily": lambda spark, sf_dir: incremental_table(spark, sf_dir, "daily", at_once=True),
        "days_read": days_read,
        "days_purged": days_purged,
    }


def _with_repeats(df: DataFrame, column: str) -> DataFrame:
    """All rows, and those whose number ends in 3 twice."""
    return df.withColumn("again", F.explode(F.when(F.col(column) % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    ))).drop("again")


def _rounded(df: DataFrame) -> DataFrame:
    """Quantiles to six digits, as the last bits depend on the order of two products."""
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith("p")})


_BY_INPUTS: dict[str, Callable[[Inputs], DataFrame]] = {
    # Transforms
    "denorm_join": lambda i: i.joined(),
    "change_diffs": lambda i: i.diffs(),
    "change_only_rows": lambda i: i.denorm(),
    "change_only_rows_any": lambda i: i.denorm(mode="any"),
    "latest_per_video": lambda i: i.latest(),
    "daily_increments": lambda i: i.daily(),
    # Reports
    "report_category_totals": lambda i: reports.category_totals(i.latest()),
    "report_daily_average": lambda i: reports.daily_average(i.daily()),
    "report_view_bins": lambda i: reports.view_bins(i.latest()),
    "report_view_bins_capped": lambda i: reports.view_bins(i.latest(), cap=BIN_CAP),
    "report_like_bins": lambda i: reports.like_bins(i.latest()),
    "report_hourly_totals": lambda i: reports.hourly_totals(i.denorm(), AS_OF),
    "report_hourly_increments": lambda i: reports.hourly_totals(i.denorm(), AS_OF, measure="increment"),
    "report_hourly_totals_of_hours": lambda i: reports.hourly_totals_of(reports.hour_table(i.denorm()), AS_OF),
    "report_hourly_increments_of_hours": lambda i: reports.hourly_totals_of(
        reports.hour_table(i.denorm()), AS_OF, measure="increment"
    ),
    "report_trending_videos": lambda i: trends.trending(i.denorm(), MOMENT, k=5),
    "report_trending_users": lambda i: trends.trending(i.denorm(), MOMENT, k=3, by="user_id", fact="likes"),
    "report_view_quantiles": lambda i: _rounded(group_quantiles(i.latest(), "category_id", "views")),
    "report_comment_quantiles": lambda i: _rounded(group_quantiles(i.latest(), "category_id", "comments")),
    "report_fact_correlation": lambda i: reports.fact_correlation(i.latest()),
    "day_edges": lambda i: with_day_edges(i.history.drop(CHUNK), i.splits),
    "daily_with_edges": lambda i: daily_with_edges(i.history.drop(CHUNK), i.splits),
    # Checks
    "check_meta_without_history": lambda i: checks.meta_without_history(i.meta, i.history),
    "check_meta_without_history_first": lambda i: checks.meta_without_history(i.meta, i.history, limit=10),
    "check_history_without_meta": lambda i: checks.history_without_meta(
        i.orphaned().drop(CHUNK), i.meta, splits=i.splits
    ),
    "check_history_without_meta_first": lambda i: checks.history_without_meta(
        i.orphaned().drop(CHUNK), i.meta, limit=10, splits=i.splits
    ),
    "check_fact_decreased": lambda i: checks.fact_decreased(i.denorm()),
    "check_multi_updates_per_day": lambda i: checks.multi_updates_per_day(i.denorm(), limit=10),
    "check_created_days": lambda i: checks.created_days(i.denorm()),
    "check_updated_days": lambda i: checks.updated_days(i.denorm()),
    "check_updates_per_video": lambda i: checks.updates_per_video(i.denorm(), limit=10),
    "check_row_count": lambda i: checks.row_count(i.denorm()),
    "check_changed_row_count": lambda i: checks.changed_row_count(i.denorm(), splits=None),
    "check_changed_row_count_unfiltered": lambda i: checks.changed_row_count(i.joined(), splits=None),
    "video_history": lambda i: checks.video_history(i.denorm(), GID),
    "video_day_history": lambda i: checks.video_day_history(i.denorm(), GID, DAY),
    "check_pk_duplicates": lambda i: duplicates(i.denorm(), CONSTRAINTS["daily"].key),
    "check_pk_duplicates_history": lambda i: duplicates(i.history, CONSTRAINTS["history"].key),
    "check_pk_duplicates_history_found": lambda i: duplicates(
        _with_repeats(i.history, "views"), CONSTRAINTS["history"].key
    ),
    "check_pk_duplicates_meta_found": lambda i: duplicates(_with_repeats(i.meta, "gid"), CONSTRAINTS["meta"].key),
    "check_pk_duplicates_denorm_found": lambda i: duplicates(
        _with_repeats(i.denorm(), "views"), CONSTRAINTS["denorm"].key
    ),
    "check_pk_duplicates_latest_found": lambda i: duplicates(
        _with_repeats(i.latest(), "gid"), CONSTRAINTS["latest"].key
    ),
    "check_pk_duplicates_daily_found": lambda i: duplicates(
        _with_repeats(i.daily(), "gid"), CONSTRAINTS["daily"].key
    ),
    "history_lookup": lambda i: checks.video_history(i.history, GID),
    "check_not_null": lambda i: null_counts(i.history, HISTORY_COLUMNS),
    "check_not_null_latest": lambda i: null_counts(i.latest(), HISTORY_COLUMNS),
}

# The same queries with every video cut into chunks, which normally only a video far
# larger than those of the test tables would be.
_FORCED = 40
_SPLIT = ("denorm_join", "change_diffs", "change_only_rows", "latest_per_video", "daily_increments", "day_edges", "daily_with_edges")


def _on_inputs(build: Callable[[Inputs], DataFrame], **limits: int) -> Query:
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir, **limits)).drop(CHUNK)


def _write_lines(lines: DataFrame, directory: str, name: str) -> str:
    path = posixpath.join(directory, f"{name}.csv")
    lines.write.text(path)
    return path


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without a zone, as in the test tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def load_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_lines(fixtures.csv_meta(spark, sf_dir), scratch_dir(spark), "meta")
    good, _ = read_meta(spark, path)
    return _naive(good, "created_at")


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits = fixtures.history_splits(spark, sf_dir)
    path = _write_lines(fixtures.csv_history(spark, sf_dir, splits), scratch_dir(spark), "history")
    good, _ = read_history(spark, path)
    return _naive(good, "updated_at")


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_lines(fixtures.csv_history_with_rejects(spark, sf_dir), scratch_dir(spark), "history")
    _, rejected = read_history(spark, path)
    return rejected


def _load_providers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = _write_lines(fixtures.csv_history_of_providers(spark, sf_dir), scratch_dir(spark), "history")
    return read_history(spark, path, providers=True)


def load_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations per provider and video id."""
    good, _ = _load_providers(spark, sf_dir)
    return transform.with_provider(good).groupBy("provider_id", "video_id").agg(F.count("*").alias("rows"))


def load_provider_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = _load_providers(spark, sf_dir)
    return rejected


def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch_dir(spark)
    write_stage(Inputs(spark, sf_dir).daily(), directory, "daily", sort_by=CONSTRAINTS["daily"].key)
    return read_stage(spark, directory, "daily")


def stage_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch_dir(spark)
    kept = Inputs(spark, sf_dir).denorm().drop(CHUNK)
    write_stage(kept, directory, "denorm", sort_by=CONSTRAINTS["denorm"].key, layout=True)
    return read_stage(spark, directory, "denorm")


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch_dir(spark)
    report = reports.daily_average(Inputs(spark, sf_dir).daily())
    write_report(report, directory, "daily_average")
    return read_report(spark, directory, "daily_average", report.schema)


def _run_pipeline(spark: SparkSession, sf_dir: str) -> str:
    directory = scratch_dir(spark)
    splits = fixtures.history_splits(spark, sf_dir)
    src = {
        "meta": _write_lines(fixtures.csv_meta(spark, sf_dir), directory, "meta"),
        "history": _write_lines(fixtures.csv_history(spark, sf_dir, splits), directory, "history"),
    }
    out = posixpath.join(directory, "out")
    pipeline.run(spark, src, out, AS_OF)
    return out


def _pipeline_report(spark: SparkSession, out: str, name: str) -> DataFrame:
    schema = pipeline.build_reports(spark, out, AS_OF)[name].schema
    return read_report(spark, posixpath.join(out, "reports"), name, schema)


def pipeline_category_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pipeline_report(spark, _run_pipeline(spark, sf_dir), "category_totals")


def pipeline_daily_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pipeline_report(spark, _run_pipeline(spark, sf_dir), "daily_average")


def pipeline_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the later phases again, from the stages an earlier run left."""
    out = _run_pipeline(spark, sf_dir)
    pipeline.run(spark, None, out, AS_OF, from_stage="pre_agg")
    return _pipeline_report(spark, out, "hourly_totals")


def increments(spark: SparkSession, sf_dir: str) -> tuple[tuple[DataFrame, DataFrame], ...]:
    """(meta, history) as they would come in three parts.

    The second brings the days from the 20th on, videos unknown before and videos with
    corrected attributes; the third the days from the 25th on, observations of all days
    that come late, and corrected readings.
    """
    inputs = Inputs(spark, sf_dir)
    # Written once, as each part is a reading of it and the running totals take a window.
    directory = scratch_dir(spark)
    write_stage(inputs.history, directory, "history")
    history = read_stage(spark, directory, "history")
    day, hour = F.dayofmonth("updated_at"), F.hour("updated_at")
    late = (F.col("gid") % 4 == 1) & (hour == 7)
    wrong = (F.col("gid") % 7 == 2) & (hour == 11)
    on_time = history.filter(~late).withColumn("views", F.when(wrong, F.col("views") + 5000).otherwise(F.col("views")))
    meta = inputs.meta
    first_meta = meta.filter("gid % 10 <> 9").withColumn(
        "duration", F.when(F.col("gid") % 11 == 0, 1).otherwise(F.col("duration")).cast("bigint")
    )
    return (
        (first_meta, on_time.filter(day < 20)),
        (meta, on_time.filter((day >= 20) & (day < 25))),
        (meta, history.filter(late | wrong | (day >= 25))),
    )


def incremental_table(spark: SparkSession, sf_dir: str, name: str, at_once: bool = False) -> DataFrame:
    """A table of a first load and two merged increments, or both of them merged at once."""
    out = scratch_dir(spark)
    (meta, history), *more = increments(spark, sf_dir)
    if at_once:
        (_, second), (last_meta, third) = more
        more = [(last_meta, third.unionByName(second.join(third, ["gid", "updated_at"], "left_anti")))]
    incremental.start(spark, out, meta, history)
    for meta, history in more:
        incremental.merge(spark, out, history, meta)
    rows = read_stage(spark, out, name)
    return rows.drop(incremental.PART, *[c for c in rows.columns if c.endswith("_step")])


def days_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily increments of a few days, from a table cut by day."""
    directory = scratch_dir(spark)
    write_all_partitions(Inputs(spark, sf_dir).daily(), directory, "daily", sort_by=("gid",))
    return read_days(spark, directory, "daily", DAY, LAST_DAY)


def days_purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept observations that are left after older days were moved into an archive."""
    directory = scratch_dir(spark)
    write_all_partitions(Inputs(spark, sf_dir).denorm().drop(CHUNK), directory, "denorm", sort_by=("gid", "updated_at"))
    purge(spark, directory, "denorm", LAST_DAY, archive=posixpath.join(directory, "archive"))
    return read_stage(spark, directory, "denorm")
