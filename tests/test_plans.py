"""The physical plans: shuffles, pushdown, pruning, hashing."""

import re

import pytest

from viewtide import catalog, fixtures
from viewtide.operators import transform
from viewtide.operators.spread import find_splits
from viewtide.plans import checks, pipeline, reports
from viewtide.sources.stages import read_stage, write_stage

SF = "/root/testdata/sf0.001"


def plan(df):
    """The initial physical plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def exchanges(df):
    return re.findall(r"Exchange (\w+)", plan(df))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Stages on disk, with joins kept from broadcasting, as at scale."""
    out = str(tmp_path_factory.mktemp("stages"))
    write_stage(fixtures.meta(spark, SF), out, "meta")
    write_stage(fixtures.history(spark, SF), out, "history")
    pipeline.write_denorm(spark, out)
    pipeline.write_latest(spark, out)
    pipeline.write_daily(spark, out)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: read_stage(spark, out, name) for name in ("meta", "history", "denorm", "latest", "daily")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_denorm_shuffles_and_sorts_each_input_once(stages):
    df = transform.denorm(stages["meta"], stages["history"], steps=True)
    assert exchanges(df) == ["hashpartitioning", "hashpartitioning"]
    assert len(re.findall(r"\bSort \[", plan(df))) == 2
    # The hour and the attributes come after the shuffle.
    shuffled = plan(df).split("Exchange")[1]
    assert "hour(" not in shuffled


def test_daily_and_latest_share_the_windows_shuffle(stages):
    kept = transform.denorm(stages["meta"], stages["history"])
    assert len(exchanges(transform.daily(kept))) == 2
    assert len(exchanges(transform.latest(kept))) == 2


def test_split_denorm_broadcasts_only_tables_bounded_by_the_chunks(stages):
    splits = find_splits(stages["history"], rows_per_chunk=20)
    text = plan(transform.denorm(stages["meta"], stages["history"], splits))
    for branch in text.split("BroadcastExchange")[1:]:
        assert re.search(r"LocalTableScan|Window \[lag", branch.split("FileScan")[0])
    assert re.search(r"hashpartitioning\(gid#\d+L, _chunk#\d+", text)
    # The join does not search for the chunk once more to test it for NULL.
    assert "isnotnull(aggregate" not in text


def test_reductions_hash_before_their_shuffle(stages):
    for df in (transform.latest(stages["denorm"]), transform.daily_from_steps(stages["denorm"])):
        text = plan(df)
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
        assert text.count("HashAggregate") == 2 and len(exchanges(df)) == 1


def test_no_window_for_daily_from_steps(stages):
    assert "Window" not in plan(transform.daily_from_steps(stages["denorm"]))


@pytest.mark.parametrize("name, source, columns", [
    ("category_totals", "latest", {"category_id", "views", "likes", "dislikes", "comments"}),
    ("view_bins", "latest", {"category_id", "views"}),
    ("like_bins", "latest", {"category_id", "likes"}),
])
def test_reports_read_only_their_columns(stages, name, source, columns):
    text = plan(getattr(reports, name)(stages[source]))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {field.split(":")[0] for field in read.split(",")} == columns
    assert text.count("HashAggregate") == 2


def test_time_bound_reaches_the_scan(stages):
    text = plan(reports.hourly_totals(stages["denorm"], catalog.AS_OF))
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at,2024-01-24T00:00)]" in text


def test_lookup_reaches_the_scan(stages):
    assert "EqualTo(gid,7)" in plan(checks.video_history(stages["denorm"], 7))


def test_orphan_checks_reduce_observations_before_the_shuffle(stages):
    text = plan(checks.meta_without_history(stages["meta"], stages["history"]))
    assert "LeftAnti" in text
    history = text[text.index("HashAggregate"):]
    assert history.count("HashAggregate") == 2
    text = plan(checks.history_without_meta(stages["history"], stages["meta"]))
    assert text.count("LeftAnti") == 1
    assert len(re.findall(r"FileScan parquet", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 2


def test_top_lists_do_not_sort_everything(stages):
    assert "TakeOrderedAndProject" in plan(checks.updates_per_video(stages["denorm"], limit=10))
    assert "TakeOrderedAndProject" in plan(checks.multi_updates_per_day(stages["denorm"], limit=10))


@pytest.mark.parametrize("name", [n for n in catalog.queries() if not n.startswith(("load", "stage", "pipeline", "report_csv"))])
def test_everything_stays_in_the_jvm(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", text)
