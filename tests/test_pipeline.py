"""The whole run, from CSV files to CSV reports."""

from datetime import date

import pytest

from viewtide.operators.constraints import ConstraintViolation, assert_clean
from viewtide.operators.spread import find_splits
from viewtide.plans import pipeline
from viewtide.schemas import DENORM_COLUMNS, FACTS, step
from viewtide.sources.csv import TooManyRejects
from viewtide.sources.stages import read_stage, write_stage

AS_OF = date(2018, 6, 8)
META = """YT:a,UC1,10,2018-06-01 00:00:00,60
YT:b,UC2,20,2018-06-01 00:00:00,90
YT:c,UC2,20,2018-06-01 00:00:00,
"""
HISTORY = """"YT:a","10","1","","0",2018-06-01 10:00:00
"YT:a","4","1","","0",2018-06-02 10:00:00
"YT:a","12","1","","0",2018-06-03 11:00:00
"YT:b","2000","3","1","0",2018-06-01 10:30:00
"YT:b","2000","3","1","0",2018-06-02 10:30:00
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "meta.csv").write_text(META)
    (tmp_path / "history.csv").write_text(HISTORY)
    return tmp_path


@pytest.fixture
def run(spark, folder):
    def go(**options):
        src = {"meta": str(folder / "meta.csv"), "history": str(folder / "history.csv")}
        return pipeline.run(spark, src, str(folder / "out"), AS_OF, **options)

    return go


def report(folder, name):
    parts = sorted((folder / "out" / "reports" / name).glob("part-*.csv"))
    lines = [part.read_text().splitlines() for part in parts]
    return [lines[0][0], *[line for part in lines for line in part[1:]]]


def test_reports(folder, run):
    run()
    assert report(folder, "category_totals") == [
        "category_id,total_views,total_likes,total_dislikes,total_comments",
        "20,2000,3,1,0",
        "10,12,1,,0",
    ]
    assert report(folder, "view_bins") == [
        "count_videos,total_views_group,category_id", "1,1000.0,10", "1,10000.0,20",
    ]
    assert report(folder, "like_bins")[1:] == ["1,1000.0,10", "1,1000.0,20"]
    assert [line.split(",")[:4] for line in report(folder, "daily_average")[1:]] == [
        ["10", "2018-06-01", "10.0", "10"], ["10", "2018-06-03", "2.0", "2"], ["20", "2018-06-01", "2000.0", "2000"],
    ]
    assert [line.split(",")[:3] for line in report(folder, "hourly_totals")[1:]] == [
        ["20", "10", "2000"], ["10", "11", "12"], ["10", "10", "10"],
    ]


def test_a_second_run_replaces_the_first(spark, folder, run):
    run()
    before = {t: read_stage(spark, str(folder / "out"), t).count() for t in ("meta", "history", "denorm", "daily")}
    first = report(folder, "category_totals")
    seconds = run()
    assert before == {"meta": 3, "history": 5, "denorm": 3, "daily": 3}
    assert {t: read_stage(spark, str(folder / "out"), t).count() for t in before} == before
    assert report(folder, "category_totals") == first
    assert {"load", "denorm", "pre_agg", "report", "check_daily"} <= seconds.keys()


def test_restart_uses_the_earlier_stages(spark, folder, run):
    run()
    out = str(folder / "out")
    kept = read_stage(spark, out, "denorm")
    write_stage(spark.createDataFrame(kept.filter("gid = 'YT:a'").toArrow(), kept.schema), out, "denorm")
    seconds = pipeline.run(spark, None, out, AS_OF, from_stage="pre_agg")
    assert "load" not in seconds and "denorm" not in seconds
    assert len(report(folder, "category_totals")) == 2
    assert set(pipeline.run(spark, None, out, AS_OF, from_stage="report")) == {
        "report", *[f"report_{r}" for r in pipeline.build_reports(spark, out, AS_OF)]
    }


def test_unknown_stage(run):
    with pytest.raises(ValueError):
        run(from_stage="other")


def test_rejects_stop_the_run_unless_allowed(spark, folder, run):
    with (folder / "history.csv").open("a") as lines:
        lines.write("YT:a,many,1,1,1,2018-06-05 00:00:00\nYT:b,1\n")
    with pytest.raises(TooManyRejects, match="2 lines rejected"):
        run()
    run(max_rejects=2)
    rejected = read_stage(spark, str(folder / "out" / "rejects"), "history")
    assert sorted(r.reason for r in rejected.collect()) == ["views: not a bigint", "wrong number of fields"]
    assert read_stage(spark, str(folder / "out"), "history").count() == 5
    (folder / "history.csv").write_text(HISTORY)
    run()
    assert read_stage(spark, str(folder / "out" / "rejects"), "history").isEmpty()


def test_violations_stop_the_run(folder, run):
    (folder / "meta.csv").write_text(META + "YT:a,UC9,20,2018-06-01 00:00:00,1\n")
    with pytest.raises(ConstraintViolation, match="meta: 1 duplicate keys"):
        run()
    (folder / "meta.csv").write_text(META.replace("UC1,10", "UC1,"))
    with pytest.raises(ConstraintViolation, match="denorm: NULL in category_id"):
        run()
    run(check=False)


def test_no_start_behind_a_failed_stage(spark, folder, run):
    out = str(folder / "out")
    (folder / "history.csv").write_text(HISTORY + '"YT:b","2100","3","1","0",2018-06-02 10:30:00\n')
    with pytest.raises(ConstraintViolation, match="history: 1 duplicate keys"):
        run()
    for stage in ("denorm", "pre_agg", "report"):
        with pytest.raises(pipeline.UncheckedStage, match="load: started"):
            run(from_stage=stage)
    run(check=False)
    assert pipeline.marker(spark, out, "denorm") == "unchecked"
    with pytest.raises(pipeline.UncheckedStage, match="load: unchecked"):
        run(from_stage="report")
    (folder / "history.csv").write_text(HISTORY + "YT:b,1\n")
    with pytest.raises(TooManyRejects):
        run()
    with pytest.raises(pipeline.UncheckedStage):
        run(from_stage="denorm")
    (folder / "history.csv").write_text(HISTORY)
    run()
    assert {pipeline.marker(spark, out, s) for s in ("load", "denorm", "pre_agg")} == {"checked"}
    run(from_stage="report")
    with pytest.raises(pipeline.UncheckedStage, match="no marker"):
        pipeline.run(spark, None, str(folder / "none"), AS_OF, from_stage="report")


def test_the_key_of_denorm_is_checked(spark, folder, run):
    run()
    out = str(folder / "out")
    kept = read_stage(spark, out, "denorm")
    with pytest.raises(ConstraintViolation, match="denorm: 3 duplicate keys"):
        assert_clean(kept.union(kept), "denorm")


def test_large_videos_are_split_and_change_nothing(spark, folder, run):
    run()
    out = str(folder / "out")
    assert find_splits(read_stage(spark, out, "history"), rows_per_chunk=1).longest >= 2
    plain = {name: report(folder, name) for name in ("category_totals", "daily_average", "hourly_totals")}
    run(from_stage="denorm", rows_per_chunk=1)
    assert read_stage(spark, out, "denorm").columns == [*DENORM_COLUMNS, *map(step, FACTS)]
    assert {name: report(folder, name) for name in plain} == plain


def test_empty_inputs(spark, folder, run):
    (folder / "meta.csv").write_text("")
    (folder / "history.csv").write_text("")
    run()
    assert read_stage(spark, str(folder / "out"), "daily").isEmpty()


def test_layout_spreads_a_video_over_ordered_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("'a' as gid", "id as updated_at")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_stage(df, str(tmp_path), "t", sort_by=("gid", "updated_at"), layout=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = read_stage(spark, str(tmp_path), "t").selectExpr("_metadata.file_path as f", "updated_at")
    ranges = sorted((r.lo, r.hi) for r in files.groupBy("f").agg({"updated_at": "min"}).withColumnRenamed(
        "min(updated_at)", "lo").join(files.groupBy("f").agg({"updated_at": "max"}).withColumnRenamed(
        "max(updated_at)", "hi"), "f").collect())
    assert len(ranges) > 1
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
