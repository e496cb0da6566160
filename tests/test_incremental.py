"""Merged increments against a run over everything, and what a merge leaves untouched."""

import os
import random
from datetime import date, datetime, timedelta

import pytest

from viewtide.catalog import increments
from viewtide.operators import transform
from viewtide.operators.constraints import ConstraintViolation
from viewtide.plans import incremental
from viewtide.plans.pipeline import marker
from viewtide.sources import partitions
from viewtide.sources.stages import read_stage

META = "gid string, user_id string, category_id long, created_at timestamp, duration long"
HISTORY = "gid string, views long, likes long, dislikes long, comments long, updated_at timestamp"
BEGIN = datetime(2024, 1, 1)
TABLES = ("denorm", "daily", "latest")


def videos(spark, n=6, user="u"):
    return spark.createDataFrame([(f"v{k}", f"{user}{k}", k % 2, BEGIN, 10 + k) for k in range(n)], META)


def readings(seed, n=120, days=8, of=6):
    """Random readings of a few videos; times are unique per video."""
    rnd = random.Random(seed)
    seen = {}
    for _ in range(n):
        fact = lambda: rnd.choice([None, 0, 1, 2, 5, 9])
        key = f"v{min(rnd.randrange(of), rnd.randrange(of))}", BEGIN + timedelta(hours=rnd.randrange(24 * days))
        seen[key] = (key[0], fact(), fact(), fact(), fact(), key[1])
    return list(seen.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, HISTORY)


def full_run(spark, meta, rows):
    kept = transform.denorm(meta, frame(spark, rows), steps=True)
    return {"denorm": kept, "daily": transform.daily_from_steps(kept), "latest": transform.latest(kept)}


def same(spark, out, meta, rows):
    for table, expected in full_run(spark, meta, rows).items():
        got = read_stage(spark, out, table)
        assert set(got.columns) - {incremental.PART} == set(expected.columns)
        columns = expected.columns
        assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, expected.collect())), table


def file_times(out, table):
    return {
        os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, files in os.walk(os.path.join(out, table)) for f in files if f.endswith(".parquet")
    }


def upsert(rows, new):
    return list({(r[0], r[5]): r for r in [*rows, *new]}.values())


@pytest.mark.parametrize("seed, rows_per_chunk", [(1, 4_000_000), (2, 15)])
def test_random_increments_equal_a_full_run(spark, tmp_path, seed, rows_per_chunk):
    rnd = random.Random(seed)
    out, meta = str(tmp_path / "out"), videos(spark)
    rows = readings(seed)
    rnd.shuffle(rows)
    have = rows[:50]
    incremental.start(spark, out, videos(spark, 4, "old"), frame(spark, have), rows_per_chunk)
    for at in (50, 85) if seed == 1 else (85,):
        # New rows of any time, and other values for some that are there.
        new = rows[at : at + 35] + [(r[0], 7, None, 3, 4, r[5]) for r in rnd.sample(have, 8)]
        incremental.merge(spark, out, frame(spark, new), meta, rows_per_chunk)
        have = upsert(have, new)
        same(spark, out, meta, have)
    if seed == 1:
        incremental.merge(spark, out, frame(spark, new), meta, rows_per_chunk)
        same(spark, out, meta, have)


def test_rows_in_time_touch_only_their_days(spark, tmp_path):
    out, meta = str(tmp_path / "out"), videos(spark)
    at = lambda hours: BEGIN + timedelta(hours=hours)
    have = [(f"v{k % 3}", k, k, 0, 0, at(3 * k)) for k in range(32)]
    incremental.start(spark, out, meta, frame(spark, have))
    before = {t: file_times(out, t) for t in ("observations", "denorm", "daily")}
    new = [("v1", 90, 1, 0, 0, at(97)), ("v5", 90, 1, 0, 0, at(100))]
    incremental.merge(spark, out, frame(spark, new))
    same(spark, out, meta, have + new)
    for table, times in before.items():
        after = file_times(out, table)
        assert {f: t for f, t in after.items() if "2024-01-05" not in f} == times
    # A late one changes its own day and that of the next kept row, no other.
    before = {t: file_times(out, t) for t in ("denorm", "daily")}
    late = [("v0", 7, 7, 0, 0, at(20))]
    incremental.merge(spark, out, frame(spark, late))
    same(spark, out, meta, have + new + late)
    for table, times in before.items():
        changed = {f for f, t in file_times(out, table).items() if times.get(f) != t}
        assert {f.split("=")[1][:10] for f in changed} == {"2024-01-01", "2024-01-02"}


def test_a_day_left_without_kept_rows_goes(spark, tmp_path):
    out, meta = str(tmp_path / "out"), videos(spark, 1)
    rows = [("v0", 5, 0, 0, 0, BEGIN), ("v0", 9, 0, 0, 0, BEGIN + timedelta(days=1))]
    incremental.start(spark, out, meta, frame(spark, rows))
    again = [("v0", 5, 0, 0, 0, BEGIN + timedelta(days=1))]
    incremental.merge(spark, out, frame(spark, again))
    same(spark, out, meta, upsert(rows, again))
    assert partitions.partition_values(spark, out, "denorm") == ["2024-01-01"]


def test_a_broken_off_exchange_is_ended_later(spark, tmp_path, monkeypatch):
    out, meta, rows = str(tmp_path / "out"), videos(spark), readings(5)
    incremental.start(spark, out, meta, frame(spark, rows[:60]))
    done, move = [], incremental.move_partitions

    def fail(spark, directory, name, values, *more):
        if len(done) == 3:
            move(spark, directory, name, list(values)[:1], *more)
            raise OSError("lost")
        done.append(name)
        move(spark, directory, name, values, *more)

    monkeypatch.setattr(incremental, "move_partitions", fail)
    with pytest.raises(OSError):
        incremental.merge(spark, out, frame(spark, rows[60:90]))
    assert marker(spark, out, incremental.MERGE) == incremental.EXCHANGING
    monkeypatch.setattr(incremental, "move_partitions", move)
    incremental.merge(spark, out, frame(spark, rows[90:]))
    same(spark, out, meta, rows)


def test_purged_days_and_late_rows_after_them(spark, tmp_path):
    """Late rows still follow on what was purged; those of purged days are rejects."""
    out, meta, rows = str(tmp_path / "out"), videos(spark), readings(9, n=150)
    boundary = date(2024, 1, 4)
    new = [r for k, r in enumerate(rows) if k % 3 == 0]
    have = [r for r in rows if r not in new]
    incremental.start(spark, out, meta, frame(spark, have))
    later = {t: {f: v for f, v in file_times(out, t).items() if f.split("=")[1][:10] >= "2024-01-04"} for t in ("denorm", "daily")}
    gone = incremental.purge(spark, out, boundary, archive=str(tmp_path / "archive"))
    assert gone == [date(2024, 1, d) for d in (1, 2, 3)]
    assert {t: file_times(out, t) for t in later} == later
    incremental.merge(spark, out, frame(spark, new))
    too_late = [r for r in new if r[5].date() < boundary]
    expected = full_run(spark, meta, [r for r in rows if r not in too_late])
    for table in ("denorm", "daily"):
        got = read_stage(spark, out, table)
        left = expected[table].filter(f"day_updated_at >= date '{boundary}'")
        assert sorted(map(repr, got.select(left.columns).collect())) == sorted(map(repr, left.collect()))
    latest = read_stage(spark, out, "latest").select(expected["latest"].columns)
    assert sorted(map(repr, latest.collect())) == sorted(map(repr, expected["latest"].collect()))
    assert read_stage(spark, f"{out}/rejects", "late").count() == len(too_late) > 0
    assert partitions.partition_values(spark, str(tmp_path / "archive"), "denorm") == [f"2024-01-0{d}" for d in (1, 2, 3)]


def test_empty_increments_and_faulty_ones(spark, tmp_path):
    out, meta, rows = str(tmp_path / "out"), videos(spark), readings(3, n=20)
    with pytest.raises(ValueError):
        incremental.merge(spark, str(tmp_path / "none"), frame(spark, rows))
    incremental.start(spark, out, meta.limit(0), frame(spark, []))
    incremental.merge(spark, out, frame(spark, []), meta)
    incremental.merge(spark, out, frame(spark, rows))
    same(spark, out, meta, rows)
    with pytest.raises(ConstraintViolation):
        incremental.merge(spark, out, frame(spark, [rows[0], rows[0]]))
    same(spark, out, meta, rows)


def test_only_the_written_partitions_are_replaced(spark, tmp_path):
    out, days = str(tmp_path), [date(2024, 1, d) for d in (1, 2, 3)]
    frame_of = lambda rows: spark.createDataFrame(rows, "gid string, day_updated_at date")
    partitions.write_all_partitions(frame_of([("a", d) for d in days]), out, "t")
    before = file_times(out, "t")
    stored = read_stage(spark, out, "t").filter(f"day_updated_at = date '{days[1]}'")
    partitions.write_partitions(stored.union(frame_of([("b", days[1])])), out, "t", sort_by=("gid",))
    assert sorted(read_stage(spark, out, "t").collect()) == [("a", days[0]), ("a", days[1]), ("a", days[2]), ("b", days[1])]
    assert {f: t for f, t in file_times(out, "t").items() if "01-02" not in f} == {f: t for f, t in before.items() if "01-02" not in f}


def test_a_days_read_lists_only_its_folder(spark, tmp_path):
    out = str(tmp_path)
    df = spark.createDataFrame([(f"v{k}", date(2024, 1, 1 + k % 5)) for k in range(50)], "gid string, day_updated_at date")
    partitions.write_all_partitions(df, out, "t", sort_by=("gid",))
    day = partitions.read_days(spark, out, "t", date(2024, 1, 2), date(2024, 1, 2))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day_updated_at" in plan and day.count() == 10
    scan = day._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert len(day.inputFiles()) == 5
    assert scan.selectedPartitions().partitionCount() == 1
    assert partitions.purge(spark, out, "t", date(2024, 1, 3)) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert read_stage(spark, out, "t").count() == 30


def test_a_large_day_is_cut_into_several_files(spark, tmp_path):
    df = spark.range(300_000).selectExpr("uuid() as gid", "date '2024-01-01' + cast(id % 50 = 0 as int) as day_updated_at")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        partitions.write_all_partitions(df, str(tmp_path), "t", sort_by=("gid",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = [f for f in file_times(str(tmp_path), "t")]
    assert sum("=2024-01-01" in f for f in files) > 2 and read_stage(spark, str(tmp_path), "t").count() == 300_000


def test_running_totals_are_taken_once(spark, tmp_path):
    """The parts of the history are readings of one written table."""
    events = [(k, BEGIN + timedelta(hours=5 * k), k % 7, ("view", "click", "error")[k % 3], 10.0 * k, None) for k in range(150)]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(k, k % 3, "A") for k in range(7)], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    parts = [history for _, history in increments(spark, str(tmp_path))]
    for part in parts:
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Aggregate" not in plan
    assert all(part.count() for part in parts)


def test_differing_days(spark):
    """Rows that moved, changed, went or swapped a NULL with their neighbour; order alone is no difference."""
    one = [(1, 7, None, 1), (2, 8, 9, 1), (3, None, 5, 2), (4, 1, 1, 3), (5, 1, 1, 4), (6, 2, 2, 5), (7, 3, 3, 6)]
    other = [(2, 8, 9, 1), (1, 7, None, 1), (3, 5, None, 2), (5, 1, 1, 3), (4, 1, 1, 4), (7, 3, 3, 6), (8, 3, 3, 7)]
    table = lambda rows: spark.createDataFrame(rows, "gid long, views long, likes long, day int")
    found = incremental._differing(table(one), table(other), "day").select("day")
    assert sorted(r.day for r in found.collect()) == [2, 3, 4, 5, 7]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
