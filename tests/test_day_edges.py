"""Rows at midnight and increments cut there, by hand and against a loop."""

import random
from datetime import date, datetime, timedelta

import pytest

from viewtide.operators.day_edges import daily_with_edges, with_day_edges
from viewtide.operators.spread import find_splits

SCHEMA = "gid string, views long, likes long, dislikes long, comments long, updated_at timestamp"


def frame(spark, rows):
    return spark.createDataFrame([(g, v, v, None, 0, t) for g, v, t in rows], SCHEMA)


def test_one_midnight(spark):
    df = frame(spark, [("1", 10, datetime(2019, 1, 1, 23)), ("1", 20, datetime(2019, 1, 2, 1))])
    edge = with_day_edges(df).filter("generated").collect()
    assert [(r.views, r.dislikes, r.updated_at) for r in edge] == [(15, None, datetime(2019, 1, 2))]
    assert sorted((r.day_updated_at, r.views) for r in daily_with_edges(df).collect()) == [
        (date(2019, 1, 1), 15), (date(2019, 1, 2), 5)]


def test_gap_of_days_and_rows_at_midnight(spark):
    df = frame(spark, [("1", 0, datetime(2019, 1, 1)), ("1", 30, datetime(2019, 1, 4)), ("1", 29, datetime(2019, 1, 4, 12))])
    edges = with_day_edges(df).filter("generated").collect()
    assert sorted((r.updated_at.day, r.views) for r in edges) == [(2, 10), (3, 20)]
    assert sorted((r.day_updated_at.day, r.views) for r in daily_with_edges(df).collect()) == [(1, 10), (2, 10), (3, 10), (4, -1)]


def test_missing_totals_have_no_line(spark):
    at = [datetime(2019, 1, d, 12) for d in (1, 2, 3)]
    df = frame(spark, [("1", 4, at[0]), ("1", None, at[1]), ("1", 9, at[2])])
    assert [r.views for r in with_day_edges(df).filter("generated").collect()] == [None, None]
    assert sorted((r.day_updated_at.day, r.views) for r in daily_with_edges(df).collect()) == [(1, 4), (2, None), (3, 9)]


@pytest.mark.parametrize("rows_per_chunk", [None, 20])
def test_days_add_up_to_the_last_total(spark, rows_per_chunk):
    rnd, rows, last = random.Random(4), [], {}
    for g in range(5):
        for hour in sorted(rnd.sample(range(24 * 30), 15 if g else 150)):
            last[f"v{g}"] = last.get(f"v{g}", 0) + rnd.randrange(-3, 1000)
            rows.append((f"v{g}", last[f"v{g}"], datetime(2024, 1, 1) + timedelta(hours=hour, minutes=rnd.randrange(60))))
    df = frame(spark, rows)
    splits = rows_per_chunk and find_splits(df, rows_per_chunk=rows_per_chunk)
    days = daily_with_edges(df, splits or None).collect()
    sums = {}
    for r in days:
        sums[r.gid] = sums.get(r.gid, 0) + r.views
    assert sums == last and len(days) == len({(r.gid, r.day_updated_at) for r in days})
    for g in last:
        mine = sorted(t.date() for v, _, t in rows if v == g)
        assert {r.day_updated_at for r in days if r.gid == g} == {
            mine[0] + timedelta(days=k) for k in range((mine[-1] - mine[0]).days + 1)}


def test_no_rows(spark):
    assert with_day_edges(frame(spark, [])).collect() == [] and daily_with_edges(frame(spark, [])).collect() == []
