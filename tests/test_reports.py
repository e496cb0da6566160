from datetime import date, datetime

import pytest

from viewtide.plans import reports
from viewtide.schemas import FACTS


def latest_of(spark, *rows):
    """Latest rows (category, views, likes)."""
    data = [(c, v, l, 0, 0) for c, v, l in rows]
    return spark.createDataFrame(data, "category_id bigint, views bigint, likes bigint, dislikes bigint, comments bigint")


def test_category_totals_skip_missing_facts_and_order_by_views(spark):
    totals = reports.category_totals(latest_of(spark, (10, 5, 1), (20, 9, None), (10, None, 2), (20, 1, None)))
    assert [tuple(r)[:3] for r in totals.collect()] == [(20, 10, None), (10, 5, 3)]
    assert totals.columns == ["category_id", *[f"total_{f}" for f in FACTS]]


@pytest.mark.parametrize("views, group", [
    (None, 1e3), (0, 1e3), (-5, 1e3), (1, 1e3), (1000, 1e3), (1001, 1e4), (10_000, 1e4), (10_001, 1e5),
    (1_000_000, 1e6), (1_000_001, 1e7), (10**12, 1e12),
])
def test_bins_include_their_upper_bound(spark, views, group):
    assert reports.view_bins(latest_of(spark, (10, views, 0))).first().total_views_group == group


def test_cap_merges_the_highest_bins(spark):
    latest = latest_of(spark, (10, 5_000_000, 0), (10, 50_000_000, 0), (10, 500, 0))
    assert [tuple(r) for r in reports.view_bins(latest, cap=1e7).collect()] == [(1, 1e3, 10), (2, 1e7, 10)]


def test_bins_per_category_count_every_video(spark):
    latest = latest_of(spark, (10, 5, 5), (20, 5, 5000), (10, 50_000, 1), (10, None, None))
    assert [tuple(r) for r in reports.view_bins(latest).collect()] == [(2, 1e3, 10), (1, 1e3, 20), (1, 1e5, 10)]
    assert [tuple(r) for r in reports.like_bins(latest).collect()] == [(3, 1e3, 10), (1, 1e4, 20)]


def test_daily_average_skips_missing_increments(spark):
    daily = spark.createDataFrame(
        [(10, date(2024, 1, 1), 4, 1, 1, None, 60), (10, date(2024, 1, 1), 7, 1, 1, 6, 30),
         (10, date(2024, 1, 2), 1, 1, 1, None, None)],
        "category_id bigint, day_updated_at date, views bigint, likes bigint, dislikes bigint, "
        "comments bigint, duration bigint",
    )
    first, second = reports.daily_average(daily).collect()
    assert (first.avg_views, first.max_views, first.avg_comments, first.avg_duration) == (5.5, 7, 6.0, 45.0)
    assert (second.avg_views, second.avg_comments, second.max_duration) == (1.0, None, None)


@pytest.fixture
def hours(spark):
    data = [
        (10, 3, datetime(2024, 1, 24, 3), 100, 5),
        (10, 0, datetime(2024, 1, 24, 0), 900, 9),  # exactly at the bound
        (10, 3, datetime(2024, 1, 26, 3), 110, 10),
        (20, 3, datetime(2024, 1, 26, 3), 50, 50),
    ]
    rows = [(c, h, t, v, 0, 0, 0, d, 0, 0, 0) for c, h, t, v, d in data]
    return spark.createDataFrame(
        rows,
        "category_id bigint, hour bigint, updated_at timestamp, views bigint, likes bigint, dislikes bigint, "
        "comments bigint, views_diff bigint, likes_diff bigint, dislikes_diff bigint, comments_diff bigint",
    )


def test_hourly_totals_add_running_totals_after_the_bound(hours):
    got = reports.hourly_totals(hours, date(2024, 1, 31)).collect()
    assert [tuple(r)[:3] for r in got] == [(10, 3, 210), (20, 3, 50)]


def test_hourly_increments(hours):
    got = reports.hourly_totals(hours, date(2024, 1, 31), measure="increment").collect()
    assert [tuple(r)[:3] for r in got] == [(20, 3, 50), (10, 3, 15)]
    with pytest.raises(ValueError):
        reports.hourly_totals(hours, date(2024, 1, 31), measure="other")


def test_hourly_totals_of_other_spans(hours):
    got = reports.hourly_totals(hours, date(2024, 1, 31), days=8).collect()
    assert [tuple(r)[:3] for r in got] == [(10, 0, 900), (10, 3, 210), (20, 3, 50)]
