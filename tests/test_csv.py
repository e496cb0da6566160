"""Loading of well and badly formed lines."""

from datetime import datetime

import pytest

from viewtide.sources.csv import TooManyRejects, check_rejects, read_history, read_meta


@pytest.fixture
def load(spark, tmp_path):
    def read(reader, *lines):
        (tmp_path / "input.csv").write_text("\n".join(lines) + "\n")
        good, rejects = reader(spark, str(tmp_path / "input.csv"))
        return [tuple(r) for r in good.collect()], [tuple(r) for r in rejects.collect()]

    return read


def test_quoted_and_missing_integers(load):
    good, rejects = load(read_history, '"YT:a","10","","2","",2018-06-01 01:00:00', "YT:b,5,,,7,2018-06-01 02:00:00")
    assert good == [
        ("YT:a", 10, None, 2, None, datetime(2018, 6, 1, 1)),
        ("YT:b", 5, None, None, 7, datetime(2018, 6, 1, 2)),
    ]
    assert rejects == []


@pytest.mark.parametrize("text", ["2018-06-01T03:00:00", "2018-06-01 03:00:00+00:00", '"2018-06-01 05:00:00+02"'])
def test_timestamp_forms(load, text):
    good, _ = load(read_history, f"YT:a,1,1,1,1,{text}")
    assert good[0][-1] == datetime(2018, 6, 1, 3)


@pytest.mark.parametrize("line, reason", [
    ('"YT:b",5,,x,1,2018-06-02 02:00:00', "dislikes: not a bigint"),
    ('"YT:c",1,1,1', "wrong number of fields"),
    ('"YT:c",1,1,1,1,2018-06-02 02:00:00,9', "wrong number of fields"),
    ('"YT:d",1,1,1,1,notadate', "updated_at: not a timestamp"),
    ('"YT:e","1,2",1,1,1,2018-06-02 02:00:00', "views: not a bigint"),
    ('"YT:e",1.5,1,1,1,2018-06-02 02:00:00', "views: not a bigint"),
    (",1,1,1,1,2018-06-02 02:00:00", "gid: missing"),
    ('"",1,1,1,1,2018-06-02 02:00:00', "gid: missing"),
    ("YT:f,1,1,1,1,", "updated_at: missing"),
    ("YT:f,1,1,1,1,12:00:00", "updated_at: not a timestamp"),
    ("YT:f,1,1,1,1,2018", "updated_at: not a timestamp"),
    ("YT:f,1,1,1,1,2018-06", "updated_at: not a timestamp"),
    ("YT:f,1,1,1,1,2018-02-30", "updated_at: not a timestamp"),
    ("YT:f,1,1,1,1, 2018-06-02", "updated_at: not a timestamp"),
    ("YT:f, 7,1,1,1,2018-06-02 02:00:00", "views: not a bigint"),
    ("YT:f,7 ,1,1,1,2018-06-02 02:00:00", "views: not a bigint"),
    ("", "blank line"),
    ("  ", "blank line"),
    ("YT:123456789012,1,1,1,1,2018-06-02 02:00:00", "gid: longer than 14 bytes"),
])
def test_rejects_keep_their_line_and_reason(load, line, reason):
    good, rejects = load(read_history, line, "YT:z,1,1,1,1,2018-06-02 02:00:00")
    assert [row[0] for row in good] == ["YT:z"]
    assert rejects == [(line, reason)]


def test_a_reject_does_not_depend_on_the_columns_used(spark, tmp_path):
    (tmp_path / "input.csv").write_text("YT:a,1,1,1,1,2018-06-02 02:00:00\nYT:b,1,1,1,x,2018-06-02 02:00:00\n")
    good, rejects = read_history(spark, str(tmp_path / "input.csv"))
    assert good.select("gid").collect() == [("YT:a",)]
    assert good.count() == rejects.count() == 1


def test_meta(load):
    good, rejects = load(
        read_meta,
        "YT:a,UC1,10,2018-06-01 00:00:00,61",
        "YT:b,,,,",
        "YT:c,a-user-id-of-25-characters,10,2018-06-01 00:00:00,61",
        "YT:d,UC1,ten,2018-06-01 00:00:00,61",
        "",
    )
    assert good == [("YT:a", "UC1", 10, datetime(2018, 6, 1), 61), ("YT:b", None, None, None, None)]
    assert sorted(reason for _, reason in rejects) == [
        "blank line", "category_id: not a bigint", "user_id: longer than 24 bytes",
    ]


def test_reject_limit(spark, tmp_path):
    (tmp_path / "input.csv").write_text("YT:a,x,1,1,1,2018-06-02 02:00:00\n")
    _, rejects = read_history(spark, str(tmp_path / "input.csv"))
    check_rejects(rejects, max_rejects=1)
    with pytest.raises(TooManyRejects, match="views: not a bigint"):
        check_rejects(rejects)
