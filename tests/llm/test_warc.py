import base64
import gzip
import hashlib
import io

import pytest

from viewtide.llm import warc


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload string, refers_to string"
    )


def brute(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        f = first.get(html or "")
        refers = f if f is not None and f != page_id else None
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "u", "<p>é</p>"),
    (5, "u", "line\r\n\r\nWARC/1.1\r\n"), (6, "u", "z" * 3_000_000), (7, "u", "z" * 3_000_000), (2, None, "<p>é</p>"),
    (1, "u", "<p>é</p>"), (None, None, "alone"), (None, None, "alone"), (-9, "u", "n"),
]


@pytest.mark.parametrize("least", [0, 100])
def test_cases(pages, least):
    assert sorted(map(tuple, warc.round_trip(pages(ROWS), least).collect()), key=repr) == brute(ROWS, least)


def test_very_frequent_payload(pages, monkeypatch):
    monkeypatch.setattr(warc, "_CROWDED", 2)
    assert sorted(map(tuple, warc.round_trip(pages(ROWS)).collect()), key=repr) == brute(ROWS)


def test_empty(pages):
    assert warc.round_trip(pages([])).collect() == []


def test_members_and_small_pieces(monkeypatch):
    monkeypatch.setattr(warc, "PIECE_BYTES", 7)
    data = warc.record(1, "u", b"one", None) + warc.record(2, "u", b"one", 1) + warc.record(3, "u", b"", None)
    found = list(warc.records(io.BytesIO(data), "x"))
    assert [(r["record_type"], r["payload"], r["payload_bytes"]) for r in found] == [
        ("response", b"one", 3), ("revisit", None, 3), ("response", b"", 0)]
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3


@pytest.mark.parametrize("damage, message", [
    (lambda d: d[:-9], "ends within"), (lambda d: b"junk" + d, "at 0"),
    (lambda d: gzip.compress(gzip.decompress(d).replace(b"pay", b"pax")), "digest does not match"),
    (lambda d: gzip.compress(gzip.decompress(d) + b"!"), "does not frame"),
    (lambda d: gzip.compress(b"hello"), "no WARC header"),
])
def test_damage_is_found(damage, message):
    with pytest.raises(warc.WarcError, match=message):
        list(warc.records(io.BytesIO(damage(warc.record(1, "u", b"payload", None))), "x"))
