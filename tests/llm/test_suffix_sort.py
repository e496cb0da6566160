import hashlib
import random

import pytest

from viewtide.llm import suffix_sort
from viewtide.llm.queries import queries


def brute(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def same(frame, rows):
    assert sorted(map(tuple, frame.drop("kept").collect()), key=repr) == brute(rows)


def make(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (60, 99, 100, 101, 150, 400, 900)]
    rows = []
    for k in range(120):
        parts = [text(rng.randrange(300)) for _ in range(2)]
        for _ in range(rng.randrange(4)):
            part = rng.choice(shared)
            cut = rng.randrange(len(part))
            parts.insert(1, rng.choice([part, part[cut:], part[:cut]]))
        rows.append((k, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(documents, seed):
    rows = make(seed)
    same(suffix_sort.deduplicate(documents([(*r, "s") for r in rows])), rows)


def test_one_passage_over_many_ranges(spark, documents, monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    rows = [(k, f"start {k * 7919} {passage} end {k * 104729}") for k in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(suffix_sort.deduplicate(documents([(*r, "s") for r in rows])), rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_cases(documents):
    rows = [
        (1, None), (2, ""), (3, "a" * 5000), (4, "ab" * 3000), (5, "x" * 99), (6, "x" * 99), (7, "y" * 100), (8, "y" * 100),
        (None, "y" * 130 + "tail"), (9, "日本語" * 200), (10, "日本語" * 200), (11, "z" * 101 + "q" + "z" * 101),
    ]
    same(suffix_sort.deduplicate(documents([(*r, "s") for r in rows])), rows)
    assert suffix_sort.deduplicate(documents([])).collect() == []
    twice = [(1, "r" * 50 + "s" * 70)] * 2
    same(suffix_sort.deduplicate(documents([(*r, "s") for r in twice])), twice)


def test_query(spark, duck, sf):
    same(queries()["op5_suffix_sort"](spark, sf), duck.sql("select doc_id, text from documents").fetchall())
