import hashlib
import re

from viewtide.llm.content_sort import deduplicate


def brute(rows):
    groups = {}
    for doc_id, text, _ in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id is None, doc_id))
    out = []
    for text, members in groups.items():
        members.sort()
        for k, (_, _, doc_id) in enumerate(members):
            out.append((doc_id, members[0][2], len(members), k == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_cases(documents):
    rows = [
        (1, "a b", "s"), (2, "ab ", "s"), (3, "a\tb\n", "s"), (4, None, "s"), (5, " \n", None), (None, "ab  ", "s"),
        (None, "x", "s"), (6, "é" * 9, "s"), (6, "é" * 9, "s"), (7, "z" * 400_000, "s"), (8, "z" * 400_000 + "y", "s"),
        (9, "z" * 400_000, "s"), (10, "a b", "s"),
    ]
    assert result(deduplicate(documents(rows))) == brute(rows)


def test_empty(documents):
    assert deduplicate(documents([])).collect() == []


def test_one_group_over_many_ranges(spark, documents):
    rows = [(k, "the same text" if k % 3 else f"text {k}", "s") for k in range(3000)]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = deduplicate(documents(rows))
        assert result(frame) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
