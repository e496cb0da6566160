from collections import Counter

import pytest

from viewtide.llm.systematic_mix import mix, plan, sample


def targets_by_turns(sizes, weights=(1, 2, 3), most=3):
    """Resharing turn by turn, as the rule puts it."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    held, free = {}, set(names)
    while free:
        rest = sum(sizes.values()) - sum(held.values())
        shares = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if shares[s] > most * sizes[s]}
        if not over:
            return held | shares
        held |= {s: most * sizes[s] for s in over}
        free -= over
    return held


def make(sizes):
    rows, k = [], 0
    for source, counts in sizes.items():
        for n in counts:
            rows.append((k, " ".join(["w"] * n), source))
            k += 1
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": [100] * 30, "b": [5, 9], "c": [3]}, {"a": [7], "b": [900, 800], None: [3, 4, 5], "z": [1] * 50},
    {"only": [4, 5, 6]}, {"a": [0, 0], "b": [10, 20, 30]}, {"a": [5] * 999, "b": [1], "c": [1], "d": [2]},
    {s: [20] for s in "abcd"}, {s: [20 + k, 5] for k, s in enumerate("abcdefghijk")}, {"a": [10], "b": [10], "c": [80], "d": [80]},
    {f"s{k:03}": [1 + k * k % 97] * (1 + k % 5) for k in range(60)}, {"a": [6], "b": [3], "c": [2], "d": [6], None: [100]},
])
def test_targets_and_words_taken(documents, sizes):
    docs = documents(make(sizes))
    totals = {s: sum(c) for s, c in sizes.items()}
    expected = targets_by_turns(totals)
    got = {r.source: r for r in plan(docs).collect()}
    assert {s: r.source_size for s, r in got.items()} == totals
    assert {s: r.target for s, r in got.items()} == pytest.approx(expected)
    assert all(0 <= r.target <= 3 * r.source_size for r in got.values())
    assert sum(r.target for r in got.values()) == pytest.approx(sum(totals.values()))
    taken, most = Counter(), Counter()
    for r in mix(docs).collect():
        taken[r.source] += r.copies * r.size
        most[r.source] = max(most[r.source], r.size)
        assert 0 <= r.copies <= 3
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 2 * most[s]
    assert sorted(r.doc_id for r in sample(docs).collect()) == sorted(
        r.doc_id for r in mix(docs).collect() for _ in range(r.copies))


def test_cases(documents):
    rows = [(1, None, None), (None, "a b", "s"), (2, "a b", "s"), (2, "a b", "s"), (3, "\t \n", "t"), (4, "x " * 200_000, "t")]
    got = mix(documents(rows)).collect()
    assert len(got) == 6 and sorted(r.size for r in got) == [0, 0, 2, 2, 2, 200_000]
    assert sorted(map(str, got)) == sorted(map(str, mix(documents(rows)).collect()))
    assert mix(documents([])).collect() == []
    assert {r.target for r in mix(documents([(1, None, "a"), (2, "", None)])).collect()} == {0.0}
    assert sample(documents(rows)).columns == documents(rows).columns


def test_callers_columns_stay_as_they_are(spark):
    docs = spark.createDataFrame(
        [(k, "w " * (k + 1), "s", f"a{k}", f"b{k}", -k, f"c{k}") for k in range(5)],
        "doc_id long, text string, source string, start string, rank string, size long, id_slice string",
    )
    taken = sample(docs)
    assert taken.columns == docs.columns and set(taken.collect()) <= set(docs.collect()) and taken.count() > 0
    assert {(r.doc_id, r.start, r.rank, r.id_slice) for r in mix(docs).collect()} == {
        (r.doc_id, r.start, r.rank, r.id_slice) for r in docs.collect()}
    assert {r.size for r in mix(docs).collect()} == {1, 2, 3, 4, 5}
    with pytest.raises(ValueError):
        mix(docs.withColumnRenamed("rank", "_mix_rank"))


def test_crowded_sizes(documents, monkeypatch):
    """Slices of ids, and of texts where there is no id, give the same ranks as one window would."""
    monkeypatch.setattr("viewtide.llm.systematic_mix._SLICE_ROWS", 7)
    rows = [(k, "a b", "s") for k in range(40)] + [(None, f"x{k} y", "s") for k in range(30)] + [(90, "z", "t")]
    got = mix(documents(rows)).collect()
    assert len(got) == 71 and all(0 <= r.copies <= 3 for r in got)
    assert abs(sum(2 * r.copies for r in got if r.source == "s") - got[0].target) <= 4
    assert sorted(map(str, got)) == sorted(map(str, mix(documents(rows)).collect()))
