import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from viewtide.llm import lsh_forest
from viewtide.llm.queries import queries


def shingle_set(text):
    words = (text or "").translate({k: k + 32 for k in range(65, 91)}).split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if sets[i] == sets[j] or (union and len(sets[i] & sets[j]) * 10 >= 8 * union):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = {}
    for k, r in zip(label, rows):
        if r[0] is not None:
            ids[k] = min(r[0], ids.get(k, r[0]))
    return sorted(((r[0], ids.get(k)) for k, r in zip(label, rows)), key=repr)


def copies_with_edits(seed, groups=12, size=15):
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(1 + len(own) // 25)):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own), "s"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1000, 4])
def test_groups_of_near_copies(documents, monkeypatch, block):
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    rows = copies_with_edits(block)
    got = lsh_forest.join(documents(rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute(rows)
    assert all((r.n_links > 0) == (sum(x.class_id == r.class_id for x in got) > 1) for r in got)


@pytest.mark.parametrize("block, rare", [(1000, 32), (4, 32), (6, 2), (1000, 2)])
def test_every_link_of_a_class_counts(documents, monkeypatch, block, rare):
    """Also those between sets that other links tie together already."""
    monkeypatch.setattr(lsh_forest, "BLOCK", block)
    monkeypatch.setattr(lsh_forest, "_RARE", rare)
    rows = copies_with_edits(7, groups=6) + [(1000 + k, " ".join(f"w{j}" for j in range(20 + 3 * k)), "s") for k in range(25)]
    rows += [(2000 + k, rows[k][1], "s") for k in range(0, 80, 9)]
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    got = {r.doc_id: r for r in lsh_forest.join(documents(rows)).collect()}
    different = set(sets.values())

    def links(d):
        others = {sets[e] for e in sets if got[e].class_id == got[d].class_id} - {sets[d]}
        return sum(10 * len(sets[d] & s) >= 8 * len(sets[d] | s) for s in others) + got[d].copies - 1

    assert {d: got[d].n_links for d in sets} == {d: links(d) for d in sets}
    assert sum(r.n_links for r in got.values()) > 2 * len(rows) > 2 * len(different)


def test_crowd_is_shuffled_once(spark, documents, monkeypatch):
    """What is sent on behalf of one large group of near copies grows with its size only."""
    monkeypatch.setattr(lsh_forest, "BLOCK", 10)
    rows = [(k, "prefix", k, k, 100) for k in range(99)] + [(0, "prefix", 500, 500, 100)]
    table = spark.createDataFrame(rows, "tree int, prefix string, member long, label long, n long").withColumn("tree", F.lit(0))
    linked = table.withColumn("label", F.when(F.col("member") < 99, 0).otherwise(F.col("member")))
    assert lsh_forest._heads(linked).count() == 2
    across = lsh_forest._across(linked)
    # Every member of the group once, the stranger once for each of its blocks and once for its own.
    assert across.filter("member < 99").count() == 99 and across.filter("member = 500").count() == 11
    apart = lsh_forest._across(table).select("block_a", "block_b", "member").collect()
    together = {frozenset((x.member, y.member)) for x in apart for y in apart if (x[0], x[1]) == (y[0], y[1])}
    assert all(frozenset((x, y)) in together for x in [*range(99), 500] for y in [*range(99), 500])


def test_recall_on_the_table(spark, duck, sf):
    """Of all pairs of documents at the threshold, almost all are in one class; classes hold no others."""
    rows = duck.sql("select doc_id, text from documents order by doc_id").fetchall()
    sets = {d: shingle_set(t) for d, t in rows}
    where, common = defaultdict(list), Counter()
    for d, found in sets.items():
        for one in found:
            common.update((other, d) for other in where[one])
            where[one].append(d)
    pairs = [(a, b) for (a, b), n in common.items() if 10 * n >= 8 * (len(sets[a]) + len(sets[b]) - n)]
    got = {r.doc_id: r.class_id for r in queries()["op3_lsh_forest"](spark, sf).collect()}
    met = sum(got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 50 and met >= 0.99 * len(pairs)
    exact = {d: c for d, c in brute(rows)}
    assert all(exact[d] == exact[c] for d, c in got.items())


def test_cases(documents):
    rows = [
        (1, None, None), (2, "", "s"), (3, " \n", "s"), (None, "a b c", "s"), (None, "A b  C", "s"), (5, "a b c d", "s"),
        (6, "one two three four five six", "s"), (6, "one two three four five six", "s"), (7, "w " * 50_000, "s"),
        (8, "w " * 60_000, "s"), (9, "other words " * 3, "s"),
    ]
    got = lsh_forest.join(documents(rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute(rows)
    docs = documents(rows)
    kept = lsh_forest.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "5", "6", "7", "9", "None"]
    assert lsh_forest.join(documents([])).collect() == []


def test_depth():
    depth = lsh_forest.depth_for()
    assert 1 - (1 - 0.8**depth) ** lsh_forest.TREES >= 0.998 > 1 - (1 - 0.8 ** (depth + 1)) ** lsh_forest.TREES
