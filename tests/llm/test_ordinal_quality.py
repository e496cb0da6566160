import random

import numpy as np
import pytest

from viewtide.llm import ordinal_quality as oq

WORDS = {0: "slur insult threat hate".split(), 1: "click buy spam cheap".split(), 2: "river theory method result".split()}


def graded(n, first=0):
    """(doc_id, text, grade): words of the document's grade among common ones."""
    rng = random.Random(n + first)
    rows = []
    for k in range(n):
        grade = rng.randrange(3)
        words = [rng.choice(WORDS[grade]) if rng.random() < 0.4 else f"common{rng.randrange(30)}" for _ in range(30)]
        rows.append((first + k, " ".join(words), grade))
    return rows


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


def test_held_out_grades(documents, labels):
    learned, held_out = graded(400), graded(200, first=1000)
    ratings = labels([(d, int(g == 2), int(g == 0)) for d, _, g in learned])
    docs = documents([(d, t, "s") for d, t, _ in learned + held_out])
    model = oq.fit(docs, ratings)
    assert np.all(np.diff(model.thresholds) > 0)
    got = {r.doc_id: r for r in oq.score(docs, model).collect()}
    assert len(got) == 600
    assert all(abs(r.tail_1 + r.tail_2 - r.expected_grade) < 1e-9 and r.tail_1 >= r.tail_2 for r in got.values())
    assert all(r.keep == (r.tail_2 >= oq.KEEP_FROM) for r in got.values())
    right = sum(got[d].keep == (g == 2) for d, _, g in held_out)
    assert right >= 190
    means = [np.mean([got[d].expected_grade for d, _, g in held_out if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]


def test_cases(documents, labels):
    rows = [(None, "river", "s"), (1, None, "s"), (2, "", None), (3, "river " * 100_000, "s"), (3, "river", "s"), (3, "river", "s")]
    docs = documents(rows)
    unrated = oq.fit(docs, labels([(None, 1, 0), (3, None, 0), (77, 1, 0)]))
    assert unrated is None
    got = oq.score(docs, unrated).collect()
    assert len(got) == 6 and all(r.keep and r.tail_2 is None for r in got)
    model = oq.fit(docs, labels([(1, 0, None), (3, 1, 0), (3, 1, 0), (2, 0, 1)]))
    scored = oq.score(docs, model)
    assert scored.columns[: len(docs.columns)] == docs.columns
    got = scored.collect()
    assert len(got) == 6 and all(r.tail_2 is not None for r in got)
    assert len({r.tail_2 for r in got if r.text in (None, "")}) == 1
    assert oq.score(docs.limit(0), model).count() == 0


def test_repeated_ids_do_not_raise_the_bound(documents, labels, monkeypatch):
    rows = [(k % 5, f"river {k} " + ("theory" if k % 5 < 3 else "spam") * (k % 7), "s") for k in range(500)]
    ratings = labels([(k, int(k < 3), 0) for k in range(5)])
    seen = []
    descend = oq._descend
    monkeypatch.setattr(oq, "_descend", lambda row, feature, grades: seen.append((len(grades), len(feature))) or descend(row, feature, grades))
    oq.fit(documents(rows), ratings, most_rated=10)
    oq.fit(documents(rows), ratings, most_rated=400, most_features=300)
    assert seen[0][0] == 10 and seen[1][0] < 400 and seen[1][1] <= 300


def test_callers_columns_with_the_same_names(documents, labels):
    rows = [(k, "river theory" if k % 2 else "cheap spam", "s") for k in range(40)]
    docs = documents(rows)
    model = oq.fit(docs, labels([(k, k % 2, 0) for k in range(40)]))
    for known in (model, None):
        mine = docs.selectExpr("*", "concat('k', doc_id) as keep", "doc_id * 2 as TAIL_1")
        kept = oq.kept(mine, known).collect()
        assert all(r.keep == f"k{r.doc_id}" and r.TAIL_1 == r.doc_id * 2 for r in kept)
        assert sorted(r.doc_id for r in kept) == [r.doc_id for r in oq.score(docs, known).filter("keep").sort("doc_id").collect()]
        assert oq.score(mine, known).columns == [*docs.columns, "expected_grade", "tail_1", "tail_2", "keep"]


def loss(weights, thresholds, row, feature, grades):
    """Mean penalised negative log likelihood, one document after another."""
    total = 0.0
    for k, grade in enumerate(grades):
        s = weights[feature[row == k]].sum()
        above = [1.0, *[1 / (1 + np.exp(t - s)) for t in thresholds], 0.0]
        total -= np.log(above[grade] - above[grade + 1])
    return (total + 0.1 * (weights**2).sum()) / len(grades)


def test_most_likely_model_by_hand():
    rng = np.random.default_rng(5)
    grades = rng.integers(0, 3, 60)
    present = rng.random((60, 4)) < np.stack([0.2 + 0.3 * grades, 0.8 - 0.3 * grades, np.full(60, 0.5), np.full(60, 0.3)], 1)
    row, feature = (x.astype(np.int64) for x in np.nonzero(present))
    model = oq._descend(row, feature, grades)
    fitted = loss(model.weights[:4].astype(float), model.thresholds, row, feature, grades)
    # Plain descent along differences, from nothing.
    at = np.array([0.0, 0.0, 0.0, 0.0, -0.5, 0.5])
    value = lambda x: loss(x[:4], x[4:], row, feature, grades)
    for _ in range(250):
        slope = np.array([(value(at + h) - value(at - h)) / 2e-4 for h in np.eye(6) * 1e-4])
        at = at - 1.5 * slope
    assert np.abs(slope).max() < 1e-3
    assert abs(fitted - value(at)) < 1e-4
    assert np.abs(model.weights[:4] - at[:4]).max() < 0.05 and np.abs(model.thresholds - at[4:]).max() < 0.05
