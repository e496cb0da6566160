"""Row numbers stay the same when executors come or go between the readings of one query."""

import random

import pytest

from viewtide.llm import lsh_forest, ppm, spaced_seeds, suffix_sort, tables


@pytest.fixture
def docs(spark, tmp_path):
    """A table in several files of many row groups, cut anew for every number of cores."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(500)]
    rows = [(k, texts[k % 350] if k % 3 else texts[k] + " same long passage that many documents share " * 3) for k in range(500)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.option("parquet.block.size", 4096).parquet(path)
    before = {"spark.sql.files.openCostInBytes": "1k", "spark.sql.files.minPartitionNum": None}
    before = {name: (spark.conf.get(name, None), value) for name, value in before.items()}
    for name, (_, value) in before.items():
        spark.conf.set(name, value) if value else spark.conf.unset(name)
    yield spark.read.parquet(path)
    for name, (value, _) in before.items():
        spark.conf.set(name, value) if value else spark.conf.unset(name)
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_cores_change_the_cut_unless_it_is_set(spark, docs):
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
    few = docs.rdd.getNumPartitions()
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "64")
    assert docs.select("*").rdd.getNumPartitions() > few
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
    tables.steady(docs)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "64")
    assert docs.select("doc_id").rdd.getNumPartitions() == few


@pytest.mark.parametrize("module, run", [
    (ppm, lambda docs: ppm.score(docs)),
    (lsh_forest, lambda docs: lsh_forest.first_of_each(docs)),
    (suffix_sort, lambda docs: suffix_sort.deduplicate(docs).drop("kept")),
    (spaced_seeds, lambda docs: spaced_seeds.mark(docs, docs.filter("doc_id % 50 = 1").select("text"))),
], ids=lambda x: getattr(x, "__name__", "").rpartition(".")[2])
def test_results_with_cores_that_come_and_go(spark, docs, monkeypatch, module, run):
    expected = sorted(map(repr, run(docs).collect()))
    spark.conf.unset("spark.sql.files.minPartitionNum")
    calls, store = [], tables.store

    def change(df, name):
        stored = store(df, name)
        calls.append(name)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str((64, 2, 17)[len(calls) % 3]))
        return stored

    if hasattr(module, "store"):
        monkeypatch.setattr(module, "store", change)
    found = run(docs)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "32")
    assert sorted(map(repr, found.collect())) == expected
    assert len(expected) > 300
