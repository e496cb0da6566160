"""A corpus cleaned in five stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last
return the columns of `documents`. Rows without text, id or source pass through the stages
as those operators define it.
"""

import posixpath

from pyspark.sql import DataFrame, SparkSession

from viewtide.llm import lsh_forest, ordinal_quality, spaced_seeds, systematic_mix, token_files
from viewtide.llm.tables import read
from viewtide.sources.scratch import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best grade is likely; poor and toxic ones go."""
    model = ordinal_quality.fit(docs, read(spark, sf_dir, "labels"))
    return ordinal_quality.kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return lsh_forest.first_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return spaced_seeds.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document taken twice is there twice."""
    return systematic_mix.sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: one row per document taken."""
    path = posixpath.join(scratch_dir(spark), "tokens")
    token_files.write(docs, path, metadata=("source",))
    found = token_files.read(spark, path)
    return token_files.digests(found)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID output", tokens),
]

# Hashed features, MinHash and tokenizers have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = scratch_dir(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = posixpath.join(folder, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
