"""The operators as named queries over the test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.llm import (
    content_sort, gnat_codes, kd_shards, lsh_forest, ordinal_quality, ppm, site_templates, spaced_seeds, suffix_sort, systematic_mix,
    token_files, warc, whitening,
)
from viewtide.llm.tables import read


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = ordinal_quality.fit(docs, read(spark, sf_dir, "labels"))
    return ordinal_quality.score(docs.select("doc_id", "text"), model).drop("text")


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(read(spark, sf_dir, "documents"))


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.join(read(spark, sf_dir, "documents")).drop("row_id", "class_row")


def op4_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = systematic_mix.mix(read(spark, sf_dir, "documents"), columns=("doc_id",))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    )


def op5_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sort.deduplicate(read(spark, sf_dir, "documents")).drop("kept")


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spaced_seeds.mark(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_items", (F.col("n_items") > 0).alias("contaminated"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(read(spark, sf_dir, "documents"), shards=24)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(read(spark, sf_dir, "documents"))


def op10_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.deduplicate(read(spark, sf_dir, "documents"))


def op11_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat_codes.compress(read(spark, sf_dir, "embeddings"))


def op12_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_templates.extract(read(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ordinal_quality": op1_ordinal_quality,
        "op2_ppm": op2_ppm,
        "op3_lsh_forest": op3_lsh_forest,
        "op4_systematic_mix": op4_systematic_mix,
        "op5_suffix_sort": op5_suffix_sort,
        "op6_spaced_seeds": op6_spaced_seeds,
        "op7_warc": op7_warc,
        "op8_kd_shards": op8_kd_shards,
        "op9_token_files": op9_token_files,
        "op10_content_sort": op10_content_sort,
        "op11_gnat_codes": op11_gnat_codes,
        "op12_site_templates": op12_site_templates,
        "op13_whitening": op13_whitening,
    }
