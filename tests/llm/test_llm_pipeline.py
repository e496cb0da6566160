import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from test_systematic_mix import targets_by_turns
from viewtide.llm import token_files


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_stages_on_the_tables(spark, sf, tmp_path):
    """Each stage gives what its operator keeps of the stage before; the mix comes near its
    targets, and the token files hold every document taken as the tokenizer alone encodes it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        if number < 4:
            assert after.columns == columns
            assert after.join(docs, "doc_id", "left_anti").filter("doc_id is not null").count() == 0
        if number < 3:
            assert 0 < after.count() < before
        if number == 3:
            check_mix(docs.collect(), after.collect())
        if number == 4:
            check_tokens(docs.collect(), after.collect())
        docs, before = after, after.count()


def check_mix(offered, taken):
    sizes, largest, got = {}, {}, {}
    for row in offered:
        sizes[row.source] = sizes.get(row.source, 0) + words(row.text)
        largest[row.source] = max(largest.get(row.source, 0), words(row.text))
    for row in taken:
        got[row.source] = got.get(row.source, 0) + words(row.text)
    for source, target in targets_by_turns(sizes).items():
        assert abs(got.get(source, 0) - target) <= 2 * largest[source]
    assert sum(got.values()) == pytest.approx(sum(sizes.values()), rel=0.2)


def check_tokens(docs, rows):
    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    encoded = sorted(
        (d.doc_id, zlib.crc32(np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()))
        for d in docs
    )
    assert len(encoded) > 0
    assert sorted((r.doc_id, r.ids_crc32) for r in rows) == encoded


@pytest.mark.parametrize("empty", [True, False])
def test_no_rows_and_null_rows(spark, sf, tmp_path, empty):
    """An empty table and one of NULLs alone pass through all stages."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    source = tmp_path / "in"
    rows = [] if empty else [(None,) * len(docs.columns)] * 3
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{source}/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{table}.parquet").write.parquet(f"{source}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(source)).count() <= len(rows)
