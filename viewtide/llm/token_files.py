"""Token ids as Parquet: one row per document with its ids as a list column.

Documents are dealt over ranges of ascending id, sorted, encoded and written, one file per
range. Ids of the lists are dictionary encoded; document ids, lengths and positions rise
or vary little and are delta encoded (the second version of the format). Row groups have a
bounded size, and pages an index with the smallest and largest value of each column, so
that a reader that wants some documents or only metadata skips the other pages.

Words repeat, so the words of a piece of text are numbered in Arrow and parted from the
punctuation behind them. Every Python worker keeps the ids of the stems it has met, up to a
bound, and only new ones go through the tokenizer; the ids of all words are then taken
together. Neither white space nor the border between a letter and punctuation ever lies
within a token of this vocabulary, which `encoder` checks on the tokenizer's own description.

Defined cases: a missing text is empty and has the end id only. Documents without an id
come last. Repeated rows are written and counted one by one. Other columns are not read
unless named in `metadata`.
"""

import json
import posixpath
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewtide.llm.tables import text_of
from viewtide.llm.words import pieces
from viewtide.sources.scratch import scratch_dir

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
CACHED_STEMS = 1_000_000
# What the vocabulary must split words by, for stems to be encoded apart from what ends them.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ASCII punctuation that no token shares with a letter before it: all but the apostrophe.
ENDS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
_BATCH = 512
_PIECE_BYTES = 8 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, metadata: tuple[str, ...] = ()
) -> None:
    """Encode the documents and write them in ascending order of their id."""
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").cast("binary").alias("text"), *metadata)
    order = F.col("doc_id").asc_nulls_last()
    ordered = rows.repartitionByRange(order).sortWithinPartitions(order)
    kept = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in metadata)
    encoded = ordered.withColumn("file_number", F.spark_partition_id()).mapInArrow(
        lambda batches: _encode(batches, tokenizer, end_id, metadata),
        "doc_id bigint, file_number int, start_in_file bigint, n_tokens int, token_ids array<int>"
        + (f", {kept}" if kept else ""),
    )
    (
        encoded.write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#token_ids.list.element", "true")
        .option("compression", "snappy")
        .parquet(path)
    )


def read(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """Documents with the place of their first id in the whole sequence.

    Bounds on the id reach the page index; columns that are not used are not read.
    """
    rows = spark.read.parquet(path)
    lengths = rows.groupBy("file_number").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_number").rowsBetween(Window.unboundedPreceding, -1)
    files = lengths.select("file_number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    if first_id is not None:
        rows = rows.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.filter(F.col("doc_id") <= last_id)
    # One row per file.
    return rows.join(F.broadcast(files), "file_number").withColumn(
        "start", F.col("file_start") + F.col("start_in_file")
    ).drop("file_start")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids as they stand in the files."""
    return rows.select("doc_id", "start", "token_ids").mapInArrow(
        _digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def write_and_read(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    path = posixpath.join(scratch_dir(spark), "tokens")
    write(docs, path, tokenizer)
    return digests(read(spark, path))


_ENCODERS: dict[str, Callable[[pa.Array], pa.ListArray]] = {}


def encoder(tokenizer: str) -> Callable[[pa.Array], pa.ListArray]:
    """Lists of the ids of texts. Kept for the life of the worker."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = _make_encoder(tokenizer)
    return _ENCODERS[tokenizer]


def _make_encoder(path: str) -> Callable[[pa.Array], pa.ListArray]:
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    description = json.loads(model.to_str())
    if not _splits_at_spaces(description):
        return lambda texts: pa.array(
            [model.encode(text, add_special_tokens=False).ids for text in texts.to_pylist()], pa.list_(pa.int32())
        )
    special = [token["content"] for token in description["added_tokens"]]
    known = _Stems(model)

    def encode(texts: pa.Array) -> pa.ListArray:
        words = pc.ascii_split_whitespace(texts)
        distinct = words.flatten().dictionary_encode()
        stems, ends = _stems_and_ends(distinct.dictionary, special)
        n = len(stems)
        parts = known.ids(pa.concat_arrays([stems, ends]))
        # Stem, end, stem, end and so on; then each two make a word.
        pairs = parts.take(pa.array(np.arange(2 * n).reshape(2, n).T.reshape(-1)))
        ids_of = pa.ListArray.from_arrays(pa.array(_offsets(pairs)[::2]), pairs.flatten())
        ids = ids_of.take(distinct.indices)
        return pa.ListArray.from_arrays(pa.array(_offsets(ids)[_offsets(words)]), ids.flatten())

    return encode


def _offsets(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins and the last one ends in the flattened values."""
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0]


class _Stems:
    """Ids of stems that were met, newest last; the older half goes when there are too many."""

    def __init__(self, model) -> None:
        self.model = model
        self.stems = pa.array([""])
        self.found = pa.array([[]], pa.list_(pa.int32()))

    def ids(self, stems: pa.Array) -> pa.ListArray:
        wanted = stems.dictionary_encode()
        distinct = wanted.dictionary
        if len(self.stems) > CACHED_STEMS:
            half = len(self.stems) // 2
            self.stems, self.found = (pa.concat_arrays([x[:1], x[half:]]) for x in (self.stems, self.found))
        new = distinct.filter(pc.is_null(pc.index_in(distinct, self.stems)))
        parts = [_encode_words(self.model, new[at : at + _BATCH].to_pylist()) for at in range(0, len(new), _BATCH)]
        self.stems = pa.concat_arrays([self.stems, new])
        self.found = pa.concat_arrays([self.found, *parts])
        return self.found.take(pc.index_in(distinct, self.stems).take(wanted.indices))


def _stems_and_ends(words: pa.Array, special: list[str]) -> tuple[pa.Array, pa.Array]:
    """Two parts of each word whose ids together are the word's; the second is punctuation or empty.

    Between a letter and ASCII punctuation this vocabulary always begins a new token, so
    many words share a stem. A-Z in the stem are put in lower case as its normalizer does.
    A stem that ends in something else, in a letter that its lower case turns into more, or
    that holds other characters than letters beside ASCII, is not cut off; nor is one of a
    word that holds a special token, or would in lower case.
    """
    stems = pc.ascii_rtrim(words, ENDS)
    lower = pc.ascii_lower(stems)
    cut = pc.match_substring_regex(lower, r"^(?:[\x00-\x7f]*[a-z]|\pL*[^\PL\x{130}])$")
    for token in special:
        cut = pc.and_not(cut, pc.match_substring(pc.ascii_lower(words), pc.ascii_lower(token).as_py()))
    return pc.if_else(cut, lower, words), pc.if_else(cut, _rest(words, stems), "")


def _rest(words: pa.Array, stems: pa.Array) -> pa.Array:
    """What follows the stem in each word."""
    whole = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    lengths = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy()
    ends = np.concatenate([[0], np.cumsum(lengths)])
    source = np.arange(ends[-1]) + np.repeat(whole[1:] - ends[1:], lengths)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[source]
    return pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _splits_at_spaces(description: dict) -> bool:
    """Whether white space always ends a word and is then dropped, as in this vocabulary."""
    normalizers = [x["type"] for x in (description["normalizer"] or {}).get("normalizers", [])]
    steps = (description["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        normalizers == ["NFC", "Replace", "Lowercase"]
        and [x["type"] for x in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": SPLIT} and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["add_prefix_space"]
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or " " in x["content"]
                    for x in description["added_tokens"])
    )


def _encode_words(model, words: list[str]) -> pa.ListArray:
    """The words encoded as one text, and cut apart by where each id's characters stand."""
    found = model.encode(" ".join(words), add_special_tokens=False)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.fromiter((offset[0] for offset in found.offsets), np.int64, len(found.ids))
    cuts = np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(found.ids, pa.int32()))


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, metadata) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer)
    start = 0
    for batch in batches:
        for part, _, _ in pieces(batch, "text", _PIECE_BYTES):
            found = encode(part.column("text").cast(pa.string()))
            offsets = _offsets(found).astype(np.int64)
            with_end = np.insert(found.flatten().to_numpy(), offsets[1:], end_id)
            offsets += np.arange(len(offsets))
            lengths, starts = np.diff(offsets), start + offsets[:-1]
            columns = {
                "doc_id": part.column("doc_id"), "file_number": part.column("file_number"),
                "start_in_file": pa.array(starts), "n_tokens": pa.array(lengths, pa.int32()),
                "token_ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(with_end)),
                **{c: part.column(c) for c in metadata},
            }
            start += len(with_end)
            yield pa.RecordBatch.from_pydict(columns)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("token_ids")
        offsets = lists.offsets.to_numpy()
        values = np.ascontiguousarray(lists.values.to_numpy(), "<u4")
        sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "start": batch.column("start"),
            "n_tokens": pc.cast(pc.list_value_length(lists), pa.int64()),
            "ids_crc32": pa.array(sums, pa.int64()),
        })
