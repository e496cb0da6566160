"""Benchmark decontamination with spaced seeds.

A seed is a stretch of ten words of which a fixed mask looks at some; the others may differ.
Several masks make it likely that a copied passage with substitutions still agrees on one.
Seeds of all benchmark items are hashed and set in a bit map of fixed size; documents look
their own seeds up in it as they are read, so only stretches near a likely hit leave the
scan. Those are joined with the benchmark's seeds by hash, and each (stretch, item, shift)
that meets is verified: laid over each other, some window of `window` words (the whole item
if shorter) must agree in at least `similarity` of its words.

Items of fewer than ten words are too short for the masks: all their words are one seed,
and documents are looked through for stretches of the lengths that such items have. They
match where all their words stand.

Words are in lower case and without punctuation. Defined cases: a missing text has no words,
an item without words matches nothing. Equal items are one, repeated rows and documents
without id are handled one by one. Stretches of one document that overlap are joined into
one. Columns come back as they were, but for n_items; names that begin with `_seeds_` are
reserved.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import reserved, steady, store, text_of
from viewtide.llm.words import BREAKS, mix, pieces, split

# 1: the word counts, 0: it may differ.
MASKS = ("1110010111", "1101101011", "1010111101", "1111001011")
SPAN = 10
WINDOW = 20
SIMILARITY = 0.8
REACH = 48
_MAP_BITS = 27
_NUMBER, _COUNT = "_seeds_row", "_seeds_items"


def seeds(hashes: np.ndarray, document: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per mask: positions of stretches inside one document, and their hashes."""
    n = len(hashes) - SPAN + 1
    if n <= 0:
        return
    inside = np.flatnonzero(document[SPAN - 1 :] == document[:n])
    for number, mask in enumerate(MASKS):
        h = np.full(len(inside), number + 1, np.uint64)
        for j, bit in enumerate(mask):
            if bit == "1":
                h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[inside + j]
        yield inside, mix(h)


def gram(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the stretches of `size` words from the positions on."""
    h = np.full(len(at), 1000 + size, np.uint64)
    for j in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[at + j]
    return mix(h)


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """row_id and number of items found, for each contaminated row; numbers are those of `steady(docs)`."""
    spark = docs.sparkSession
    items = store(
        benchmark.select(text_of("text").alias("text")).distinct()
        .select("text", F.monotonically_increasing_id().alias("item"))
        .mapInArrow(_item_seeds, "item bigint, words binary, seeds array<struct<seed: bigint, at: int>>"),
        "items",
    )
    item_seeds = items.select("item", F.inline("seeds"))
    # At most 2^21 rows of 64 bits each, however many seeds there are.
    place = F.shiftrightunsigned("seed", 64 - _MAP_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - _MAP_BITS}) & 63 as int))")
    filled = item_seeds.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(1 << (_MAP_BITS - 6), "<i8")
    bits[filled.column("word").to_numpy()] = filled.column("bits").to_numpy()
    bit_map = spark.sparkContext.broadcast(bits.view(np.uint8))
    # At most nine numbers.
    size = (F.octet_length("words") / 8).cast("int")
    lengths = sorted(r[0] for r in items.filter((size > 0) & (size < SPAN)).select(size).distinct().collect())
    rows = steady(docs).select(F.monotonically_increasing_id().alias("row_id"), text_of("text").alias("text"))
    stretches = store(
        rows.mapInArrow(
            lambda batches: _stretches(batches, bit_map, lengths),
            "row_id bigint, stretch bigint, words binary, seeds array<struct<seed: bigint, at: int>>",
        ),
        "stretches",
    )
    met = (
        stretches.select("row_id", "stretch", F.inline("seeds"))
        .join(item_seeds.withColumnRenamed("at", "item_at"), "seed")
        .select("row_id", "stretch", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    laid = met.join(stretches.drop("seeds"), ["row_id", "stretch"]).join(
        items.select("item", F.col("words").alias("item_words")), "item"
    )
    verified = laid.mapInArrow(
        lambda batches: _verify(batches, window, similarity), "row_id bigint, item bigint"
    )
    return verified.distinct().groupBy("row_id").agg(F.count("*").alias("n_items"))


def mark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with n_items, the number of benchmark items each contains."""
    reserved(docs, "_seeds_")
    docs = steady(docs)
    found = store(find(docs, benchmark), "found").select(F.col("row_id").alias(_NUMBER), F.col("n_items").alias(_COUNT))
    own = [c for c in docs.columns if c != "n_items"]
    return (
        docs.withColumn(_NUMBER, F.monotonically_increasing_id()).join(found, _NUMBER, "left")
        .select(*own, F.coalesce(_COUNT, F.lit(0)).alias("n_items"))
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without benchmark items, with their own columns."""
    reserved(docs, "_seeds_")
    docs = steady(docs)
    found = store(find(docs, benchmark), "found").select(F.col("row_id").alias(_NUMBER))
    return docs.withColumn(_NUMBER, F.monotonically_increasing_id()).join(found, _NUMBER, "left_anti").drop(_NUMBER)


def _seed_list(hashes: np.ndarray, at: np.ndarray) -> list[dict]:
    return [{"seed": s, "at": a} for s, a in zip(hashes.view(np.int64).tolist(), at.tolist())]


_SEEDS = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in pieces(batch, "text"):
            words = split(data, offsets, BREAKS)
            firsts = np.searchsorted(words.document, np.arange(part.num_rows + 1))
            held: list[list] = [[] for _ in range(part.num_rows)]
            for position, hashes in seeds(words.hashes, words.document):
                cuts = np.searchsorted(words.document[position], np.arange(1, part.num_rows))
                for k, (h, p) in enumerate(zip(np.split(hashes, cuts), np.split(position, cuts))):
                    held[k] += _seed_list(h, p - firsts[k])
            for size in range(1, SPAN):
                short = np.flatnonzero(np.diff(firsts) == size)
                for k, h in zip(short.tolist(), gram(words.hashes, firsts[short], size)):
                    held[k] += _seed_list(h.reshape(1), np.zeros(1, np.int64))
            yield pa.RecordBatch.from_pydict({
                "item": part.column("item"),
                "words": pa.array([words.hashes[a:b].tobytes() for a, b in zip(firsts, firsts[1:])], pa.binary()),
                "seeds": pa.array(held, _SEEDS),
            })


def _grams(hashes: np.ndarray, document: np.ndarray, lengths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for size in lengths:
        n = len(hashes) - size + 1
        if n > 0:
            inside = np.flatnonzero(document[size - 1 :] == document[:n])
            yield inside, gram(hashes, inside, size)


def _stretches(batches: Iterator[pa.RecordBatch], bit_map, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    bits = bit_map.value
    for batch in batches:
        out = []
        for part, data, offsets in pieces(batch, "text"):
            words = split(data, offsets, BREAKS)
            hits = []
            of_items = chain(seeds(words.hashes, words.document), _grams(words.hashes, words.document, lengths))
            for position, hashes in of_items:
                place = hashes >> np.uint64(64 - _MAP_BITS)
                hit = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                hits.append((position[hit], hashes[hit]))
            if not hits:
                continue
            position, hashes = (np.concatenate(x) for x in zip(*hits))
            if not len(position):
                continue
            order = np.argsort(position, kind="stable")
            position, hashes = position[order], hashes[order]
            document = words.document[position]
            new = np.flatnonzero((np.diff(position) > REACH) | (np.diff(document) != 0)) + 1
            firsts = np.searchsorted(words.document, np.arange(part.num_rows + 1))
            ids = part.column("row_id").to_numpy()
            for p, h in zip(np.split(position, new), np.split(hashes, new)):
                row = words.document[p[0]]
                low, high = max(firsts[row], p[0] - REACH), min(firsts[row + 1], p[-1] + SPAN + REACH)
                out.append({"row_id": int(ids[row]), "stretch": int(low - firsts[row]),
                            "words": words.hashes[low:high].tobytes(), "seeds": _seed_list(h, p - low)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("row_id", pa.int64()), ("stretch", pa.int64()), ("words", pa.binary()), ("seeds", _SEEDS)]))


def agree(words: np.ndarray, item: np.ndarray, shift: int, window: int, similarity: float) -> bool:
    """Whether the item, laid over the words from `shift` on, agrees in some window."""
    low, high = max(0, -shift), min(len(item), len(words) - shift)
    same = np.zeros(len(item), np.int64)
    same[low:high] = words[low + shift : high + shift] == item[low:high]
    size = min(window, len(item))
    sums = np.concatenate([[0], np.cumsum(same)])
    return bool((sums[size:] - sums[:-size]).max() >= similarity * size)


def _verify(batches: Iterator[pa.RecordBatch], window: int, similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [
            agree(np.frombuffer(words, np.uint64), np.frombuffer(item, np.uint64), shift, window, similarity)
            for words, item, shift in zip(*[batch.column(c).to_pylist() for c in ("words", "item_words", "shift")])
        ]
        yield batch.select(["row_id", "item"]).filter(pa.array(kept, pa.bool_()))
