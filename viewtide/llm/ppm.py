"""Log probability of documents by prediction by partial matching over bytes.

A text is modelled as its words in lower case, one space between, then an end. The trie
counts how often each byte followed each context of up to `ORDER` bytes in the training
documents. A byte is coded in the longest context the trie knows: with n occurrences of d
different bytes a known byte has (2 * its count - 1) / 2n, and the rest, d / 2n, is
the escape to the next shorter context. There the bytes of the longer context are excluded:
they would not have escaped. Below the empty context all remaining bytes are equally
likely. This sums to one over all texts.

The trie has no size bound, so no task holds it. Documents are taken in blocks; a block
lists the different (context, byte) it contains, which go to the part of the trie with
their last two context bytes. There they are counted, priced with their whole chain of
shorter contexts, and each block gets the prices of its own entries back. Only the two
shortest contexts, 65,536 counts at most, are sent to all. The counts of words for the base
score take the same way. What is shuffled are packed arrays, one row per block and part.

Defined cases: a missing text has only its end. A missing id counts as the empty text when
documents are told apart by checksum. Repeated rows are learned from and scored one by one.
Words are known by 64-bit hashes; for V different ones a mix-up has a chance of V^2 / 2^65.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import steady, store, text_of
from viewtide.llm.words import Words, pieces, split

ORDER = 5
ADDED = 0.1
_BLOCK_BITS = 12
_PIECE_BYTES = 1 << 19
_END_WORD = np.uint64(0xE4D)
_END, _SPACE = 10, 32
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENTRIES = "block bigint, part int, words boolean, keys binary, counts binary"


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if not 2 <= order <= 6:
        raise ValueError(f"order must be 2 to 6, not {order}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_id = F.monotonically_increasing_id()
    rows = steady(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0).alias("held_out"),
        text_of("text").cast("binary").alias("text"),
        F.shiftright(row_id, _BLOCK_BITS).alias("block"),
    )
    entries = store(rows.mapInArrow(lambda batches: _entries(batches, order, parts), _ENTRIES), "entries")
    short, totals = _short_contexts(entries, order)
    priced = entries.groupBy("part", "words").applyInPandas(
        lambda group: _price(group, short, order), _ENTRIES
    )
    n, v = totals
    scored = rows.groupBy("block").cogroup(priced.groupBy("block")).applyInPandas(
        lambda texts, prices: _score(texts, prices, n, v, order, parts),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
    return scored


def stream(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The modelled bytes of all rows, and the row of each."""
    empty = np.setdiff1d(np.arange(words.rows), words.document)
    row = np.concatenate([words.document, empty])
    order = np.argsort(row, kind="stable")
    row = row[order]
    starts = np.concatenate([words.starts, words.offsets[empty]])[order]
    lengths = np.concatenate([words.ends - words.starts, np.zeros(len(empty), np.int64)])[order] + 1
    ends = np.cumsum(lengths)
    source = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)
    padded = np.append(_LOWER[words.data], np.uint8(0))
    out = padded[np.minimum(source, len(words.data))]
    out[ends - 1] = _SPACE
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    out[ends[last] - 1] = _END
    return out, np.repeat(row, lengths)


def grams(data: np.ndarray, row: np.ndarray, order: int) -> np.ndarray:
    """`order` bytes before each byte and the byte itself, as one number. Before a text
    stand ends."""
    firsts = np.searchsorted(row, np.arange(row[-1] + 1 if len(row) else 0))
    place = np.arange(len(data)) - firsts[row]
    out = data.astype(np.uint64)
    for j in range(1, order + 1):
        before = np.full(len(data), _END, np.uint64)
        before[j:] = data[:-j]
        before[place < j] = _END
        out |= before << np.uint64(8 * j)
    return out


def _entries(batches: Iterator[pa.RecordBatch], order: int, parts: int) -> Iterator[pa.RecordBatch]:
    block, held = None, ([], [])
    for batch in batches:
        for part, data, offsets in pieces(batch, "text", _PIECE_BYTES):
            for at, to in _stretches(part.column("block").to_numpy()):
                number = part.column("block")[at].as_py()
                if number != block and block is not None:
                    yield from _packed(block, held, parts)
                    held = ([], [])
                block = number
                words = split(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
                learned = ~np.array(part.column("held_out").slice(at, to - at).to_pylist(), bool)
                text, row = stream(words)
                _add(held[0], grams(text, row, order), learned[row])
                ends = np.full(to - at, _END_WORD)
                _add(held[1], np.concatenate([words.hashes, ends]), np.concatenate([learned[words.document], learned]))
    if block is not None:
        yield from _packed(block, held, parts)


def _stretches(blocks: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
    return zip(cuts, cuts[1:])


def _add(held: list, keys: np.ndarray, learned: np.ndarray) -> None:
    known, counts = np.unique(keys[learned], return_counts=True)
    others = np.setdiff1d(np.unique(keys[~learned]), known, assume_unique=True)
    held.append((np.concatenate([known, others]), np.concatenate([counts, np.zeros(len(others), np.int64)])))
    if len(held) > 12:
        held[:] = [_merged(held)]


def _merged(held: list) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
    known, place = np.unique(keys, return_inverse=True)
    return known, np.bincount(place, counts, len(known)).astype(np.int64)


def _part_of(keys: np.ndarray, words: bool, parts: int) -> np.ndarray:
    h = keys if words else (keys >> np.uint64(8)) & np.uint64(0xFFFF)
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(parts)).astype(np.int64)


def _packed(block: int, held: tuple[list, list], parts: int) -> Iterator[pa.RecordBatch]:
    for words, lists in enumerate(held):
        keys, counts = _merged(lists)
        part = _part_of(keys, bool(words), parts)
        order = np.argsort(part, kind="stable")
        keys, counts, part = keys[order], counts[order], part[order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        n = len(full)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([block] * n, pa.int64()), "part": pa.array(full, pa.int32()),
            "words": pa.array([bool(words)] * n, pa.bool_()),
            # Differences of rising numbers: small ones, which pack well.
            "keys": pa.array([_rising(keys[cuts[k] : cuts[k + 1]]) for k in full], pa.binary()),
            "counts": pa.array([counts[cuts[k] : cuts[k + 1]].astype(np.uint32).tobytes() for k in full], pa.binary()),
        })


def _rising(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=np.uint64(0)).tobytes()


def _keys(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, np.uint64), dtype=np.uint64)


def _short_contexts(entries: DataFrame, order: int) -> tuple[np.ndarray, tuple[int, int]]:
    """Counts of (one byte of context, byte), and of all and of different training words."""

    def shorten(batches):
        for batch in batches:
            out = ([], [], [])
            for words, keys, counts in zip(*[batch.column(c).to_pylist() for c in ("words", "keys", "counts")]):
                numbers = np.frombuffer(counts, np.uint32).astype(np.int64)
                if not words:
                    pair, place = np.unique(_keys(keys) & np.uint64(0xFFFF), return_inverse=True)
                    out[0].append(pair.astype(np.int64))
                    out[1].append(np.bincount(place, numbers).astype(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_pydict({"pair": np.concatenate(out[0]), "n": np.concatenate(out[1])})

    pairs = entries.filter("not words").mapInArrow(shorten, "pair bigint, n bigint").groupBy("pair").agg(
        F.sum("n").alias("n")
    ).toArrow()  # 65,536 rows at most
    short = np.zeros((256, 256), np.int64)
    short.reshape(-1)[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()

    def count(group):
        keys, place = np.unique(np.concatenate([_keys(k) for k in group["keys"]]), return_inverse=True)
        n = np.bincount(place, np.concatenate([np.frombuffer(c, np.uint32) for c in group["counts"]]))
        return pd.DataFrame({"n": [int(n.sum())], "v": [int((n > 0).sum())]})

    total = entries.filter("words").groupBy("part").applyInPandas(count, "n bigint, v bigint").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")
    ).first()
    return short, (total["n"] or 0, total["v"] or 0)


def _price(group: pd.DataFrame, short: np.ndarray, order: int) -> pd.DataFrame:
    """For each block the counts of its words, or the log10 probabilities of its entries."""
    keys = [_keys(k) for k in group["keys"]]
    known, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(place, np.concatenate([np.frombuffer(c, np.uint32) for c in group["counts"]]), len(known))
    value = counts if group["words"].iloc[0] else chain_price(known, counts, short, order)
    of_words, values, at = bool(group["words"].iloc[0]), [], 0
    for k in keys:
        values.append(value[place[at : at + len(k)]].astype(np.uint32 if of_words else np.float32).tobytes())
        at += len(k)
    # A block can tell its words in the order it sent them, so their keys need not go back.
    back = [b""] * len(keys) if of_words else group["keys"]
    return pd.DataFrame({
        "block": group["block"], "part": group["part"], "words": group["words"], "keys": back, "counts": values,
    })


def chain_price(known: np.ndarray, counts: np.ndarray, short: np.ndarray, order: int) -> np.ndarray:
    """log10 P(byte | context) for each entry; `known` holds all entries that share the last
    two bytes of a context."""
    n, d, e, c = {}, {}, {}, {}
    of_byte = short.sum(0)
    context, symbol = ((known >> np.uint64(8)) & np.uint64(255)).astype(np.int64), (known & np.uint64(255)).astype(np.int64)
    n[0], d[0], c[0] = np.full(len(known), of_byte.sum()), np.full(len(known), (of_byte > 0).sum()), of_byte[symbol]
    n[1], d[1], c[1] = short.sum(1)[context], (short > 0).sum(1)[context], short[context, symbol]
    e[1] = ((short > 0) * of_byte[None, :]).sum(1)[context]
    shorter, shorter_counts = None, None
    for k in range(2, order + 1):
        entry, place = np.unique(known & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        own = np.bincount(place, counts, len(entry))
        tail = entry & np.uint64((1 << 8 * k) - 1)
        if shorter is None:
            below = short[(tail >> np.uint64(8)).astype(np.int64), (tail & np.uint64(255)).astype(np.int64)]
        else:
            below = shorter_counts[np.searchsorted(shorter, tail)]
        _, owner = np.unique(entry >> np.uint64(8), return_inverse=True)
        n[k] = np.bincount(owner, own)[owner][place]
        d[k] = np.bincount(owner, own > 0)[owner][place]
        e[k] = np.bincount(owner, below * (own > 0))[owner][place]
        c[k] = own[place]
        shorter, shorter_counts = entry, own
    price = np.zeros(len(known))
    waiting, above = np.ones(len(known), bool), np.zeros(len(known), bool)
    for k in range(order, -1, -1):
        here = waiting & (n[k] > 0)
        left = n[k] - np.where(above, e[k + 1], 0) if k < order else n[k]
        kinds = d[k] - np.where(above, d[k + 1], 0) if k < order else d[k]
        coded = here & (c[k] > 0)
        price[coded] += np.log10((2 * c[k][coded] - 1) / (2 * left[coded]))
        escaped = here & ~coded & (kinds > 0)
        price[escaped] += np.log10(kinds[escaped] / (2 * left[escaped]))
        waiting &= ~coded
        above |= here
    unseen = max(1, 256 - int((of_byte > 0).sum()))
    price[waiting] -= np.log10(unseen)
    return price


def _score(texts: pd.DataFrame, prices: pd.DataFrame, n: int, v: int, order: int, parts: int) -> pd.DataFrame:
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts["text"], pa.binary())})
    of_words = prices["words"].to_numpy(bool)
    own = prices[~of_words]
    keys = np.concatenate([np.zeros(0, np.uint64), *map(_keys, own["keys"])])
    values = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(x, np.float32) for x in own["counts"]]])
    by_key = np.argsort(keys)
    tables = [(keys[by_key], values[by_key])]
    met = [np.array([_END_WORD])]
    for _, data, offsets in pieces(batch, "text", _PIECE_BYTES):
        met.append(np.unique(split(data, offsets).hashes))
    known = np.unique(np.concatenate(met))
    sent = np.argsort(_part_of(known, True, parts), kind="stable")
    counted = prices[of_words].sort_values("part")["counts"]
    counts = np.empty(len(known), np.uint32)
    counts[sent] = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(x, np.uint32) for x in counted]])
    tables.append((known, counts))
    look = lambda keys, table: table[1][np.searchsorted(table[0], keys)]
    scores, bases, tokens, knowns = [], [], [], []
    for _, data, offsets in pieces(batch, "text", _PIECE_BYTES):
        words = split(data, offsets)
        text, row = stream(words)
        place, entries = pd.factorize(grams(text, row, order))
        scores.append(np.bincount(row, look(entries, tables[0])[place], words.rows))
        counts = look(np.concatenate([words.hashes, np.full(words.rows, _END_WORD)]), tables[1])
        owner = np.concatenate([words.document, np.arange(words.rows)])
        bases.append(np.bincount(owner, np.log10((counts + ADDED) / (n + ADDED * (v + 1))), words.rows))
        tokens.append(np.bincount(owner, minlength=words.rows))
        knowns.append(np.bincount(owner[counts > 0], minlength=words.rows))
    return pd.DataFrame({
        "doc_id": texts["doc_id"].astype("Int64"), "held_out": texts["held_out"],
        "n_tokens": np.concatenate(tokens), "n_known": np.concatenate(knowns), "train_tokens": n,
        "base_score": np.concatenate(bases), "score": np.concatenate(scores),
    })
