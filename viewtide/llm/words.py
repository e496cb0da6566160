"""Words of whole Arrow batches as arrays, without a Python loop over them."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, bool)
SPACES[[*range(9, 14), 32]] = True
# White space and ASCII punctuation.
BREAKS = SPACES.copy()
BREAKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


@dataclass
class Words:
    """`document[k]` is the row of word k, `hashes[k]` its 64-bit hash."""

    rows: int
    data: np.ndarray
    offsets: np.ndarray
    document: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about `most` bytes of text (one document at least), their bytes and offsets."""
    texts = batch.column(column)
    if not batch.num_rows:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + batch.num_rows + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def split(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES) -> Words:
    """Words between `breaks`, hashed with A-Z in lower case."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(len(offsets) - 1, data, offsets, none, none, none, np.zeros(0, np.uint64))
    gap = breaks[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[filled] = True
    after[filled[1:] - 1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * power(n, True), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * power(n, False)[starts])
    return Words(len(offsets) - 1, data, offsets, np.searchsorted(offsets, starts, "right") - 1, starts, ends, hashes)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of `size` consecutive words per row, and where each row's begin.

    A row of fewer words has one shingle of all its words, a row without words none.
    """
    h, doc = words.hashes, words.document
    counts = np.bincount(doc, minlength=words.rows)
    parts, owners = [], []
    if len(h) >= size:
        full = doc[size - 1 :] == doc[: len(doc) - size + 1]
        parts.append(_chain([h[j : len(h) - size + 1 + j] for j in range(size)])[full])
        owners.append(doc[: len(doc) - size + 1][full])
    firsts = np.concatenate([[0], np.cumsum(counts)])
    for n in range(1, size):
        rows = np.flatnonzero(counts == n)
        if len(rows):
            parts.append(_chain([h[firsts[rows] + j] for j in range(n)]))
            owners.append(rows)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(words.rows + 1, np.int64)
    values, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(words.rows + 1))


def _chain(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        h = (h ^ column) * np.uint64(0x100000001B3) + (h >> np.uint64(29))
    return mix(h)


def power(n: int, up: bool) -> np.ndarray:
    known = _powers[up]
    if len(known) < n:
        factor = np.full(max(n, 2 * len(known), 1 << 16), _BASE if up else _INVERSE, np.uint64)
        factor[0] = 1
        known = _powers[up] = np.cumprod(factor)
    return known[:n]
