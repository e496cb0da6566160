"""Removal of repeated passages by sorting suffixes.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same one. For that, equal strings have to be brought
together, which a sort of the text's suffixes does. A sorted suffix per byte would be a
hundred times the input, so the array is sparse: of every window of `LENGTH` bytes the
32-byte stretch with the lowest hash is its anchor. That depends on nothing but the
window's bytes, so equal windows have equal anchors at equal places, and neighbouring
windows mostly share one. Suffixes start at anchors, each carrying the bytes of the windows
it anchors. Anchors that occur once in the whole corpus cannot take part in a repeat and
are left out after counting their hashes. An anchor that occurs twice in a piece of text, two
megabytes, is repeated for sure: only its first place is counted at its hash, and the rest
are spread out, as are all its places in later pieces of the task.

The suffixes are dealt over ranges by sampled splitters on their leading bytes, then
document and position. Within a range, the windows of each anchor are sorted by multikey
quicksort, eight bytes at a time (of suffixes that are equal in all they carry only the first): classes that are equal so far are split by the next key,
until their rows are equal in all that is left. Of each class the first in order stays. An
anchor that is very frequent fills several ranges; so the first and the last anchor of each
range are compared across boundaries, by a digest of the windows that were first there.

Defined cases: a missing text is empty. Documents without an id come last. Rows with equal
ids stand in the order they are read in. Texts shorter than `LENGTH` bytes stay whole.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.tables import steady, text_of
from viewtide.llm.words import power, mix, pieces

LENGTH = 100
GRAM = 32
_SPREAD = LENGTH - GRAM + 1
_PLACE_BITS = 30
_KEY_BITS = np.uint64((1 << 64) - (1 << 16))
_WINDOWS_AT_ONCE = 200_000
# Hashes a task remembers as repeated, half a megabyte; more are only told of again.
_MOST_TOLD = 65_536
_FOUND = "row_id bigint, doc_id bigint, low int, high int, digest binary"


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept text."""
    rows = steady(docs).select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("bigint").alias("doc_id"),
        text_of("text").cast("binary").alias("text"),
    )
    # Both joins find the same condition on the id, and so share one shuffle of the texts.
    packed = rows.mapInArrow(_pack, "row_id bigint, doc_id bigint, packed binary, size bigint").filter("row_id is not null")
    anchors = rows.select("row_id", "text").mapInArrow(_anchors, "key bigint, row_id bigint, run bigint")
    times = F.count("*").over(Window.partitionBy("key"))
    sure = F.col("run").bitwiseAND(1) == 1
    repeated = anchors.withColumn("times", times).filter(sure | (F.col("times") > 1))
    per_row = repeated.groupBy("row_id").agg(F.collect_list("run").alias("runs"))
    suffixes = packed.join(per_row, "row_id").mapInArrow(
        _suffixes, "lead binary, doc_id bigint, row_id bigint, run bigint, around binary"
    )
    order = [F.col("lead"), F.col("doc_id").asc_nulls_last(), F.col("row_id"), F.col("run")]
    found = suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_repeats, _FOUND)
    # Rows with a digest were first in their range, and are removed if another range has
    # an earlier one; a digest has a row per range at most. The others are removed for sure.
    earlier = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last(), "row_id", "low")
    sure = F.octet_length("digest") < 16
    removed = found.withColumn("rank", F.row_number().over(earlier)).filter(sure | (F.col("rank") > 1))
    spans = removed.groupBy("row_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return packed.join(spans, "row_id", "left").select("doc_id", "packed", "size", "spans").mapInArrow(
        _cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle, which both joins share."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        texts = batch.column("text")
        yield pa.RecordBatch.from_pydict({
            "row_id": batch.column("row_id"), "doc_id": batch.column("doc_id"),
            "packed": pa.array([codec.compress(t, asbytes=True) for t in texts.to_pylist()], pa.binary()),
            "size": pc.binary_length(texts).cast(pa.int64()),
        })


def _unpack(batches: Iterator[pa.RecordBatch], most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` bytes of text (one document at least) with their texts."""
    codec = pa.Codec("zstd")
    for batch in batches:
        sizes = batch.column("size").to_pylist()
        at = 0
        while at < batch.num_rows:
            to, total = at + 1, sizes[at]
            while to < batch.num_rows and total + sizes[to] <= most:
                total, to = total + sizes[to], to + 1
            part = batch.slice(at, to - at)
            texts = [codec.decompress(t, decompressed_size=n, asbytes=True) if n else b""
                     for t, n in zip(part.column("packed").to_pylist(), sizes[at:to])]
            yield part.append_column("text", pa.array(texts, pa.binary()))
            at = to


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    told = np.zeros(0, np.uint64)
    for batch in batches:
        for part, data, offsets in pieces(batch, "text"):
            ids = part.column("row_id").to_numpy()
            low, n, at, hashes, row = anchor_runs(data, offsets)
            key, sure, told = spread_repeats(hashes, ids[row], low, told)
            # Fewer bits weigh less; anchors that meet by chance are told apart when they are sorted.
            key &= _KEY_BITS
            # First window; number of windows and distance of the anchor, at most 69 each.
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(key.view(np.int64)), "row_id": pa.array(ids[row]),
                "run": pa.array(low << 15 | n << 8 | at - low << 1 | sure),
            })


def spread_repeats(
    hashes: np.ndarray, row_ids: np.ndarray, low: np.ndarray, told: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The key to count each anchor by, whether it is repeated for sure, and the hashes
    already told to be repeated.

    The first place in a piece stands at the hash, unless an earlier piece has told of it;
    the others at a key of their own. What `told` forgets is only told once more.
    """
    values, first, inverse, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    known = np.isin(values, told)
    sure = ((times > 1) | known)[inverse]
    stands = np.zeros(len(hashes), bool)
    stands[first[~known]] = True
    own = mix(mix(row_ids.astype(np.uint64)) + low.astype(np.uint64))
    fresh = values[(times > 1) & ~known]
    return np.where(stands, hashes, own), sure, np.concatenate([told, fresh])[-_MOST_TOLD:]


def anchor_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: first window, number, anchor (all within
    the document), the anchor's hash, the document."""
    lengths = np.diff(offsets)
    windows = np.maximum(0, lengths - LENGTH + 1)
    if not windows.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), none
    total = len(data)
    sums = np.zeros(total + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power(total, True), out=sums[1:])
    hashes = mix((sums[GRAM:] - sums[:-GRAM]) * power(total - GRAM + 1, False))
    # Hash, then place: the leftmost of equal ones. Both decide alike in equal windows.
    keyed = (hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least(keyed, _SPREAD)
    row = np.repeat(np.arange(len(lengths)), windows)
    firsts = np.concatenate([[0], np.cumsum(windows)])[:-1]
    start = np.arange(len(row)) - firsts[row] + offsets[:-1][row]
    anchor = (least[start] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    run = np.flatnonzero(new)
    row, low = row[run], start[run]
    return low - offsets[row], np.diff(run, append=len(start)), anchor[run] - offsets[row], hashes[anchor[run]], row


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours: of a block's end and the next one's beginning."""
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _unpack(batches):
        for part, data, offsets in pieces(batch, "text"):
            lists = part.column("runs")
            run = lists.flatten().to_numpy()
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            low, n, ahead = _parts_of(run)
            start = low + offsets[row]
            lengths = n + LENGTH - 1
            ends = np.cumsum(lengths)
            source = np.arange(ends[-1]) - np.repeat(ends - lengths - start, lengths)
            # The anchor itself goes as the lead; here it is left out.
            begin = np.repeat(start + ahead, lengths)
            source = source[(source < begin) | (source >= begin + GRAM)]
            leads = (start + ahead)[:, None] + np.arange(GRAM)
            yield pa.RecordBatch.from_pydict({
                "lead": _binary(data[leads].reshape(-1), np.arange(1, len(run) + 1) * GRAM),
                "doc_id": part.column("doc_id").take(pa.array(row)), "row_id": part.column("row_id").take(pa.array(row)),
                "run": pa.array(run), "around": _binary(data[source], np.cumsum(lengths - GRAM)),
            })


def _parts_of(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return run >> 15, run >> 8 & 127, run >> 1 & 127


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeats of one range, whose rows come in order; whole anchors at a time."""
    held, n_held, open_lead, first = [], 0, None, True
    for batch in batches:
        leads = batch.column("lead")
        others = np.flatnonzero(pc.not_equal(leads, leads[-1]).to_numpy(zero_copy_only=False))
        # Up to here anchors are complete; the last one may go on in the next batch.
        done = int(others[-1]) + 1 if len(others) else 0
        ended = done or leads[-1] != open_lead
        if ended and n_held + done >= 4000:
            yield from _sorted_out(pa.Table.from_batches([*held, batch.slice(0, done)]), first, False)
            held, n_held, first = [], 0, False
            batch = batch.slice(done)
        held.append(batch)
        n_held, open_lead = n_held + batch.num_rows, leads[-1]
    if n_held:
        yield from _sorted_out(pa.Table.from_batches(held), first, True)


def _sorted_out(rows: pa.Table, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
    leads = rows.column("lead").to_numpy()
    change = np.ones(len(leads), bool)
    change[1:] = leads[1:] != leads[:-1]
    group = np.cumsum(change) - 1
    low, n, before = _parts_of(rows.column("run").to_numpy())
    # Suffixes that equal an earlier one in all they carry are repeats with all their windows.
    code = rows.column("around").combine_chunks().dictionary_encode().indices.to_numpy()
    fresh = np.sort(np.unique((group * len(code) + code) * 128 + before, return_index=True)[1])
    copies = np.delete(np.arange(len(code)), fresh)
    yield _removed(rows.take(pa.array(copies)), low[copies], low[copies] + n[copies] + LENGTH - 1)
    edge = ((group == 0) & first) | ((group == group[-1]) & last)
    rows = rows.take(pa.array(fresh)).combine_chunks()
    leads, group, edge, low, n, before = (x[fresh] for x in (leads, group, edge, low, n, before))
    row_ids = rows.column("row_id").to_numpy()
    texts = [x[:k] + lead + x[k:] for x, k, lead in zip(rows.column("around").to_pylist(), before.tolist(), leads.tolist())]
    places = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    data = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
    repeated = np.zeros(int(n.sum()), bool)
    starts = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(n)), n)
    shift = np.arange(len(owner)) - starts[owner]
    # How far before its anchor a window starts: equal windows have that in common.
    ahead = before[owner] - shift
    by_anchor = group[owner] * LENGTH + ahead
    for part in _portions(by_anchor):
        windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH + 4)[places[owner[part]] + shift[part]].copy()
        windows[:, LENGTH:] = 0
        classes = multikey_classes(windows.view(np.uint64), by_anchor[part])
        firsts = np.ones(len(part), bool)
        order = np.argsort(classes, kind="stable")
        firsts[order[1:]] = classes[order[1:]] != classes[order[:-1]]
        repeated[part[~firsts]] = True
    # Neighbouring repeated windows of a suffix make one stretch.
    opens, closes = repeated.copy(), repeated.copy()
    opens[1:] &= ~repeated[:-1] | (owner[1:] != owner[:-1])
    closes[:-1] &= ~repeated[1:] | (owner[1:] != owner[:-1])
    opens, closes = np.flatnonzero(opens), np.flatnonzero(closes)
    suffix = owner[opens]
    yield _removed(rows.take(pa.array(suffix)), low[suffix] + shift[opens], low[suffix] + shift[closes] + LENGTH)
    open_ended = np.flatnonzero(edge[owner] & ~repeated)
    if len(open_ended):
        suffix, t = owner[open_ended], shift[open_ended]
        digests = [hashlib.blake2b(texts[k][a : a + LENGTH], digest_size=16).digest()
                   for k, a in zip(suffix.tolist(), t.tolist())]
        begin = low[suffix] + t
        yield _found(row_ids[suffix], rows.column("doc_id").take(pa.array(suffix)), begin, begin + LENGTH, pa.array(digests, pa.binary()))


def _removed(rows: pa.Table, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Stretches that are removed whatever other ranges hold."""
    row_ids = rows.column("row_id").to_numpy()
    # Shorter than a digest; only spreads them.
    marks = mix(mix(row_ids.astype(np.uint64)) + low.astype(np.uint64)).astype(np.uint32)
    return _found(row_ids, rows.column("doc_id"), low, high, _binary(marks.view(np.uint8), np.arange(1, len(low) + 1) * 4))


def _found(row_id: np.ndarray, doc_id: pa.Array, low: np.ndarray, high: np.ndarray, digest: pa.Array) -> pa.RecordBatch:
    if isinstance(doc_id, pa.ChunkedArray):
        doc_id = doc_id.combine_chunks()
    return pa.RecordBatch.from_arrays(
        [pa.array(row_id), doc_id, pa.array(low, pa.int32()), pa.array(high, pa.int32()), digest],
        names=["row_id", "doc_id", "low", "high", "digest"],
    )


def _portions(key: np.ndarray) -> Iterator[np.ndarray]:
    """Positions in portions of bounded size; those of one key stay together, in order."""
    order = np.argsort(key, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(key[order])) + 1, len(order))
    start, before = 0, 0
    for end in ends.tolist():
        if end - start > _WINDOWS_AT_ONCE and before > start:
            yield np.sort(order[start:before])
            start = before
        before = end
    yield np.sort(order[start:])


def multikey_classes(keys: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Numbers that are equal for rows equal in group and all keys.

    Multikey quicksort on whole columns: rows that are equal so far are parted by their
    next key; a class whose rows equal its first one in all further keys is done.
    """
    classes = np.unique(group, return_inverse=True)[1].astype(np.int64)
    fresh = int(classes.max()) + 1 if len(classes) else 0
    active, depth = np.arange(len(classes)), 0
    while len(active) and depth < keys.shape[1]:
        key, owner = keys[active, depth], classes[active]
        order = np.lexsort((key, owner))
        active, key, owner = active[order], key[order], owner[order]
        new = np.ones(len(active), bool)
        new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        number = np.cumsum(new) - 1
        classes[active] = fresh + number
        fresh += int(number[-1]) + 1
        lead = active[new][number]
        same = (keys[active, depth + 1 :] == keys[lead, depth + 1 :]).all(axis=1)
        open_classes = np.bincount(number, ~same) > 0
        active = active[open_classes[number]]
        depth += 1
    return classes


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _unpack(batches):
        out: list[tuple] = []
        for doc_id, text, spans in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")]):
            kept, end, removed, n_spans = [], 0, 0, 0
            covered = -1
            for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
                if low > covered:
                    n_spans += 1
                kept.append(text[end:low] if low > end else b"")
                removed += max(0, high - max(low, end))
                end, covered = max(end, high), max(covered, high)
            kept = b"".join([*kept, text[end:]])
            out.append((doc_id, len(text), removed, n_spans, hashlib.sha256(kept).hexdigest(), kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)] if out else
                                         [pa.array([], k) for k in kinds], names=names)
