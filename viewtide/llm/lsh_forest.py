"""Near-duplicate join on word shingles with a MinHash LSH forest.

A document is the set of its five-word shingles (all its words if it has fewer). Documents
with one set are one class and go on as one row. MinHash signatures are arranged in
`TREES` trees. A tree is a prefix trie of its part of the signatures, laid out as rows sorted
by their path; branches that hold a single class at the shortest prefix are left out at once.
Matching starts with the longest prefix, where nearly every candidate is a link, and goes up
one level at a time until a pair at the threshold meets in some tree with the target recall.
What deeper levels have linked is one component by then, and only prefixes under which
different components meet are looked at again.

Candidates are verified on their whole shingle sets where they meet: from the smallest
member on, each member reached is compared with all that are not reached yet, so every
member that any link of the prefix ties to a component joins it, while most are reached
from the first one. A prefix with more than `BLOCK` members takes three rounds: within blocks,
then among one member of each component, which ties a group of near copies together however
large, then every member outside the largest component with all others, in pairs of blocks.
Links are closed to components after each round.

Both ends of a link are in one component, so the links are counted when the components are
known: in each of them every set is compared with every other, whether or not the two have
met in a tree. Only counts leave the tasks. A component with more than `BLOCK` members is cut
by the sizes of the sets, and then into blocks that are compared in pairs.

Result per document: class_id (smallest id of its component), copies (documents with its
very set), n_links (the other sets at the threshold in its component, plus its copies).

Column names that begin with `_lsh_row` are reserved in `first_of_each`. Defined cases: a missing text is empty, and documents without words are copies of each
other. Documents without an id take part; a class of only such has no class_id. Repeated
rows are copies. Words are in lower case (A-Z).
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import reserved, steady, store, text_of
from viewtide.llm.words import mix, pieces, shingles, split

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEEPEST = 8
RECALL = 0.998
BLOCK = 1000
_NUMBER = "_lsh_row"
_FACTORS = mix(np.arange(1, TREES * DEEPEST + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def depth_for(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold is met with the target recall."""
    depth = DEEPEST
    while depth > 1 and 1 - (1 - threshold**depth) ** TREES < recall:
        depth -= 1
    return depth


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """row_id, doc_id, class_id, class_row, copies, n_links; row numbers are those of `steady(docs)`."""
    signed, classes, sets, labels = _tied(docs, threshold, recall)
    classes = classes.join(_degrees(labels, sets, threshold), "member", "left")
    return _classed(signed, classes, labels).select(
        "row_id", "doc_id", "class_id", "class_row", "copies",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )


def _tied(docs: DataFrame, threshold: float, recall: float) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The documents, the classes of one set each, the sets of those that meet, and their components."""
    last = depth_for(threshold, recall)
    number = F.monotonically_increasing_id()
    texts = steady(docs).select(number.alias("row_id"), F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    signed = store(texts.mapInArrow(
        lambda batches: _sign(batches, last),
        "row_id bigint, doc_id bigint, content binary, paths array<array<bigint>>",
    ), "signed")
    # Copies: the row with the smallest id stands for all.
    classes = store(
        signed.groupBy("content").agg(
            F.min_by("row_id", _order()).alias("member"), F.count("*").alias("copies"),
            F.min_by("paths", _order()).alias("paths"),
        ), "classes",
    )
    forest = _forest(classes)
    wanted = store(forest.select("member").distinct(), "wanted")
    sets = store(
        texts.select("row_id", "text").join(wanted, F.col("row_id") == F.col("member"))
        .select("member", "text").mapInArrow(_sets, "member bigint, size bigint, shingles binary"), "sets",
    )
    links = store(wanted.select(F.col("member").alias("a"), F.col("member").alias("b")).limit(0), "links")
    labels = wanted.select("member", F.col("member").alias("label"))
    for depth in range(DEEPEST, last - 1, -1):
        meetings = forest.select("member", "tree", F.col("path")[depth - last].alias("prefix"))
        for pick in (_within, _heads, _across):
            crowds = _crowds(meetings.join(labels, "member"), 1 if pick is _within else BLOCK)
            if crowds.isEmpty():
                break
            groups = pick(meetings.join(labels, "member").join(crowds, ["tree", "prefix"]))
            found = store(_links(groups, sets, threshold), "links")
            if not found.isEmpty():
                links = store(links.union(found).distinct(), "links")
                labels = components(wanted, links)
    return signed, classes, sets, labels


def _order() -> Column:
    """The row with the smallest id first, rows without one last."""
    return F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "row_id")


def _classed(signed: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with what their class has, class_id and class_row."""
    summed = classes.drop("paths").join(labels, "member", "left").withColumn("label", F.coalesce("label", "member"))
    rows = signed.select("row_id", "doc_id", "content").join(summed, "content")
    firsts = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.min_by("row_id", _order()).alias("class_row"))
    return rows.join(firsts, "label")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest id."""
    reserved(docs, _NUMBER)
    docs = steady(docs)
    signed, classes, _, labels = _tied(docs, THRESHOLD, RECALL)
    kept = store(_classed(signed, classes, labels).filter("row_id = class_row").select(F.col("row_id").alias(_NUMBER)), "kept")
    return docs.withColumn(_NUMBER, F.monotonically_increasing_id()).join(kept, _NUMBER, "left_semi").select(docs.columns)


def _sign(batches: Iterator[pa.RecordBatch], last: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in pieces(batch, "text"):
            values, cuts = shingles(split(data, offsets), SHINGLE)
            n = part.num_rows
            filled = np.flatnonzero(cuts[1:] > cuts[:-1])
            signature = np.full((n, TREES * DEEPEST), np.iinfo(np.uint64).max, np.uint64)
            content = np.zeros((n, 2), np.uint64)
            if len(values):
                product = np.empty_like(values)
                for k, factor in enumerate(_FACTORS):
                    np.multiply(values, factor, out=product)
                    signature[filled, k] = np.minimum.reduceat(product, cuts[filled])
                content[filled, 0] = np.add.reduceat(mix(values ^ np.uint64(0x5555)), cuts[filled])
                content[filled, 1] = np.add.reduceat(mix(values + np.uint64(77)), cuts[filled])
            parts = signature.reshape(n, TREES, DEEPEST)
            yield pa.RecordBatch.from_pydict({
                "row_id": part.column("row_id"), "doc_id": part.column("doc_id"),
                "content": pa.array([row.tobytes() for row in content], pa.binary()),
                "paths": _paths(parts, last),
            })


def _paths(parts: np.ndarray, last: int) -> pa.Array:
    """Per row and tree the hashes of its prefixes, from the shortest that is looked at to the longest."""
    key, levels = np.zeros(parts.shape[:2], np.uint64), []
    for level in range(DEEPEST):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, level] + np.uint64(level))
        levels.append(key)
    path = np.stack(levels[last - 1 :], axis=2).view(np.int64)
    rows, trees, depths = path.shape
    inner = pa.ListArray.from_arrays(pa.array(np.arange(rows * trees + 1, dtype=np.int32) * depths), pa.array(path.reshape(-1)))
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * trees), inner)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in pieces(batch, "text"):
            values, cuts = shingles(split(data, offsets), SHINGLE)
            lists = [values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_pydict({
                "member": part.column("member"), "size": pa.array(np.diff(cuts), pa.int64()), "shingles": pa.array(lists, pa.binary()),
            })


def _forest(classes: DataFrame) -> DataFrame:
    """The tries: member, tree and path, sorted, where a class is not alone under its shortest prefix."""
    rows = classes.select("member", F.posexplode("paths").alias("tree", "path")).withColumn("root", F.col("path")[0])
    met = rows.groupBy("tree", "root").agg(F.count("*").alias("n")).filter("n > 1")
    order = ["tree", "path", "member"]
    shared = rows.join(met, ["tree", "root"], "left_semi").select(order)
    return store(shared.repartitionByRange(*order).sortWithinPartitions(*order), "forest")


def _crowds(meetings: DataFrame, more_than: int) -> DataFrame:
    """Prefixes with more members than that, under which different components meet."""
    crowds = meetings.groupBy("tree", "prefix").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.sum(F.xxhash64("member").cast("decimal(38,0)")).alias("who"),
    ).filter((F.col("low") < F.col("high")) & (F.col("n") > more_than))
    # The same members often meet in several trees: once is enough.
    once = crowds.groupBy("who", "n").agg(F.min(F.struct("tree", "prefix")).alias("at"))
    return store(once.select("at.tree", "at.prefix", "n"), "crowds")


_GROUP = ("tree", "prefix", "block_a", "block_b")


def _block(n: str) -> Column:
    return F.pmod(F.xxhash64("member"), F.ceil(F.col(n) / BLOCK)).cast("int")


def _within(rows: DataFrame) -> DataFrame:
    """Each block by itself: all there is to do where it is the only one."""
    return rows.withColumn("block_a", _block("n")).withColumn("block_b", F.col("block_a"))


def _heads(rows: DataFrame) -> DataFrame:
    """One member of each component."""
    heads = rows.groupBy("tree", "prefix", "label").agg(F.min("member").alias("member"))
    counts = heads.groupBy("tree", "prefix").agg(F.count("*").alias("n"))
    return _within(heads.join(counts, ["tree", "prefix"]))


def _across(rows: DataFrame) -> DataFrame:
    """All pairs of blocks, but for two that are of the prefix's largest component.

    Each member of that component is sent once for every block of others.
    """
    sizes = rows.groupBy("tree", "prefix", "label").agg(F.count("*").alias("n_label"))
    largest = sizes.groupBy("tree", "prefix").agg(
        F.max("n_label").alias("n_base"), F.max_by("label", F.struct("n_label", "label")).alias("base")
    )
    sized = rows.join(largest, ["tree", "prefix"]).withColumn("n_others", F.col("n") - F.col("n_base"))
    first_other = F.ceil(F.col("n_base") / BLOCK).cast("int")
    end = first_other + F.ceil(F.col("n_others") / BLOCK).cast("int")
    in_base = F.col("label") == F.col("base")
    own = F.when(in_base, _block("n_base")).otherwise(first_other + _block("n_others"))
    partners = F.sequence(F.when(in_base, first_other).otherwise(F.lit(0)), end - 1)
    return sized.withColumn("own", own).withColumn("other", F.explode(partners)).withColumns(
        {"block_a": F.least("own", "other"), "block_b": F.greatest("own", "other")}
    )


def _links(groups: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Verified links (a < b) between components that meet in a group."""
    return groups.select(*_GROUP, "member", "label").join(sets.drop("size"), "member").groupBy(*_GROUP).applyInPandas(
        lambda members: _verify(members, threshold), "a bigint, b bigint"
    ).distinct()


def _verify(members: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links that tie the components of a group together, each member reached once.

    Not all of the group's links: those are counted in `_degrees`.
    """
    members = members.sort_values("member")
    ids, labels = members["member"].to_numpy(), members["label"].to_numpy()
    lists = [np.frombuffer(x, np.uint64) for x in members["shingles"]]
    sizes = np.array([len(x) for x in lists])
    codes = np.unique(np.concatenate(lists), return_inverse=True)[1] if sizes.sum() else np.zeros(0, np.int64)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(codes.max() + 1 if len(codes) else 0, np.int64)
    left, links = np.ones(len(ids), bool), []
    while left.any():
        queue = [int(np.flatnonzero(left)[0])]
        left[queue] = False
        while queue and left.any():
            # What an earlier depth has linked to a reached member is reached as well.
            with_it = np.flatnonzero(left & np.isin(labels, labels[queue]))
            left[with_it] = False
            queue += with_it.tolist()
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            k = queue.pop(0)
            own = codes[cuts[k] : cuts[k + 1]]
            marked[own] = 1
            sums = np.concatenate([[0], np.cumsum(marked[codes])])
            marked[own] = 0
            common = (sums[cuts[1:]] - sums[cuts[:-1]])[rest]
            union = sizes[rest] + sizes[k] - common
            near = rest[(common >= math.nextafter(threshold, 0) * union) & (union > 0)]
            links += [(ids[k], ids[n]) for n in near]
            left[near] = False
            queue += near.tolist()
    return pd.DataFrame([(min(p), max(p)) for p in links], columns=["a", "b"], dtype="int64")


def _degrees(labels: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """member and n, the links of its set: of all pairs of its component, each compared once."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("n_label")).filter("n_label > 1")
    tied = store(labels.join(sizes, "label").join(sets.select("member", "size"), "member"), "tied")
    bundles = math.ceil(tied.count() / BLOCK) or 1
    small = tied.filter(F.col("n_label") <= BLOCK).select(
        F.pmod(F.xxhash64("label"), F.lit(bundles)).alias("crowd"), *[F.lit(k).alias(c) for c, k in zip(_CELL[1:], (-1, -1, 0, 0))],
        F.lit(False).alias("second"), "label", "member",
    )
    cells = small.unionByName(_cells(tied.filter(F.col("n_label") > BLOCK), threshold))
    return cells.join(sets.select("member", "shingles"), "member").groupBy(*_CELL).applyInPandas(
        lambda members: _count(members, threshold), "member bigint, n bigint"
    ).groupBy("member").agg(F.sum("n").alias("n"))


_CELL = ("crowd", "low", "high", "block_a", "block_b")


def _cells(tied: DataFrame, threshold: float) -> DataFrame:
    """Large components in cells of two blocks, for every pair that can be linked.

    The smaller of two linked sets has at least the threshold's share of the larger one, so
    with levels a little wider than that they are on one level or on two that adjoin.
    """
    level = F.floor(F.log("size") / -math.log(0.999 * threshold)).cast("int")
    leveled = tied.select("label", "member", level.alias("level"))
    blocks = leveled.groupBy("label", "level").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    below = blocks.select("label", (F.col("level") + 1).alias("level"), F.col("blocks").alias("below"))
    above = blocks.select("label", (F.col("level") - 1).alias("level"), F.col("blocks").alias("above"))
    placed = leveled.join(blocks, ["label", "level"]).join(below, ["label", "level"], "left").join(above, ["label", "level"], "left")
    own = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")

    def partners(count: str, cell: Callable[[Column], Column]) -> Column:
        n = F.coalesce(count, F.lit(0))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), cell)

    def cell(low: Column, high: Column, a: Column, b: Column, second: Column) -> Column:
        return F.struct(low.alias("low"), high.alias("high"), a.alias("block_a"), b.alias("block_b"), second.alias("second"))

    here = F.col("level")
    met = F.concat(
        partners("blocks", lambda k: cell(here, here, F.least("own", k), F.greatest("own", k), F.col("own") > k)),
        partners("above", lambda k: cell(here, here + 1, F.col("own"), k, F.lit(False))),
        partners("below", lambda k: cell(here - 1, here, k, F.col("own"), F.lit(True))),
    )
    return placed.withColumn("own", own).select("label", "member", F.explode(met).alias("cell")).select(
        F.col("label").alias("crowd"), "cell.*", "label", "member"
    )


def _count(members: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of each member: within a block, or where there are two, between them."""
    low, high, a, b = (members[c].iloc[0] for c in _CELL[1:])
    members = members.sort_values(["label", "member"])
    ids, second = members["member"].to_numpy(), members["second"].to_numpy()
    lists = [np.frombuffer(x, np.uint64) for x in members["shingles"]]
    sizes = np.array([len(x) for x in lists])
    labels = members["label"].to_numpy()
    borders = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1), len(ids)]
    n = np.zeros(len(ids), np.int64)
    for start, end in zip(borders, borders[1:]):
        common = _common(lists[start:end])
        size, side = sizes[start:end], second[start:end]
        union = size[:, None] + size[None, :] - common
        near = (common >= math.nextafter(threshold, 0) * union) & (union > 0)
        near &= np.tri(end - start, k=-1, dtype=bool).T
        if (low, a) != (high, b):
            near &= side[:, None] != side[None, :]
        n[start:end] = near.sum(axis=0) + near.sum(axis=1)
    return pd.DataFrame({"member": ids, "n": n})[n > 0]


_RARE, _WIDE = 32, 2048


def _common(lists: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set shares with each later one.

    Rare shingles are counted by their pairs of sets, the others as a product of matrices.
    """
    count = len(lists)
    found, codes = np.unique(np.concatenate(lists), return_inverse=True)
    rows = np.repeat(np.arange(count), [len(x) for x in lists])
    order = np.argsort(codes, kind="stable")
    codes, rows = codes[order], rows[order]
    times = np.bincount(codes, minlength=len(found))
    common = np.zeros((count, count), np.int64)
    rare = times[codes] <= _RARE
    few, at = codes[rare], rows[rare]
    for apart in range(1, min(_RARE, count)):
        same = few[apart:] == few[:-apart]
        if not same.any():
            break
        np.add.at(common, (at[:-apart][same], at[apart:][same]), 1)
    many = np.flatnonzero(times > _RARE)
    for start in range(0, len(many), _WIDE):
        chosen = many[start : start + _WIDE]
        first, last = np.searchsorted(codes, [chosen[0], chosen[-1] + 1])
        held = np.zeros((count, len(chosen)), np.float32)
        inside = times[codes[first:last]] > _RARE
        held[rows[first:last][inside], np.searchsorted(chosen, codes[first:last][inside])] = 1
        common += (held @ held.T).astype(np.int64)
    return common


def components(members: DataFrame, links: DataFrame) -> DataFrame:
    """member and label, the smallest member that its links lead to.

    Every round, each member takes the smallest label next to it and then that one's own
    label, so paths shorten by half at least; each round is written down.
    """
    pairs = store(links.select("a", "b").union(links.select("b", "a")).distinct(), "pairs")
    linked = store(pairs.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "member"), "labels")
    while True:
        near = pairs.join(linked.withColumnRenamed("member", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        closer = linked.join(near.withColumnRenamed("a", "member"), "member").select(
            "member", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        jump = linked.select(F.col("member").alias("label"), F.col("label").alias("further"))
        moved = store(
            closer.join(jump, "label", "left").select(
                "member", "before", F.least("label", "further").alias("label")
            ), "labels",
        )
        linked = moved.select("member", "label")
        if moved.filter("label < before").isEmpty():
            break
    return store(
        members.join(linked, "member", "left").select("member", F.coalesce("label", "member").alias("label")), "labels"
    )
