"""Shards of near equal bytes by a k-d tree over the documents' metadata.

Equal texts are one point, which weighs what they weigh together and stands where the one
with the smallest id stands. Only a group that outweighs a shard is cut: each of its rows is
a point of its own. The root holds all points. A node that is to become k shards is cut along
the dimension in which it is widest, where k // 2 of k parts of its bytes lie on one side: a
weighted median. All nodes of a level are cut together.

Dimensions are integers of 16 bits, scaled over the whole table: source, language, length
(logarithm) and id. A node's width in length and id is the distance between its ends, in
source and language, which have no distances, the share of its bytes outside the commonest
value. Points that are equal in the chosen dimension are told apart by a 48-bit tie: the
text's hash, or for rows of a group that is cut 16 bits of it, then 32 of the row's. Median
cuts are exact to a small part of a shard: the position (dimension, then tie) is narrowed
14 bits at a time, each time by summing bytes per node and digit before the shuffle, until a
digit weighs less than `tolerance` of a shard or is one point. Driver and broadcasts see one
row per node. After each level the points, a few numbers each, are written with their node.

Defined cases: a missing text has no bytes and equals an empty one; missing sources,
languages and ids are one value each. Repeated rows are rows of their own, of one group.
Rows equal in every column get neighbouring slots, in either order. Texts are told apart by
length, CRC-32 and a 64-bit hash; those that agree in all three would share a shard.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.tables import steady, store, text_of

DISTANCES, KINDS = ("by_length", "by_id"), ("by_source", "by_lang")
DIMENSIONS = KINDS + DISTANCES
_POINT = ["text_hash", "text_crc32", "size", "cut_row"]
_DIGIT_BITS = 14
_VALUE_BITS, _TIE_BITS = 16, 48
_SLICE_ROWS = 25_000
_COMMON = 1_000

# The chosen dimension's value, then the tie: 62 bits.
_POSITION = (
    "(shiftleft(case dimension " + " ".join(f"when '{d}' then {d}" for d in DIMENSIONS)
    + f" end, {_TIE_BITS - 2}) + shiftright(tie, 2))"
)


@dataclass
class _Cut:
    """Where a node is being cut: rows below (value, tie) go left."""

    node: int
    parts: int
    dimension: str
    goal: float
    below: float = 0.0
    position: int = 0
    open_bits: int = _VALUE_BITS + _TIE_BITS - 2
    width: int = 0


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.002) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = store(_measured(docs), "measured")
    total = rows.agg(F.sum("size").alias("size"), F.count("*").alias("rows")).first()
    if not total["rows"]:
        return _numbered(rows.withColumn("shard", F.lit(0)), 0, shards)
    rows = _with_points(rows, total["size"] / shards)
    leaves = {0: shards}
    placed = store(_points(rows), "points")
    next_node = 1
    while any(parts > 1 for parts in leaves.values()):
        cuts = _cuts(placed, {n: p for n, p in leaves.items() if p > 1}, tolerance * total["size"] / shards)
        table = []
        for cut in cuts:
            left, right = next_node, next_node + 1
            next_node += 2
            table.append((cut.node, cut.dimension, cut.position, left, right))
            leaves[left], leaves[right] = cut.parts // 2, cut.parts - cut.parts // 2
            del leaves[cut.node]
        placed = store(_move(placed, table), "placed")
    numbers = _values(placed, [(node, number) for number, node in enumerate(sorted(leaves))], "node, shard")
    placed = placed.join(F.broadcast(numbers), "node").select(*_POINT, "n", "shard")
    return _numbered(store(_back(rows, placed, total["rows"]), "sharded"), total["rows"], shards)


def _with_points(rows: DataFrame, share: float) -> DataFrame:
    """The rows with the point each belongs to: cut_row is -1, or in groups heavier than a
    shard the row's own number."""
    # As many groups as there are shards at most.
    heavy = rows.groupBy("text_hash", "text_crc32", "size").agg(F.sum("size").alias("weight")).filter(
        F.col("weight") > share
    ).select("text_hash", "text_crc32", "size").collect()
    if not heavy:
        return rows.withColumn("cut_row", F.lit(-1).cast("bigint"))
    table = _values(rows, [(*group, 1) for group in heavy], "text_hash, text_crc32, size, cut")
    cut = F.when(F.col("cut") == 1, F.col("row_id")).otherwise(F.lit(-1))
    return rows.join(F.broadcast(table), ["text_hash", "text_crc32", "size"], "left").withColumn(
        "cut_row", cut.cast("bigint")
    ).drop("cut")


def _points(rows: DataFrame) -> DataFrame:
    """Weight, number of rows, dimensions and tie of every point, all in the root."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *DIMENSIONS)).alias("first")
    points = rows.groupBy(*_POINT).agg(F.sum("size").alias("weight"), F.count("*").alias("n"), first)
    of_text = F.shiftrightunsigned("text_hash", 16)
    of_row = F.shiftrightunsigned("text_hash", 48) * F.lit(1 << 32) + F.shiftrightunsigned(F.xxhash64("cut_row"), 32)
    return points.select(
        *_POINT, "weight", "n", *[F.col(f"first.{d}").alias(d) for d in DIMENSIONS],
        F.when(F.col("cut_row") < 0, of_text).otherwise(of_row).alias("tie"), F.lit(0).cast("bigint").alias("node"),
    )


def _back(rows: DataFrame, placed: DataFrame, n_rows: int) -> DataFrame:
    """The rows with their points' shards. Points of very many rows are broadcast, a
    thousand at most, so that none of them meets in one task."""
    common = F.col("n") * _COMMON > n_rows
    few = F.broadcast(placed.filter(common).drop("n"))
    others = rows.join(F.broadcast(placed.filter(common).select(*_POINT)), _POINT, "left_anti")
    return rows.join(few, _POINT).unionByName(others.join(placed.filter(~common).drop("n"), _POINT))


def _values(like: DataFrame, rows: list[tuple], columns: str) -> DataFrame:
    """A small table of numbers and names, one row per node."""
    listed = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else _number(v) for v in row) + ")" for row in rows)
    return like.sparkSession.sql(f"select * from values {listed} as t({columns})")


def _number(value: int | float) -> str:
    return f"double({value!r})" if isinstance(value, float) else f"bigint({value})"


def _measured(docs: DataFrame) -> DataFrame:
    """Number, size, checksum, hash and the scaled dimensions of every document."""
    docs = steady(docs)
    text = text_of("text").cast("binary")
    code = lambda column: F.when(F.col(column).isNull(), 0).otherwise(
        F.pmod(F.xxhash64(column), F.lit((1 << _VALUE_BITS) - 1)) + 1
    )
    span = docs.agg(F.min("doc_id").alias("low_id"), F.max("doc_id").alias("high_id"))
    top = (1 << _VALUE_BITS) - 1
    width = F.greatest(F.col("high_id").cast("double") - F.col("low_id").cast("double"), F.lit(1.0))
    scaled = F.floor((F.col("doc_id").cast("double") - F.col("low_id").cast("double")) / width * top)
    return docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        code("source").cast("bigint").alias("by_source"),
        code("lang").cast("bigint").alias("by_lang"),
        F.least(F.floor(F.log2(F.octet_length(text) + 8.0) * 2048), F.lit(top)).cast("bigint").alias("by_length"),
        F.xxhash64(text).alias("text_hash"),
    ).join(F.broadcast(span), how="cross").withColumn(
        "by_id", F.coalesce(F.least(F.greatest(scaled, F.lit(0)), F.lit(top)), F.lit(0)).cast("bigint")
    ).drop("low_id", "high_id")


def _cuts(placed: DataFrame, open_nodes: dict[int, int], slack: float) -> list[_Cut]:
    """The cut of every node that is to become more than one shard."""
    spans = placed.filter(F.col("node").isin(list(open_nodes))).groupBy("node").agg(
        F.sum("weight").alias("weight"), *[(F.max(d) - F.min(d)).cast("double").alias(d) for d in DISTANCES]
    )
    for kind in KINDS:
        # At most 65,536 values.
        values = placed.groupBy("node", kind).agg(F.sum("weight").alias("of_value"))
        outside = F.sum("of_value") - F.max("of_value")
        width = (outside / F.sum("of_value") * ((1 << _VALUE_BITS) - 1)).alias(kind)
        spans = spans.join(values.groupBy("node").agg(width), "node")
    cuts = []
    for row in spans.collect():
        parts = open_nodes[row["node"]]
        widest = max(DIMENSIONS, key=lambda d: row[d])
        cuts.append(_Cut(row["node"], parts, widest, row["weight"] * (parts // 2) / parts))
    # A node without points is cut anywhere.
    cuts += [_Cut(node, parts, DIMENSIONS[0], 0.0, open_bits=0)
             for node, parts in open_nodes.items() if node not in {c.node for c in cuts}]
    while narrowing := [cut for cut in cuts if cut.open_bits > 0]:
        for cut in narrowing:
            cut.width = 1 << cut.open_bits
            cut.open_bits = max(0, cut.open_bits - _DIGIT_BITS)
        found = {row["node"]: row for row in _digits(placed, narrowing).collect()}
        for cut in narrowing:
            row = found.get(cut.node)
            if row is None:  # all of the node lies below its goal
                cut.open_bits = 0
                continue
            cut.position += row["digit"] << cut.open_bits
            cut.below += row["before"]
            if row["weight"] <= slack or row["n"] == 1 or cut.open_bits == 0:
                # Put the last digit on the side that comes closer.
                if cut.goal - cut.below > row["weight"] / 2:
                    cut.position += 1 << cut.open_bits
                cut.open_bits = 0
    return cuts


def _digits(placed: DataFrame, cuts: list[_Cut]) -> DataFrame:
    """Per node, the digit of the position at which its bytes reach the goal."""
    state = _values(
        placed,
        [(c.node, c.dimension, c.position, c.open_bits, c.width, float(c.goal - c.below)) for c in cuts],
        "node, dimension, start, open_bits, width, goal",
    )
    return placed.sparkSession.sql(
        f"""
        with inside as (
            select /*+ broadcast(state) */ node, goal, weight, open_bits, width, {_POSITION} - start as offset
            from {{placed}} join {{state}} as state using (node)
        ), sums as (
            select node, goal, shiftright(offset, int(open_bits)) as digit, sum(weight) as weight, count(*) as n
            from inside where offset >= 0 and offset < width
            group by node, goal, digit
        ), running as (
            select *, sum(weight) over (partition by node order by digit) as up_to,
                   max(digit) over (partition by node) as last
            from sums
        )
        select node, min(digit) as digit, min_by(weight, digit) as weight, min_by(n, digit) as n,
               min_by(up_to - weight, digit) as before
        from running where up_to >= goal or digit = last group by node
        """,
        placed=placed, state=state,
    )


def _move(placed: DataFrame, table: list[tuple]) -> DataFrame:
    """Every row of a cut node to the child on its side."""
    cuts = _values(placed, table, "node, dimension, position, left_node, right_node")
    joined = placed.join(F.broadcast(cuts), "node", "left")
    side = F.when(F.expr(_POSITION) < F.col("position"), F.col("left_node")).otherwise(F.col("right_node"))
    return joined.withColumn("node", F.coalesce(side, "node")).select(placed.columns)


def _numbered(placed: DataFrame, n_rows: int, shards: int) -> DataFrame:
    """Slots without gaps: each shard is numbered in slices, one after the other."""
    slices = max(1, -(-n_rows // (shards * _SLICE_ROWS)))
    sliced = placed.withColumn("slice", F.pmod(F.xxhash64("row_id"), F.lit(slices)))
    counts = sliced.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("shard"), F.col("slice"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size", "row_id")
    return (
        sliced.withColumn("rank", F.row_number().over(within) - 1)
        .join(starts, ["shard", "slice"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("start") + F.col("rank")).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
