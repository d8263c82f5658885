"""Shards of near-equal bytes by k-d tree partitioning over document metadata.  DataFrame functions only."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomline.llm.common import dropped, id_kind, written

#: Metadata dimensions, in the order that breaks ties of width.
DIMENSIONS = ("size", "lang_code", "source_code", "arrival")
#: What decides among rows of one value: the rest of the id, then the number that the row has in the metadata table.
TIES = ("arrival", "arrival_low", "serial")
#: A split narrows a value's range by this factor in each pass over the metadata.
BINS = 4096
#: Rows that one window task of the slot numbering sees on average.
SLOT_ROWS = 20_000


@dataclass
class _Node:
    """Leaves [first, first + leaves) still to be separated, in a box of the metadata space."""

    first: int
    leaves: int
    dim: str = ""
    low: int = 0
    high: int = 0
    fixed: tuple[int, ...] = ()  # values of the first keys: only rows that have them are left to be cut
    target: int = 0
    cut: tuple[int, ...] = ()

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.dim, *(k for k in TIES if k != self.dim))

    @property
    def key(self) -> str:
        return self.keys[len(self.fixed)]


def sized(docs: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """What is kept of each document: id, size, text_crc32, the coordinates, and a number of the row's own."""
    have = set(docs.columns)
    code = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) % 65_536 if c in have else F.lit(0)
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # where documents carry no time, the id stands for the order in which they came; ids of other types by their hash
    number = F.coalesce(F.col(id_col).cast("long") if id_kind(docs, id_col) == "bigint" else F.xxhash64(id_col), F.lit(0))
    return docs.select(
        F.col(id_col).alias("_id"),
        (F.length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
        code("lang").cast("long").alias("lang_code"),
        code("source").cast("long").alias("source_code"),
        F.shiftright(number, 16).alias("arrival"),
        number.bitwiseAND(F.lit(65_535)).alias("arrival_low"),
        F.monotonically_increasing_id().alias("serial"),
    )


def _bin(node: _Node) -> Column:
    """Number of the bin that a row falls into: -1 before the open range, then BINS bins, then one after it."""
    step = max(1, -(-(node.high - node.low + 1) // BINS))
    key = F.col(node.key)
    inside = F.when(key < node.low, -1).when(key > node.high, BINS).otherwise(F.floor((key - F.lit(node.low)) / F.lit(step)))
    for name, value in reversed([*zip(node.keys, node.fixed)]):
        inside = F.when(F.col(name) < value, -1).when(F.col(name) > value, BINS).otherwise(inside)
    return inside.cast("int")


def _by_node(nodes: list[_Node], of) -> Column:
    out = F.when(F.col("node") == nodes[0].first, of(nodes[0]))
    for n in nodes[1:]:
        out = out.when(F.col("node") == n.first, of(n))
    return out


def _split(rows: DataFrame, nodes: list[_Node], ranges: dict[str, tuple[int, int]]) -> None:
    """Sets each node's cut, a value for each of its keys: the weighted quantile, exact, by narrowing histograms.

    A pass brings at most (BINS + 2) rows a node to the driver, whatever the number of documents.
    """
    open_nodes = nodes
    while open_nodes:
        frame = rows.filter(F.col("node").isin([n.first for n in open_nodes])).select("node", _by_node(open_nodes, _bin).alias("bin"), "size", _by_node(open_nodes, lambda n: F.col(n.key)).alias("key"))
        found = defaultdict(list)
        for r in frame.groupBy("node", "bin").agg(F.sum("size").alias("w"), F.min("key").alias("low"), F.max("key").alias("high")).collect():
            found[r.node].append((r.bin, r.w, r.low, r.high))
        still = []
        for n in open_nodes:
            mine = sorted(found[n.first])
            total = sum(w for b, w, _, _ in mine if b < 0)
            inside = [x for x in mine if 0 <= x[0] < BINS]
            for i, (_, w, low, high) in enumerate(inside):
                if total + w >= n.target or i + 1 == len(inside):
                    if low < high:
                        n.low, n.high = low, high
                        still.append(n)
                    elif len(n.fixed) + 1 < len(n.keys):
                        n.fixed = (*n.fixed, low)
                        n.low, n.high = ranges[n.key]
                        still.append(n)
                    else:
                        # the row that straddles the target goes where it brings the weight nearer to it
                        n.cut = (*n.fixed, low if total + w - n.target <= n.target - total else low - 1)
                    break
                total += w
        open_nodes = still


def _left(n: _Node) -> Column:
    out = F.col(n.keys[-1]) <= F.lit(n.cut[-1])
    for name, value in reversed([*zip(n.keys, n.cut[:-1])]):
        out = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & out)
    return out


def shards(docs: DataFrame, *, n_shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard): every row in one leaf of a k-d tree.

    Each level splits every node along its widest dimension (range within the node against the range over all rows)
    at the exact weighted quantile, weights being bytes, until each leaf has its share: n_shards leaves, or as many
    as bring leaves to target_bytes.  The order within a dimension is (value, id, number of the row as it was read), so
    rows alike in all metadata, such as a group of copies, rows that repeat an id and rows without one, are split like
    any others.  size is the UTF-8 bytes of the text (null: none) plus 16;
    law is `bytes`; slot numbers the rows of a shard from 0 without gaps, by (block of row numbers, id, text_crc32);
    grown_shard is null, since this law moves rows between shards when one is added.  Ids may be any whole numbers, or
    of another type, which counts by its hash; a null id counts as 0; repeated rows get slots of their own; an empty
    table gives an empty one; columns with the names of results are not read.
    """
    meta = written(sized(docs, id_col=id_col, text_col=text_col).withColumn("node", F.lit(0)), "shard-nodes")
    whole = meta.agg(F.count("*").alias("n"), F.sum("size").alias("w"), *(F.min(d).alias(f"low_{d}") for d in DIMENSIONS), *(F.max(d).alias(f"high_{d}") for d in DIMENSIONS), F.max("serial").alias("serial")).first()
    if n_shards is None:
        n_shards = max(1, math.ceil((whole.w or 0) / (target_bytes or 1 << 28)))
    spread = {d: max(1, (whole[f"high_{d}"] or 0) - (whole[f"low_{d}"] or 0)) for d in DIMENSIONS}
    ranges = {"arrival": (whole.low_arrival, whole.high_arrival), "arrival_low": (0, 65_535), "serial": (0, whole.serial)}
    rows = meta
    nodes = [_Node(0, n_shards)] if whole.n else []
    while nodes := [n for n in nodes if n.leaves > 1]:
        boxes = rows.groupBy("node").agg(F.sum("size").alias("w"), *(F.min(d).alias(f"low_{d}") for d in DIMENSIONS), *(F.max(d).alias(f"high_{d}") for d in DIMENSIONS)).collect()
        boxes = {b.node: b for b in boxes}
        nodes = [n for n in nodes if n.first in boxes]
        for n in nodes:
            b = boxes[n.first]
            n.dim = max(DIMENSIONS, key=lambda d: ((b[f"high_{d}"] - b[f"low_{d}"]) / spread[d], -DIMENSIONS.index(d)))
            n.low, n.high, n.fixed = b[f"low_{n.dim}"], b[f"high_{n.dim}"], ()
            n.target = b.w * (n.leaves // 2) // n.leaves
        _split(rows, nodes, ranges)
        if nodes:
            moved = F.coalesce(_by_node(nodes, lambda n: F.when(_left(n), n.first).otherwise(n.first + n.leaves // 2)), F.col("node"))
            last, rows = rows, written(rows.withColumn("node", moved), "shard-nodes")
            dropped(last)
        nodes = [half for n in nodes for half in (_Node(n.first, n.leaves // 2), _Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2))]
    blocks = max(1, math.ceil((whole.n or 0) / max(1, n_shards) / SLOT_ROWS))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("serial"), F.lit(blocks)).cast("int"))
    sizes = placed.groupBy("node", "block").agg(F.count("*").alias("n"))
    # one row for each SLOT_ROWS documents; a shard's blocks are summed within the shard
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(Window.partitionBy("node").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    numbered = placed.withColumn("within", F.row_number().over(Window.partitionBy("node", "block").orderBy("_id", "text_crc32", "size", "serial")))
    return numbered.join(offsets, ["node", "block"]).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("node").cast("int").alias("shard"), (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
