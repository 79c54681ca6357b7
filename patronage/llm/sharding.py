"""Shards from a hierarchical weighted hash tree.

A document descends region, rack and shard. At each node every child draws ln(u) / weight with u hashed from the
document id and the child's name, and the largest draw wins; the share of a child is its weight's share. A child's draw
depends on nothing but the id and the child, so when weights change, documents leave or enter only the subtrees whose
weights changed. A shard that opens a region of its own (`grow`) takes documents only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import dealing, rank_in_groups, written

#: Bits of the draw's hash: 13 hex digits of md5, exact in a double.
HEX_DIGITS = 13


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard has a number and no children. Weights are positive."""

    name: str
    weight: float
    shard: int = -1
    children: tuple["Node", ...] = field(default=())


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), children=tuple(children))


def tree(regions: int = 3, racks: int = 2, shards: int = 4) -> Node:
    """A regular tree of unit shards, numbered from 0."""
    number = iter(range(regions * racks * shards))
    return inner("root", [
        inner(f"region{r}", [
            inner(f"rack{r}.{k}", [Node(f"shard{n}", 1.0, n) for n in (next(number) for _ in range(shards))])
            for k in range(racks)
        ])
        for r in range(regions)
    ])


def shard_count(node: Node) -> int:
    return sum(map(shard_count, node.children)) if node.children else 1


def grow(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region and rack of its own: no other node's weight changes."""
    n = shard_count(root)
    region = len(root.children)
    new = inner(f"region{region}", [inner(f"rack{region}.0", [Node(f"shard{n}", weight, n)])])
    return inner("root", [*root.children, new])


def draw(doc_id: Column, node: Node) -> Column:
    """ln(u) / weight, u in (0, 1) from the id's text (a null id: empty) and the node's name."""
    digest = F.md5(F.concat_ws("/", F.lit(node.name), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    whole = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double")
    return F.log((whole + 0.5) / float(16**HEX_DIGITS)) / node.weight


def shard_of(doc_id: Column, node: Node) -> Column:
    """The shard a document descends to from this node."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(doc_id, node.children[0])
    best = F.array_max(F.array(*[F.struct(draw(doc_id, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(node.children)]))["i"]
    if all(not c.children for c in node.children):
        return F.element_at(F.array(*[F.lit(c.shard) for c in node.children]), best + 1)
    chosen = F.when(best == 0, shard_of(doc_id, node.children[0]))
    for i, child in enumerate(node.children[1:], 1):
        chosen = chosen.when(best == i, shard_of(doc_id, child))
    return chosen


def shard_documents(documents: DataFrame, root: Node) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Null texts have no bytes, null ids share one place in the tree, repeated rows go to one shard in slots of their own,
    an empty table gives no rows; other columns are ignored. Slots number a shard's rows from 0 without gaps.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    doc_id = F.col("doc_id")
    placed = documents.select(
        "doc_id",
        (F.length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(doc_id, root).cast("int").alias("shard"),
        shard_of(doc_id, grow(root)).cast("int").alias("grown_shard"),
        dealing("doc_id", "text").alias("_deal"),
    )
    ranked = rank_in_groups(written(placed, "placed"), "shard", ["doc_id"], "slot")
    return ranked.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )
