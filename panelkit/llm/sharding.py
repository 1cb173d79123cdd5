"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At every node of the tree a document draws one number per child, ``-ln(u) / weight`` with u from
a hash of the document and the child's name, and descends to the smallest.  A child's draws
depend on its own name and weight only, so a change of weights moves documents only between
children of nodes on the way to the change: subtrees whose weights stay exchange nothing.  A tree is
founded with some shards in racks and regions; every later shard is hung under a region of its own,
hence takes documents only into itself, however many came before it.

All of it is column expressions; the only shuffles are of (id, size, checksum) rows for the
slots, and no text is moved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, utf8_crc32

#: Shards of a rack and racks of a region in a founded tree.
RACK_SHARDS, REGION_RACKS = 2, 2
#: Shards that a tree is founded with by default; a smaller tree is founded with one.
FOUNDED = 8


@dataclass(frozen=True)
class Node:
    """A subtree; ``shard`` is set on leaves."""

    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int | None = None


def leaf(shard: int, weight: float = 1.0) -> Node:
    return Node(f"shard{shard}", weight, shard=shard)


def group(name: str, children: list[Node]) -> Node:
    """A subtree weighs what its children weigh."""
    return Node(name, sum(c.weight for c in children), tuple(children))


def founded_tree(shards: int, weights: list[float] | None = None) -> Node:
    """Shards in order, RACK_SHARDS to a rack and REGION_RACKS racks to a region."""
    leaves = [leaf(i, weights[i] if weights else 1.0) for i in range(shards)]
    racks = [group(f"rack{i // RACK_SHARDS}", leaves[i:i + RACK_SHARDS]) for i in range(0, shards, RACK_SHARDS)]
    regions = [group(f"region{i // REGION_RACKS}", racks[i:i + REGION_RACKS]) for i in range(0, len(racks), REGION_RACKS)]
    return group("root", regions)


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, under a region and a rack of its own."""
    rack = group(f"rack-of-{shard}", [leaf(shard, weight)])
    return group(tree.name, [*tree.children, group(f"region-of-{shard}", [rack])])


def layout(shards: int, weights: list[float] | None = None, founded: int | None = None) -> Node:
    """A tree founded with ``founded`` shards and grown one by one to ``shards``.

    So ``layout(n + 1)`` is ``grown(layout(n), n)`` for one and the same founding and n >= ``founded``:
    names and weights of older nodes stay, whatever n is.
    """
    if founded is None:
        founded = FOUNDED if shards >= FOUNDED else 1
    tree = founded_tree(min(founded, shards), weights)
    for shard in range(founded, shards):
        tree = grown(tree, shard, weights[shard] if weights else 1.0)
    return tree


def hash52(text: Column) -> Column:
    """The first 52 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def draw(key: Column, node: Node) -> Column:
    """The weighted draw of a child; the smallest of its siblings wins."""
    u = (hash52(F.concat(key, F.lit(f":{node.name}"))) + 1.0) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(node.weight))


def descend(key: Column, node: Node) -> Column:
    """The shard that a key (a string column) reaches below a node."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return descend(key, live[0])
    draws = [draw(key, c) for c in live]
    lowest = F.least(*draws)
    out = descend(key, live[-1])
    for d, c in reversed(list(zip(draws[:-1], live[:-1]))):
        out = F.when(d == lowest, descend(key, c)).otherwise(out)
    return out


def key_of(doc_id) -> Column:
    """The hashed key of a document; NULL ids share one."""
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def assign(docs: DataFrame, shards: int = 8, founded: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``.

    ``grown_shard`` is the ``shard`` that the same founding gives with one more shard; rows move
    only into that one.  By default trees of 8 shards and more are founded with 8, smaller ones
    with one; growing across that size needs ``founded=1``.

    A NULL text has size 1 and the checksum of the empty text; NULL doc_ids share one key and so
    one shard (id and shard count alone decide), where slots go by content; repeated rows have slots of their own; other columns are ignored; an empty table
    gives an empty result.

    Slots follow the order of a hash of (doc_id, checksum, size) in the shard.  Hash ranges make
    buckets whose counts are summed up first, so every row is numbered within a bucket of bounded
    share, never within a whole shard, and the numbers don't depend on how many buckets there are.
    """
    tree = layout(shards, founded=founded)
    key = key_of(F.col("doc_id"))
    buckets = 4 * partitions(docs.sparkSession)
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        utf8_crc32(F.col("text")).alias("text_crc32"),
        descend(key, tree).alias("shard"),
        descend(key, grown(tree, shards)).alias("grown_shard"))
    rows = rows.withColumn("h", hash52(F.concat_ws("|", key, "text_crc32", "size"))).withColumn(
        "bucket", F.floor(F.col("h") / F.lit(float(1 << 52)) * F.lit(float(buckets))).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("h", "doc_id", "text_crc32", "size")) - 1
    placed = rows.withColumn("place", place).join(offsets, ["shard", "bucket"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         (F.col("before") + F.col("place")).cast("long").alias("slot"), "grown_shard")
