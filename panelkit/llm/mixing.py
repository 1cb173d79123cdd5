"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1.  Targets: the sources share the size of the whole table by weight; no target passes
    ``MAX_EPOCHS`` times its source's size, and what is cut off is shared among the others by
    weight until none passes.
2.  Quotas: every source's documents are hashed into blocks of about ``BLOCK_DOCS`` documents
    and its blocks are put in a permuted (hashed) order.  A target of r passes takes every block
    floor(r) times and, once more, the first blocks of the order up to the target; of the one
    block in which the target falls, single documents are taken to come nearest to it.  So the
    quota of block draws of each source is an exact number.
3.  The splitting tree deals these draws to the output shards: a node with quotas q and s
    shards gives its left half a multivariate-hypergeometric draw of its share and the right half
    the rest, down to single shards.  Each shard's draws of a source are a stretch of the
    source's permuted draw list, so shards are disjoint and together exhaust the quotas.
4.  Inside a shard rows are put in hashed order.

Draws are keyed by a fixed seed and by content, so reruns agree.  Only the per-source quota rows
(one per source) meet in one task; document rows are joined to block rows, whose keys each
have about ``BLOCK_DOCS`` documents, so a hot source is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.session import cut_lineage

from .common import n_words, written

#: Weights of the sources in code-point order (NULL last), repeating.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_DOCS = 256
#: Blocks of a source, at most: beyond BLOCK_DOCS * MAX_BLOCKS documents blocks get larger instead.
MAX_BLOCKS = 65_536
SHARDS = 8
SEED = 20240607


def sized(docs: DataFrame) -> DataFrame:
    """source, doc_id, size and the hash that places a document in its block."""
    return docs.select("source", "doc_id", n_words(F.col("text")).alias("size"),
                       F.xxhash64(F.lit(SEED), "doc_id", "text").alias("h"),
                       F.monotonically_increasing_id().alias("rid"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: its number s, source_size, n_docs, target."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    src = src.withColumn("s", number).withColumn("w", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(max_epochs)))
    # sources are cut off in order of cap / weight; one is if its fair share of what the
    # earlier ones leave passes its cap
    order = W.orderBy(F.col("cap") / F.col("w"), "s")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    src = src.withColumn("total", F.sum("source_size").over(whole)).withColumn(
        "left_size", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn(
        "left_weight", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    share = F.col("left_size") / F.col("left_weight")
    src = src.withColumn("cut", F.col("cap") < share * F.col("w"))
    # the first source that is not cut sets the level of all that are not
    first = F.first(F.when(~F.col("cut"), share), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.when(F.col("cut"), F.col("cap")).otherwise(F.least("cap", first * F.col("w")))
    return src.select("source", "s", "source_size", "n_docs", target.alias("target"))


def plan(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
         block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, documents with their source's columns and block, blocks with their draws).

    ``sizes`` has to be materialised (it is read several times).
    """
    sources = cut_lineage(source_targets(sizes, weights, max_epochs))
    few = sources.select(F.col("source").alias("of"), "s", "source_size", "target",
                         F.least(F.ceil(F.col("n_docs") / block_docs), F.lit(MAX_BLOCKS)).alias("n_blocks"))
    docs = sizes.join(few, sizes.source.eqNullSafe(few["of"])).drop("of").withColumn(
        "block", F.pmod("h", "n_blocks").cast("long"))
    per_block = docs.groupBy("s", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"),
                                               F.first("target").alias("target"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    per_block = per_block.withColumn("full", F.least(passes, F.lit(max_epochs)).cast("long")).withColumn(
        "rest", F.col("target") - F.col("full") * F.col("source_size"))
    permuted = F.xxhash64(F.lit(SEED + 1), "s", "block")
    upto = F.sum("words").over(W.partitionBy("s").orderBy(permuted, "block").rowsBetween(W.unboundedPreceding, 0))
    per_block = per_block.withColumn("upto", upto).withColumn(
        "rank", F.row_number().over(W.partitionBy("s").orderBy(permuted, "block")) - 1)
    again = F.col("full") < max_epochs
    once_more = again & (F.col("upto") <= F.col("rest"))
    cut = again & (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest"))
    blocks = per_block.select("s", "block", "rank", "full", once_more.alias("more"), cut.alias("cut"),
                              F.when(cut, F.col("rest") - F.col("upto") + F.col("words")).alias("room"))
    return sources, docs, cut_lineage(blocks)


def fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of the one cut block of a source: its documents in hashed order while they fit, then the
    one addition or exchange that brings the words nearest to the room."""
    pdf = pdf.sort_values(["h", "doc_id", "rid"], kind="stable")
    size, room = pdf["size"].to_numpy(np.int64), float(pdf["room"].iloc[0])
    taken = np.zeros(len(size), bool)
    for i, n in enumerate(size.tolist()):
        if 0 < n <= room:
            taken[i] = True
            room -= n
    rest = np.flatnonzero(~taken & (size > 0))
    if len(rest):
        rest = rest[np.argsort(size[rest], kind="stable")]
        out = np.append(np.flatnonzero(taken), -1)  # -1: nothing goes
        wish = np.where(out >= 0, size[out], 0) + room
        at = np.searchsorted(size[rest], wish)
        near = np.stack([np.clip(at - 1, 0, len(rest) - 1), np.clip(at, 0, len(rest) - 1)])
        gap = np.abs(size[rest][near] - wish)
        k, j = np.unravel_index(gap.argmin(), gap.shape)
        if gap[k, j] < room:
            taken[rest[near[k, j]]] = True
            if out[j] >= 0:
                taken[out[j]] = False
    return pd.DataFrame({"rid": pdf["rid"].to_numpy()[taken]})


def copies(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
           block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with ``copies``, the number of times the mix takes each; sources; blocks)."""
    sources, docs, blocks = plan(sizes, weights, max_epochs, block_docs)
    drawn = docs.join(blocks, ["s", "block"])
    chosen = (drawn.where("cut").select("s", "h", "doc_id", "rid", "size", "room")
              .groupBy("s").applyInPandas(fill, "rid long").withColumn("extra", F.lit(1)))
    whole = F.col("full") + F.col("more").cast("long")
    drawn = drawn.join(chosen, "rid", "left").withColumn(
        "copies", whole + F.coalesce(F.col("extra"), F.lit(0)))
    return drawn, sources, blocks


# ---- dealing the draws to shards ----------------------------------------------------

def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards x sources) numbers of draws; columns add up to the quotas and rows differ by at
    most one in total."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def deal(q: np.ndarray, low: int, high: int) -> None:
        """Shards low..high; of all ``q.sum()`` draws each gets a floor or ceil share."""
        if high - low == 1:
            out[low] = q
            return
        mid, total, n = (low + high) // 2, int(q.sum()), high - low
        base, more = divmod(total, n)
        left = base * (mid - low) + min(more, mid - low)
        part, need, rest = np.zeros_like(q), left, total
        for i, k in enumerate(q):  # multivariate as a chain of single hypergeometric draws
            rest -= int(k)
            part[i] = rng.hypergeometric(int(k), rest, need) if need and k else 0
            need -= int(part[i])
        deal(part, low, mid)
        deal(q - part, mid, high)

    deal(quotas.astype(np.int64), 0, shards)
    return out


def draw_list(blocks: DataFrame) -> DataFrame:
    """(s, epoch, block, draw): the permuted draw list of each source, one pass after the other."""
    n = F.col("full") + (F.col("more") | F.col("cut")).cast("long")
    draws = blocks.where(n > 0).select(
        "s", "block", "rank", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)).alias("epoch"))
    draw = F.row_number().over(W.partitionBy("s").orderBy("epoch", "rank")) - 1
    return draws.select("s", "epoch", "block", draw.cast("long").alias("draw"))


def dealt_draws(draws: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(s, epoch, block, shard): the splitting tree's share of every draw list."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [pdf for pdf in batches if len(pdf)]
        if not rows:
            return
        pdf = pd.concat(rows).sort_values("s")
        got = split_tree(pdf["q"].to_numpy(np.int64), shards, np.random.default_rng(seed))
        last = got.cumsum(0)
        for i in range(shards):
            yield pd.DataFrame({"s": pdf["s"].to_numpy(np.int64), "shard": i,
                                "first": last[i] - got[i], "last": last[i]})

    ranges = (draws.groupBy("s").agg(F.count(F.lit(1)).alias("q")).coalesce(1)
              .mapInPandas(deal, "s long, shard int, first long, last long").where("last > first"))
    at = ranges.select("s", "shard", F.explode(F.sequence("first", F.col("last") - 1)).alias("draw"))
    return draws.join(at, ["s", "draw"]).select("s", "epoch", "block", "shard")


def mix(sizes: DataFrame, shards: int = SHARDS, seed: int = SEED, **how) -> DataFrame:
    """One row per taken copy: rid, doc_id, size, source, epoch, shard and ``place``, the hashed
    order inside the shard."""
    drawn, _, blocks = copies(sizes, **how)
    each = drawn.where("copies > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
    return each.join(dealt_draws(draw_list(blocks), shards, seed), ["s", "epoch", "block"]).select(
        "rid", "doc_id", "size", "source", "epoch", "shard",
        F.xxhash64(F.lit(seed), "shard", "h", "epoch").alias("place"))


def taken_words(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes, repeats counted)
    of every row of ``docs``, from the dealt mix itself.

    NULL and empty texts have size 0 and take 0; NULL is a source like any other and the last in
    order; a NULL doc_id is a document like any other; repeated rows are separate documents;
    other columns are ignored; an empty table gives an empty result.
    """
    sizes = cut_lineage(sized(docs))
    taken = mix(sizes, **how).groupBy("rid").agg(F.sum("size").alias("taken"))
    few = source_targets(sizes).select(F.col("source").alias("of"), "source_size", "target")
    known = sizes.join(few, sizes.source.eqNullSafe(few["of"]))
    return known.join(taken, "rid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, shard by shard in hashed order."""
    held = written(docs.select(F.struct(*docs.columns).alias("row"), "source", "doc_id",
                               n_words(F.col("text")).alias("size"),
                               F.xxhash64(F.lit(SEED), "doc_id", "text").alias("h"),
                               F.monotonically_increasing_id().alias("rid")), "mix")
    taken = mix(held.drop("row"), **how).select("rid", "shard", "place")
    rows = held.select("rid", "row").join(taken, "rid")
    return rows.sortWithinPartitions("shard", "place", "rid").select("row.*")
