"""SimHash near copies: fingerprints, vantage-point shards, exact links, components.

A vantage-point tree splits fingerprints by Hamming distance to a vantage fingerprint
``v``: within ``radius`` goes inside, beyond goes outside.  For links of at most ``bits``
bits the triangle bound says that a partner of an inside point at distance <= radius - bits
is inside too; only points in the band (radius - bits, radius] can have partners on the
other side, so those alone are also sent outside.  Every linked pair then meets in a leaf.

The top of the tree is fitted on a bounded sample of the distinct fingerprints (it decides
only how work is dealt, never what is found) and routes *every* distinct fingerprint to its
leaves.  Inside a leaf the same splitting goes on until blocks are small, and blocks are
compared completely.  A leaf returns a spanning star per connected group, not its links:
at most one edge per fingerprint and leaf, whatever the size of a group of near copies.

A ball too dense to be split by distances may leave a leaf of any size.  Leaves over a bound are not
sent to one task: their fingerprints meet at midpoints instead (``midpoint_stars``), small groups by
construction, with the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from xxhash import xxh64_intdigest

from panelkit.session import cut_lineage

from .common import written

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
#: Fingerprints that the top of the tree is fitted on, at most.
TREE_SAMPLE = 65_536
#: Fingerprints that a leaf should hold.
LEAF_TARGET = 8_192
#: Fingerprints of a leaf that one task compares, at most; larger leaves are linked by midpoints.
LEAF_MAX = 8 * LEAF_TARGET
#: Blocks of a leaf are compared completely from this size down.
BLOCK = 256


# ---- fingerprints -------------------------------------------------------------------

def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles of a text, as an unsigned integer.

    A-Z are lower-cased; fewer words than a shingle count as one shingle; no word (also
    NULL): zero.
    """
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        hashes = [xxh64_intdigest(joined, HASH_SEED)]
    else:
        length = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(length + 1) - 1
        starts = (ends - length).tolist()
        hashes = [xxh64_intdigest(joined[a:b], HASH_SEED)
                  for a, b in zip(starts, ends[shingle_words - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[i:i + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text, shingle_words: int = SHINGLE_WORDS) -> F.Column:
    """The fingerprint's 64 bits as a signed long."""
    @pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        got = [simhash(t, shingle_words) for t in texts]
        return pd.Series(np.array(got, np.uint64).view(np.int64))
    return fp(text)


def hex64(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- vantage-point tree -------------------------------------------------------------

def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def choose_split(x: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """Vantage fingerprint and radius with the fewest points in the boundary band among
    splits that leave neither side more than nine tenths (band included); None if no
    candidate manages that."""
    best, n = None, len(x)
    for v in x[np.linspace(0, n - 1, min(n, 12)).astype(int)]:
        upto = np.cumsum(np.bincount(distance(x, v), minlength=65))
        for r in range(1, 64):
            inside, outside = upto[r], n - (upto[r - bits] if r >= bits else 0)
            if max(inside, outside) <= 0.9 * n:
                cost = inside * float(inside) + outside * float(outside)
                if best is None or cost < best[0]:
                    best = (cost, v, r)
    return best and (best[1], best[2])


def sides(x: np.ndarray, v: np.uint64, r: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    d = distance(x, v)
    return np.flatnonzero(d <= r), np.flatnonzero(d > r - bits)


def fit_tree(sample: np.ndarray, leaf: float, bits: int) -> list:
    """Nested [vantage, radius, inside, outside]; a leaf is its number."""
    count = 0

    def grow(x: np.ndarray):
        nonlocal count
        split = choose_split(x, bits) if len(x) > max(leaf, 2) else None
        if split is None:
            count += 1
            return count - 1
        a, b = sides(x, *split, bits)
        return [*split, grow(x[a]), grow(x[b])]

    return grow(sample)


def route(x: np.ndarray, tree, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, indexes of the fingerprints that belong to it), band copies included."""
    stack = [(tree, np.arange(len(x)))]
    while stack:
        node, idx = stack.pop()
        if not len(idx):
            continue
        if isinstance(node, int):
            yield node, idx
        else:
            v, r, inside, outside = node
            a, b = sides(x[idx], v, r, bits)
            stack += [(inside, idx[a]), (outside, idx[b])]


# ---- links inside a leaf ------------------------------------------------------------

def block_groups(x: np.ndarray, bits: int) -> np.ndarray:
    """For each point the smallest index of its connected group, by complete comparison."""
    near = distance(x[:, None], x[None, :]) <= bits
    label = np.arange(len(x))
    while True:
        new = np.where(near, label[None, :], len(x)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def leaf_stars(x: np.ndarray, bits: int = MAX_BITS, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of each linked group of distinct signed fingerprints, root = smallest."""
    x = np.sort(np.asarray(x, np.int64))
    u, parent = x.view(np.uint64), list(range(len(x)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def compare(idx: np.ndarray) -> None:
        got = block_groups(u[idx], bits)
        for i in np.flatnonzero(got != np.arange(len(idx))):
            a, b = find(int(idx[i])), find(int(idx[got[i]]))
            if a != b:
                parent[max(a, b)] = min(a, b)

    stack = [np.arange(len(x))]
    while stack:
        idx = stack.pop()
        if len(idx) <= block:
            if len(idx) > 1:
                compare(idx)
            continue
        split = choose_split(u[idx], bits)
        if split is not None:
            stack += [idx[part] for part in sides(u[idx], *split, bits)]
            continue
        # a ball too dense to split: chunks in order of distance to one of its points,
        # each with itself and with those chunks that the triangle bound leaves
        d = distance(u[idx], u[idx[0]]).astype(int)
        order = np.argsort(d, kind="stable")
        chunks = [order[i:i + block] for i in range(0, len(idx), block)]
        for i, a in enumerate(chunks):
            for b in chunks[i:]:
                if d[b[0]] > d[a[-1]] + bits:
                    break
                compare(np.unique(np.concatenate([idx[a], idx[b]])))
    root = np.array([find(i) for i in range(len(x))], np.int64)
    member = np.flatnonzero(root != np.arange(len(x)))
    return x[member], x[root[member]]


def midpoint_stars(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Stars (a > b) that connect exactly the distinct fingerprints ``fp`` that links connect.

    Two fingerprints differ in at most ``bits`` bits if and only if some key lies within half of that
    (rounded down) of one and half (rounded up) of the other.  So each is sent to the keys
    within the larger half: 65 for 2 bits, which bounds the groups as well, however dense the table.
    """
    near, far = bits // 2, (bits + 1) // 2
    flips = [(sum(1 << i for i in at), k) for k in range(far + 1) for at in combinations(range(64), k)]
    masks = F.array(*[F.struct(F.lit(m - (m >> 63 << 64)).alias("mask"), F.lit(k).alias("d")) for m, k in flips])
    keys = fps.select("fp", F.explode(masks).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip.mask")).alias("key"), "fp", "flip.d")
    groups = keys.groupBy("key").agg(F.collect_list("fp").alias("fps"), F.min("d").alias("d")).where(
        (F.size("fps") > 1) & (F.col("d") <= near))
    return groups.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a > b").distinct()


def link_stars(fps: DataFrame, bits: int = MAX_BITS, sample: int = TREE_SAMPLE,
               leaf_target: int = LEAF_TARGET, leaf_max: int = LEAF_MAX) -> DataFrame:
    """Stars (a > b) that connect exactly the distinct fingerprints ``fp`` that links of at
    most ``bits`` bits connect."""
    spark = fps.sparkSession
    n = fps.count()
    head = [r.fp for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    points = np.array(head, np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(
        fit_tree(points, max(16.0, leaf_target * len(head) / max(n, 1)), bits))

    def to_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64)
            for leaf, idx in route(fp.view(np.uint64), tree.value, bits):
                yield pd.DataFrame({"leaf": np.int32(leaf), "fp": fp[idx]})

    def stars(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = leaf_stars(pdf["fp"].to_numpy(np.int64), bits)
        return pd.DataFrame({"a": a, "b": b})

    routed = cut_lineage(fps.mapInPandas(to_leaves, "leaf int, fp long"))
    sizes = routed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))  # at most one row per sampled point
    held = routed.join(F.broadcast(sizes), "leaf")
    found = held.where(F.col("size") <= leaf_max).select("leaf", "fp").groupBy("leaf").applyInPandas(stars, "a long, b long")
    dense = midpoint_stars(held.where(F.col("size") > leaf_max).select("fp").distinct(), bits)
    return found.unionAll(dense).distinct()


# ---- connected components -----------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a > b), root = smallest node reachable.

    Large-star and small-star steps in turn; each step aggregates minima (combined map
    side) and joins them back (skewed hubs are split by AQE), and is checkpointed, so a
    lost executor costs one step.
    """
    edges = cut_lineage(edges.select("a", "b"))
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
                 .where("a <> b").distinct())
        edges = cut_lineage(small)
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def link(docs: DataFrame, id_col: str = "doc_id", fp_col: str = "fp", bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id) of each distinct fingerprint of a materialised table."""
    fps = cut_lineage(docs.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("low")))
    roots = components(link_stars(fps.select("fp"), bits))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    NULL and empty texts have fingerprint zero and link like any other; repeated rows give
    repeated rows; a NULL doc_id never names a component unless the whole component has no
    other id; other columns are ignored; an empty table gives an empty result.
    """
    prints = cut_lineage(docs.select("doc_id", fingerprint_column(F.col("text"), shingle_words).alias("fp")))
    ids = link(prints, bits=bits)
    return prints.join(ids, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row of each component left: that of the smallest
    doc_id (NULL last), the first of repeated rows."""
    held = written(docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"),
                               fingerprint_column(F.col("text"), shingle_words).alias("fp"),
                               F.monotonically_increasing_id().alias("rid")), "simhash")
    prints = held.select("id", "fp", "rid")
    first = prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("low"))
    first = cut_lineage(first.select("fp", "low"))
    roots = components(link_stars(first.select("fp"), bits))
    keep = (first.join(roots, first.fp == roots.node, "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("low").alias("low"))
            .select(F.col("low.rid").alias("rid")))
    return held.join(keep, "rid", "left_semi").select("row.*")


