"""Exact top-k inner products by Fagin's threshold algorithm.

``index`` packs the vectors, as integers, into blocks of ``BLOCK`` rows and sorts each block's rows by
every component: one list per dimension.  ``search`` deals blocks of queries and groups of index blocks
to tasks.  For one query and one block, lists are read in step from the end that the sign of the
query's component favours (components of zero have no list).  A row met for the first time is scored
whole; no row unmet can score more than the sum of the query's components times the values last read.
Reading stops when that bound is below the k-th best score of all blocks that the task has read so far
(a row that ties may still win by its smaller id).  Blocks whose first bound is below it are not read.

Each task returns at most k rows per query; a window over the tasks' rows gives the final k.  No
candidate is left out by hashing, sampling or a limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

SCALE = 256
#: Rows of an index block, and of a block of queries, about.
BLOCK, QUERIES = 4096, 8192
#: Index blocks that one group of tasks' rows holds, about.
GROUP = 4
#: Rows read from every list at first; each further reading doubles the depth.
DEPTH = 16
#: Components beyond this count as this, scores beyond a long as the nearest long.
LARGEST = 1 << 62
LEAST_SCORE, MOST_SCORE = -(1 << 63), (1 << 63) - 1


# ---- index --------------------------------------------------------------------------


def whole(rows: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component, shorter vectors filled up with zeros."""
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.float64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    with np.errstate(over="ignore"):
        out = np.floor(out * scale)
    if not len(out) or not out.size or np.abs(out).max() < 2 ** 53:
        return out.astype(np.int64)
    return np.array([[int(min(max(x, -LARGEST), LARGEST)) for x in r] for r in out.tolist()], np.int64)


def packed(values: np.ndarray) -> tuple[bytes, str]:
    """Bytes of a matrix in the smallest type of 16, 32 or 64 bits that holds it."""
    most = int(np.abs(values).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return values.astype(kind).tobytes(), kind


def unpacked(raw: bytes, kind: str, rows: int) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(rows, -1).astype(np.int64) if raw else np.zeros((rows, 0), np.int64)


INDEX = "block long, n int, ids binary, known binary, kind string, vectors binary, lists binary"


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    infinite = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)), F.lit(False))


def index(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Blocks of vectors with their sorted lists: ``lists`` holds, dimension by dimension, the block's
    rows by rising component (and by falling id where components are equal)."""

    def block(number: int, ids: list, rows: list[np.ndarray]) -> pd.DataFrame:
        known = np.array([i is not None for i in ids])
        keys = np.array([int(i) if i is not None else 0 for i in ids], np.int64)
        x = whole(rows, scale)
        by_id = np.lexsort((keys, ~known))[::-1]  # ids fall, NULL first
        lists = by_id[np.argsort(x[by_id], axis=0, kind="stable")]
        raw, kind = packed(x)
        return pd.DataFrame({"block": [number], "n": [len(ids)], "ids": [keys.tobytes()], "known": [known.tobytes()],
                             "kind": [kind], "vectors": [raw], "lists": [lists.T.astype("<u2").tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, ids, rows = TaskContext.get().partitionId() << 32, [], []
        for pdf in batches:
            ids += pdf["id"].tolist()
            rows += pdf["vector"].tolist()
            while len(ids) >= BLOCK:
                yield block(number, ids[:BLOCK], rows[:BLOCK])
                number, ids, rows = number + 1, ids[BLOCK:], rows[BLOCK:]
        if ids:
            yield block(number, ids, rows)

    key = F.col(id).cast("long").cast("string")  # pandas has no NULL in integer columns
    values = F.col(vector).cast("array<double>")
    return vectors.select(key.alias("id"), values.alias("vector")).where(usable(F.col("vector"))).mapInPandas(run, INDEX)


# ---- threshold algorithm ----------------------------------------------------------------


def as_longs(scores: np.ndarray) -> np.ndarray:
    return np.minimum(np.maximum(scores, LEAST_SCORE), MOST_SCORE) if scores.dtype == object else scores


class Block:
    """An index block with its lists; ``exact`` numbers are doubles where no sum can pass 2^53."""

    def __init__(self, row, dims: int, exact: type):
        self.number, self.n = row.block, row.n
        self.ids, self.known = np.frombuffer(row.ids, np.int64), np.frombuffer(row.known, bool)
        x = unpacked(row.vectors, row.kind, row.n)
        own = x.shape[1]
        self.x = np.zeros((row.n, dims), exact)
        self.x[:, :own] = x
        lists = np.frombuffer(row.lists, "<u2").reshape(own, row.n).astype(np.int64)
        blank = np.broadcast_to(np.arange(row.n), (dims - own, row.n))
        self.lists = np.concatenate([lists, blank])
        self.sorted = np.take_along_axis(self.x.T, self.lists, axis=1)

    def bounds(self, depth: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
        """For every query the most that a row scores which is not among the first ``depth`` of any list;
        ``up`` and ``down`` are the queries' positive and negative components."""
        d = min(depth, self.n - 1)
        return as_longs(up @ self.sorted[:, self.n - 1 - d] + down @ self.sorted[:, d])


class Best:
    """The k best (score, id) of one query: higher scores first, then smaller ids, NULL last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.known = [], [], []
        self.least = None  # the k-th score

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        if self.least is not None:
            good = np.flatnonzero(scores >= self.least)
            scores, ids, known = scores[good], ids[good], known[good]
        if not len(scores):
            return
        s = np.concatenate([np.array(self.scores, scores.dtype), scores])
        i = np.concatenate([np.array(self.ids, np.int64), ids])
        n = np.concatenate([np.array(self.known, bool), known])
        order = np.lexsort((i, ~n, -s)) if s.dtype != object else sorted(range(len(s)), key=lambda j: (-s[j], not n[j], i[j]))
        order = order[:self.k]
        self.scores, self.ids, self.known = s[order].tolist(), i[order].tolist(), n[order].tolist()
        if len(self.scores) == self.k:
            self.least = self.scores[-1]


def read(block: Block, q: np.ndarray, me: int, best: Best, bounds: list, depths: list[int]) -> None:
    """Threshold algorithm for one query on one block: ``bounds[j]`` holds after ``depths[j]`` rows of
    every list; ``me`` is the query's own row, or -1."""
    ups, downs = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    met = np.zeros(block.n, bool)
    if me >= 0:
        met[me] = True
    done = 0
    for depth, bound in zip(depths, bounds):
        fresh = np.zeros(block.n, bool)
        fresh[block.lists[ups, block.n - depth:block.n - done]] = True
        fresh[block.lists[downs, done:depth]] = True
        if depth == block.n and not len(ups) and not len(downs):
            fresh[:] = True  # a query of zeros has no list
        rows = np.flatnonzero(fresh & ~met)
        if len(rows):
            met[rows] = True
            best.add(as_longs(block.x[rows] @ q), block.ids[rows], block.known[rows])
        done = depth
        if best.least is not None and bound < best.least:
            return


def reading_depths(n: int) -> list[int]:
    depths, d = [], DEPTH
    while d < n:
        depths.append(d)
        d *= 2
    return [*depths, n]


def search_blocks(rows, queries, k: int) -> list[tuple]:
    """The k best of every query over index blocks, one block after another."""
    q = [unpacked(r.vector, r.kind, 1)[0] for r in queries]
    dims = max([len(v) for v in q] + [len(r.lists) // (2 * r.n) for r in rows])
    most = max((int(np.abs(v).max(initial=0)) for v in q), default=0)
    most *= max(int(np.abs(unpacked(r.vectors, r.kind, r.n)).max(initial=0)) for r in rows) * max(dims, 1)
    exact = np.float64 if most < 2 ** 53 else object
    table = np.zeros((len(q), dims), exact)
    for i, v in enumerate(q):
        table[i, :len(v)] = v
    up, down = np.where(table > 0, table, 0), np.where(table < 0, table, 0)
    best = [Best(k) for _ in q]
    for row in rows:
        block = Block(row, dims, exact)
        depths = reading_depths(block.n)
        first = block.bounds(0, up, down)
        bounds = np.stack([block.bounds(d, up, down) for d in depths], 1)
        for i, one in enumerate(queries):
            if best[i].least is None or first[i] >= best[i].least:
                me = one.pos if one.block == block.number else -1
                read(block, table[i], me, best[i], bounds[i], depths)
    return [(one.block, one.pos, one.id, i if known else None, int(s))
            for one, b in zip(queries, best) for s, i, known in zip(b.scores, b.ids, b.known)]


QUERY = "block long, pos int, id long, kind string, vector binary"
FOUND = "block long, pos int, query_id long, vec_id long, score long"


def search(vectors: DataFrame, is_query, k: int = 5, id: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows with the highest inner product of
    ``floor(scale * x)`` vectors, for every row whose id fulfils ``is_query`` (a function from the id
    column to a condition); the row itself is no candidate, ties go to smaller ids.

    Vectors that are NULL or hold a NULL or a number that is not finite take no part.  Shorter vectors
    are filled up with zeros.  Rows with a NULL id are candidates, after all other ids; a repeated id is a
    row of its own, as query (its answers appear once per row) and as candidate.  With fewer than k
    candidates all are returned.  Other columns are not read.
    """
    spark = vectors.sparkSession
    blocks = written(index(vectors, id, vector, scale), "topk-index")
    row_ids = blocks.select("block", "n", "ids", "known", "kind", "vectors")

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                known = np.flatnonzero(np.frombuffer(r.known, bool))
                yield pd.DataFrame({"block": r.block, "pos": known, "id": np.frombuffer(r.ids, np.int64)[known]})

    def vectors_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                x = np.frombuffer(r.vectors, r.kind).reshape(r.n, -1) if r.vectors else np.zeros((r.n, 0))
                yield pd.DataFrame({"block": r.block, "pos": r.at, "id": r.wanted, "kind": r.kind,
                                    "vector": [x[p].tobytes() for p in r.at]})

    ids = row_ids.select("block", "known", "ids").mapInPandas(rows_of, "block long, pos int, id long")
    wanted = ids.where(is_query(F.col("id"))).groupBy("block").agg(  # at most a block's rows
        F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("q"))
    queries = written(row_ids.drop("ids", "known").join(wanted, "block").select(
        "block", "n", "kind", "vectors", F.col("q.pos").alias("at"), F.col("q.id").alias("wanted")
    ).mapInPandas(vectors_of, QUERY), "topk-queries")
    parts = max(1, -(-queries.count() // QUERIES))
    slots = max(1, -(-blocks.count() // GROUP))
    left = blocks.withColumn("slot", F.pmod(F.hash("block"), F.lit(slots))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = queries.withColumn("part", F.pmod(F.hash("block", "pos"), F.lit(parts))).withColumn(
        "slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = search_blocks(list(rows.itertuples()), list(asked.itertuples()), k) if len(rows) and len(asked) else []
        block, pos, query, vec, score = zip(*found) if found else [()] * 5
        return pd.DataFrame({"block": block, "pos": pos, "query_id": query, "vec_id": pd.array(vec, "Int64"),
                             "score": np.array(score, np.int64)})

    near = left.groupBy("part", "slot").cogroup(right.groupBy("part", "slot")).applyInPandas(run, FOUND)
    order = W.partitionBy("block", "pos").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
