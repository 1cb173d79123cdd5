"""Periodic runs of words, found by tiles of one period octave each.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) of at
least max(``MIN_WORDS``, 2q) words that no neighbouring word extends.  Octave k looks for the
periods from 2^k to 2^(k+1)-1:

1. ``tiled`` cuts every document's words into overlapping tiles per octave.  Tiles overlap by two
   longest periods, so two turns of any run lie whole in one of them.  A run of octave k keeps
   words q apart equal over at least ``least(k)`` places in a row, hence it shows an equal pair of
   blocks of half that many words, one of them at a boundary (a multiple of the block); tiles
   without such a pair hold no run and are not sent.
2. ``solved`` takes each tile by itself: at every boundary c with such pairs, the Z-values forward
   (words equal from c and from c+q on) and backward (up to c and up to c+q) give the stretch of
   period q around c, clipped to the tile.  Z-values come from prefix hashes by bisection, all
   boundaries of a tile at once; every stretch kept is compared word by word.
3. ``stitched`` gathers the stretches by document and period and joins those that overlap by a
   period or more: they are one run seen through several tiles.

A stretch with period q and a smaller period p has p as divisor of q (its length is at least 2q) and
is the run of p itself, so only stretches whose first q words are no power are kept.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, written

MIN_WORDS = 12
#: Words of a tile at least; a tile of octave k has 16 * 2^k words where that is more.
TILE = 4096
#: Code points that a worker codes at once; a longer text makes its own lot.
LOT_CHARS = 4_000_000
#: Cells of a block of comparisons.
CELLS = 1 << 22
U64 = np.uint64
#: An odd base, its inverse modulo 2^64, and the multipliers of the splitmix64 mixing of word numbers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


# ---- words of a document --------------------------------------------------------------


def planted(words: list, doc_id: int | None) -> list:
    """The words of a document as the contract reads them: with h the CRC32 of the decimal doc_id, a
    tenth of all documents repeat a stretch of theirs up to their end.  A NULL doc_id repeats nothing."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turn = words[a:a + p]
    return words[:a] + (turn * (-(-(n - a) // p)))[:n - a]


def as_they_are(words: list, doc_id: int | None) -> list:
    return words


# ---- octaves, boundaries, hashes --------------------------------------------------------


def least(k: int) -> int:
    """Places in a row at which words q apart are equal, in every run of octave k."""
    return min(max(MIN_WORDS - q, q) for q in range(1 << k, min(2 << k, MIN_WORDS + 1))) if 1 << k <= MIN_WORDS else 1 << k


def block_words(k: int) -> int:
    """Words of a block: among as many places in a row as ``least`` says, one block begins at a
    multiple of its length."""
    return (least(k) + 1) // 2


def octaves(n: int) -> int:
    """Octaves whose shortest period fits twice into n words."""
    return max(0, (n // 2).bit_length()) if n >= MIN_WORDS else 0


def tile_words(k: int, tile: int = TILE) -> int:
    return max(tile, 16 << k)


def stride(k: int, tile: int = TILE) -> int:
    """Tiles begin at multiples of this; what they share holds two turns of any period."""
    return tile_words(k, tile) - max(4 << k, MIN_WORDS)


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            for name, base in (("up", BASE), ("down", INVERSE)):
                steps = np.full(size, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


POWERS = Powers()


def prefix_hashes(words: np.ndarray) -> np.ndarray:
    """Sums of the mixed words times powers of the base, modulo 2^64."""
    x = (words.astype(np.int64).view(U64) + U64(1)) * U64(BASE)
    x = (x ^ x >> U64(30)) * U64(MIX[0])
    x = (x ^ x >> U64(27)) * U64(MIX[1])
    x ^= x >> U64(31)
    out = np.zeros(len(x) + 1, U64)
    np.cumsum(x * POWERS.get(len(x) + 1)[0][:len(x)], out=out[1:])
    return out


def block_hashes(prefix: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words at each place, free of the place."""
    n = len(prefix) - size
    return (prefix[size:] - prefix[:-size]) * POWERS.get(len(prefix))[1][:n] if n > 0 else np.zeros(0, U64)


def equal_blocks(blocks: np.ndarray, size: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(boundaries, table) in lots: the table's column j says whether the block at a boundary equals
    the block 2^k + j places on; places beyond the end equal nothing."""
    q = 1 << k
    bounds = np.arange(0, len(blocks) - q, size)
    if not len(bounds):
        return
    later = np.concatenate([blocks[q:], np.zeros(q, U64)])  # beyond the end: masked below
    view = sliding_window_view(later, q)
    step = max(1, CELLS >> k)
    for i in range(0, len(bounds), step):
        c = bounds[i:i + step]
        table = blocks[c][:, None] == view[c[0]:c[-1] + 1:size]
        if c[-1] + 2 * q > len(blocks):
            table &= np.arange(q) < (len(blocks) - q - c)[:, None]
        yield c, table


# ---- tiles --------------------------------------------------------------------------


def marked_tiles(numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray, tile: int) -> Iterator[tuple[int, int, int]]:
    """(document, octave, first word) of every tile that may hold a run.  ``numbers`` holds the words
    of documents of falling size, one after another."""
    ends = starts + sizes
    prefix = prefix_hashes(numbers)
    for k in range(octaves(int(sizes[0])) if len(sizes) else 0):
        fit = int(np.searchsorted(-sizes, -max(2 << k, MIN_WORDS), "right"))  # documents with two turns
        if not fit:
            return
        total = int(ends[fit - 1])
        size = block_words(k)
        blocks = block_hashes(prefix[:total + 1], size)
        found = []
        for c, table in equal_blocks(blocks, size, k):
            some = np.flatnonzero(table.any(axis=1))
            if len(some):
                doc = np.searchsorted(ends, c[some], "right")
                room = ends[doc] - c[some] - size - (1 << k)  # the second block stays in the document
                inside = (table[some] & (np.arange(1 << k) <= room[:, None])).any(axis=1)
                found.append(c[some][inside])
        if not found:
            continue
        c = np.concatenate(found)
        doc = np.searchsorted(ends, c, "right")
        at, width, step = c - starts[doc], tile_words(k, tile), stride(k, tile)
        last = np.maximum(0, -(-(sizes[doc] - width) // step))  # the last tile that a document needs
        for back in range(-(-width // step)):  # every tile that covers the boundary
            t = np.minimum(at // step - back, last)
            fits = (t >= 0) & (at < t * step + width)
            yield from ((int(d), k, int(i) * step) for d, i in sorted(set(zip(doc[fits].tolist(), t[fits].tolist()))))


TILED = ("rid long, doc_id long, n long, sha256 string, text string, "
         "tiles array<struct<octave int, lo long, words binary>>")


def tiled(docs: DataFrame, change=as_they_are, tile: int = TILE) -> DataFrame:
    """Every document (doc_id, text) with its number of words, the digest of its words joined by
    spaces, and the tiles that may hold a run; the text only where there are such tiles."""

    def lot(rows: list[tuple], ids: Iterator[int]) -> pd.DataFrame:
        number: dict = defaultdict(count().__next__)
        docs = []
        for doc_id, text in rows:
            words = change((text or "").encode("utf-8", "surrogatepass").split(), doc_id)
            coded = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            docs.append((coded, hashlib.sha256(b" ".join(words)).hexdigest()))
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i][0]))
        sizes = np.array([len(docs[i][0]) for i in order], np.int64)
        starts = np.cumsum(sizes) - sizes
        tiles: list[list] = [[] for _ in docs]
        if docs:
            numbers = np.concatenate([docs[i][0] for i in order])
            for d, k, lo in marked_tiles(numbers, starts, sizes, tile):
                words = docs[order[d]][0][lo:lo + tile_words(k, tile)]
                tiles[order[d]].append({"octave": k, "lo": lo, "words": words.tobytes()})
        return pd.DataFrame({
            "rid": [next(ids) for _ in rows], "doc_id": pd.array([r[0] for r in rows], "Int64"),
            "n": [len(d[0]) for d in docs], "sha256": [d[1] for d in docs],
            "text": [r[1] if t else None for r, t in zip(rows, tiles)], "tiles": tiles})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = count(TaskContext.get().partitionId() << 40)
        rows, chars = [], 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                if rows and chars + len(text or "") > LOT_CHARS:
                    yield lot(rows, ids)
                    rows, chars = [], 0
                rows.append((None if doc_id is None else int(doc_id), text))
                chars += len(text or "")
        if rows:
            yield lot(rows, ids)

    key = F.col("doc_id").cast("long").cast("string")  # pandas has no NULL in integer columns
    return docs.select(key.alias("doc_id"), "text").mapInPandas(run, TILED)


# ---- one tile -------------------------------------------------------------------------


def z_values(prefix: np.ndarray, x: np.ndarray, q: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
    """Words equal from places x and x+q on (or up to them, if ``back``), at most ``room``."""
    up = POWERS.get(len(prefix))[0]
    low, high = np.zeros(len(x), np.int64), room.astype(np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) // 2
        a, b = (x - mid, x) if back else (x, x + mid)
        same = (prefix[b] - prefix[a]) * up[q] == prefix[b + q] - prefix[a + q]
        low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)


def primes(q: int) -> list[int]:
    """Prime divisors of q."""
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return found + [q] * (q > 1)


def plain_stretches(words: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """What ``stretches`` gives, by comparing all words of each distance."""
    out = []
    for q in range(1 << k, min(2 << k, len(words) // 2 + 1)):
        same = np.concatenate([[False], words[:-q] == words[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        for s, e in edges.tolist():
            if e + q - s >= max(MIN_WORDS, 2 * q) and not any(
                    np.array_equal(words[s:s + q], words[s + q // p:s + q // p + q]) for p in primes(q)):
                out.append((q, s, e + q))
    return out


def stretches(words: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches of at least max(MIN_WORDS, two periods) words in one
    tile, with smallest periods of octave k."""
    n, size = len(words), block_words(k)
    prefix = prefix_hashes(words)
    found: set[tuple[int, int, int]] = set()
    for c, table in equal_blocks(block_hashes(prefix, size), size, k):
        i, j = np.nonzero(table)
        for lot in range(0, len(i), CELLS >> 3):
            x, q = c[i[lot:lot + (CELLS >> 3)]], j[lot:lot + (CELLS >> 3)] + (1 << k)
            ahead = z_values(prefix, x, q, n - x - q, back=False)
            s = x - z_values(prefix, x, q, x, back=True)
            e = x + q + ahead
            long = e - s >= np.maximum(MIN_WORDS, 2 * q)
            found.update(map(tuple, np.unique(np.stack([q[long], s[long], e[long]], 1), axis=0).tolist()))
    out, up = [], POWERS.get(n + 1)[0]
    for q, s, e in sorted(found):
        def repeats(d: int) -> bool:
            with np.errstate(over="ignore"):
                alike = (prefix[s + q] - prefix[s]) * up[d] == prefix[s + q + d] - prefix[s + d]
            return alike and np.array_equal(words[s:s + q], words[s + d:s + d + q])
        if any(repeats(q // p) for p in primes(q)):
            continue
        if (not np.array_equal(words[s:e - q], words[s + q:e]) or s and words[s - 1] == words[s - 1 + q]
                or e < n and words[e] == words[e - q]):
            return plain_stretches(words, k)  # two different blocks had one hash
        out.append((q, s, e))
    return out


def solved(tiles: DataFrame) -> DataFrame:
    """rid, period, first and end word of every stretch of tiles (rid, octave, lo, words)."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(rid, q, lo + s, lo + e) for rid, k, lo, raw in zip(pdf["rid"], pdf["octave"], pdf["lo"], pdf["words"])
                    for q, s, e in stretches(np.frombuffer(raw, np.int32), int(k))]
            yield pd.DataFrame(rows, columns=["rid", "period", "first", "end"])

    # the numbers of one document's tiles lie close together: dealt by a hash of all three
    dealt = tiles.repartition(partitions(tiles.sparkSession), "rid", "octave", "lo")
    return dealt.mapInPandas(solve, "rid long, period long, first long, end long")


def stitched(fragments: DataFrame) -> DataFrame:
    """rid, start, length, period of the runs whose fragments, cut at tiles, are given."""
    by = W.partitionBy("rid", "period").orderBy("first", "end")
    before = F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("first") + F.col("period") <= before, 0).otherwise(1)
    runs = fragments.distinct().select("*", opens.alias("opens")).select(
        "*", F.sum("opens").over(by.rowsBetween(W.unboundedPreceding, 0)).alias("run"))
    return runs.groupBy("rid", "period", "run").agg(F.min("first").alias("start"), F.max("end").alias("end")).select(
        "rid", "start", (F.col("end") - F.col("start")).alias("length"), "period")


# ---- documents ------------------------------------------------------------------------

FOUND = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
         "runs_sha256 string, collapsed_sha256 string, runs array<struct<start long, length long, period long>>")


def periodic_runs(docs: DataFrame, change=as_they_are, tile: int = TILE) -> DataFrame:
    """Per document (doc_id, text): the number of its runs; start, length, period and exponent (in
    thousandths) of the longest one, the first and then the shortest period among equals; the digest
    of all runs; the digest of the words outside every run's repetitions (a run's first turn stays);
    and the runs.

    NULL and empty texts have no words and no run (four NULLs, digests of the empty string).  Rows
    with one doc_id, NULL included, are separate documents; columns other than doc_id and text are
    not read.  ``change(words, doc_id)`` may alter the words, given as bytes, before the search.
    """
    rows = written(tiled(docs, change, tile), "runs-tiles")
    tiles = rows.select("rid", F.explode("tiles").alias("t")).select("rid", "t.octave", "t.lo", "t.words")
    runs = stitched(solved(tiles)).groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    held = rows.where("size(tiles) > 0").select("rid", "doc_id", "text").join(runs, "rid", "left")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, found in zip(pdf["doc_id"], pdf["text"], pdf["runs"]):
                doc_id = None if doc_id is None else int(doc_id)
                words = change((text or "").encode("utf-8", "surrogatepass").split(), doc_id)
                found = [] if found is None else [(r["start"], r["length"], r["period"]) for r in found]
                depth = np.zeros(len(words) + 1, np.int64)
                for s, length, q in found:
                    depth[s + q] += 1
                    depth[s + length] -= 1
                kept = [w for w, d in zip(words, np.cumsum(depth)) if not d]
                s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
                lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
                out.append((doc_id, len(found), s, length, q, 1000 * length // q if found else None,
                            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
                            [{"start": a, "length": b, "period": c} for a, b, c in found]))
            numbers = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")
            columns = dict(zip((*numbers, "runs_sha256", "collapsed_sha256", "runs"), zip(*out) if out else [()] * 9))
            yield pd.DataFrame(columns | {c: pd.array(columns[c], "Int64") for c in numbers})

    repeated = held.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "runs").mapInPandas(digest, FOUND)
    none = F.lit(None).cast("long")
    plain = rows.where("size(tiles) = 0").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), none.alias("start"), none.alias("length"), none.alias("period"),
        none.alias("exponent_milli"), F.sha2(F.lit(""), 256).alias("runs_sha256"), F.col("sha256").alias("collapsed_sha256"),
        F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>").alias("runs"))
    return plain.unionByName(repeated)
