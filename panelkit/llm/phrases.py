"""Collocations: phrases whose words stand together more often than their parts let expect.

Counting is by direct-address tiling.  ``chunks`` turns texts into sequences of word numbers, a few
million words at a time, each chunk with its own list of words.  A level then goes like this:

1. Every chunk sends its items (words, later pairs) with their counts, packed, to the parts that add
   them up.  A part keeps the items found ``min_count`` times or more and answers each chunk with the
   places of these in its list, so items travel once (``counted``).  The frequent ones get ranks by
   falling frequency (``ranked``).
2. The answers bring the ranks to the chunk, which rewrites its sequence in them.  Two neighbours
   make a pair; pairs fall into square tiles of ``SIDE`` x ``SIDE`` ranks.  A well filled tile, as the
   commonest ranks make, is counted by ``bincount`` over its cells; pairs of the other tiles are
   sorted and counted as coordinates (``tile_counts``).
3. The chunk's sequence becomes one of pairs, and the frequent pairs are ranked in turn: two pairs that
   overlap make a phrase of three words, and so on.

A chunk's items are sorted by a hash, so the items of one part are a slice of them whatever the number of
parts, which follows from the number of items.  Only what one chunk or one part holds is ever in one
place.  Nothing is broadcast that grows with the vocabulary.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

MAX_WORDS, MIN_COUNT, PER_LANG = 5, 100, 2000
#: Words of the open chunks of a task, about; a longer text makes its own chunk.
CHUNK_WORDS = 2_000_000
#: Ranks on one side of a tile, as a power of two, and the share of its cells from which a tile is dense.
SIDE_BITS, DENSE = 10, 1 / 16
#: Tiles that are counted by address; with more, the tiles that occur are sorted out.
TILES = 1 << 22
#: Items that chunks send to one part, about: words, pairs.
PART_WORDS, PART_PAIRS = 1 << 19, 1 << 21
#: Odd, so that multiplying by it modulo a power of two can be undone; its high bits mix all bits of a code.
MIX = 0x9E3779B97F4A7C15
NO_LANG = "und"
#: Bytes that end a piece.  Every one becomes a line break, which leaves the full stop free to mark it.
ENDS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(bytes(range(65, 91)) + ENDS, bytes(range(97, 123)) + b"\n" * len(ENDS))
BREAK = b"."


# ---- chunks ---------------------------------------------------------------------------


def words_of(texts: list[str | None]) -> list[bytes]:
    """Words of texts in small letters (A-Z only), with BREAK between pieces and between texts."""
    folded = b"\n".join((t or "").encode("utf-8", "surrogatepass").translate(FOLD) for t in texts)
    return folded.replace(b"\n", b" " + BREAK + b" ").split()


def squeezed(ids: np.ndarray) -> np.ndarray:
    """A sequence in which several gaps (-1) in a row are one."""
    return ids[(ids >= 0) | np.concatenate([[False], ids[:-1] >= 0])] if len(ids) else ids


#: Of a chunk: its sequence, its number of items, the items in the order of their hash and their counts.
WORDS = "chunk long, lang string, n long, ids binary, size long, items binary, counts binary"
PAIRS = "chunk long, lang string, ids binary, size long, items binary, counts binary"


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0, compressed: all lowest bytes first, the next ones behind them, ..."""
    top = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    planes = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return struct.pack("<BQ", width, len(numbers)) + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(raw: bytes) -> np.ndarray:
    """What ``packed`` was given, as int64 (numbers of 64 bits keep these bits)."""
    width, size = struct.unpack_from("<BQ", raw)
    planes = pa.decompress(raw[9:], decompressed_size=width * size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, size).T.copy().view(f"<u{width}").ravel().astype(np.int64)


def packed_words(words: list[bytes]) -> bytes:
    """Words, which hold no line end, compressed."""
    text = b"\n".join(words)
    return struct.pack("<Q", len(text)) + pa.compress(text, codec="zstd", asbytes=True)


def unpacked_words(raw: bytes) -> list[bytes]:
    return pa.decompress(raw[8:], decompressed_size=struct.unpack_from("<Q", raw)[0], codec="zstd", asbytes=True).split(b"\n")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words))


def mixed(codes: np.ndarray, bits: int) -> np.ndarray:
    """Codes left << 32 | right of ranks below 2 ** bits, spread one to one over the numbers of 2 * bits bits."""
    codes = codes.astype(np.uint64)
    short = (codes >> np.uint64(32)) << np.uint64(bits) | codes & np.uint64((1 << 32) - 1)
    return short * np.uint64(MIX) & np.uint64((1 << 2 * bits) - 1)


def unmixed(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The codes that ``mixed`` spread."""
    short = hashes.astype(np.uint64) * np.uint64(pow(MIX, -1, 1 << 64)) & np.uint64((1 << 2 * bits) - 1)
    return ((short >> np.uint64(bits)) << np.uint64(32) | short & np.uint64((1 << bits) - 1)).astype(np.int64)


def part_begins(hashes: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Where each part begins in sorted hashes of ``bits`` bits, and the end."""
    high = hashes.astype(np.uint64) >> np.uint64(max(0, bits - 32))  # up to 2 ** 32 parts
    part = high * np.uint64(parts) >> np.uint64(min(bits, 32))
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def chunks(docs: DataFrame) -> DataFrame:
    """Sequences of word numbers (-1 between pieces) of the texts of one language each, with the
    chunk's words and how often each occurs."""

    class Open:
        def __init__(self):
            self.number: dict[bytes, int] = defaultdict(count(1).__next__)
            self.number[BREAK] = 0
            self.parts: list[np.ndarray] = []

        def add(self, texts: list[str | None]) -> int:
            words = words_of(texts)
            self.parts.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)) - 1)
            self.parts.append(np.array([-1], np.int32))
            return len(words)

        def row(self, chunk: int, lang: str) -> pd.DataFrame:
            ids = np.concatenate(self.parts)
            words = [w for w in self.number if w != BREAK]
            counts = np.bincount(ids[ids >= 0], minlength=len(words))
            order = np.argsort(word_hashes(words), kind="stable")
            place = np.full(len(words) + 1, -1, np.int32)  # the last place is that of -1
            place[order] = np.arange(len(words))
            return pd.DataFrame({"chunk": [chunk], "lang": [lang], "n": [int(counts.sum())], "ids": [packed(squeezed(place[ids]) + 1)],
                                 "size": [len(words)], "items": [packed_words([words[i] for i in order])], "counts": [packed(counts[order])]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = count(TaskContext.get().partitionId() << 32)
        open_: dict[str, Open] = defaultdict(Open)
        held = 0
        for pdf in batches:
            for lang, texts in pdf.groupby("lang", sort=False)["text"]:
                waiting, chars = [], 0
                for text in [*texts, ...]:
                    if waiting and (text is ... or chars > CHUNK_WORDS):  # texts of a few MB together
                        held += open_[lang].add(waiting)
                        waiting, chars = [], 0
                        if held >= CHUNK_WORDS:
                            yield from (o.row(next(numbers), x) for x, o in open_.items())
                            open_.clear()
                            held = 0
                    if text is not ...:
                        waiting.append(text)
                        chars += len(text or "")
        yield from (o.row(next(numbers), x) for x, o in open_.items())

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), "text").where(
        F.col("text").isNotNull()).mapInPandas(run, WORDS)


# ---- one level ------------------------------------------------------------------------


MESSAGES = "part long, lang string, chunk long, begin long, items binary, counts binary"


def counted(state: DataFrame, min_count: int, level: int, bits: int = 0) -> DataFrame:
    """What the parts found: in rows without a chunk the items of at least ``min_count`` in all chunks and
    their counts f; in rows with one, the places (locals) that the chunk gave such items, and of each its
    place (index) in the part's row.  Items are words, or with ``bits`` pairs of ranks of so many bits."""
    total = state.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // (PART_PAIRS if bits else PART_WORDS)))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, lang, raw, times in zip(pdf["chunk"], pdf["lang"], pdf["items"], pdf["counts"]):
                counts = unpacked(times)
                if not len(counts):
                    continue
                if bits:
                    items = np.cumsum(unpacked(raw).astype(np.uint64), dtype=np.uint64)
                    ends = part_begins(items, 2 * bits, parts)
                else:
                    items = unpacked_words(raw)
                    ends = part_begins(word_hashes(items), 32, parts)
                out = []
                for part in np.flatnonzero(np.diff(ends)).tolist():
                    own = slice(ends[part], ends[part + 1])
                    sent = packed(np.diff(items[own], prepend=np.uint64(0))) if bits else packed_words(items[own])
                    out.append((part, lang, chunk, int(ends[part]), sent, packed(counts[own])))
                yield pd.DataFrame(out, columns=["part", "lang", "chunk", "begin", "items", "counts"])

    def add_up(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
        sent = sent.sort_values("chunk")
        counts = [unpacked(x) for x in sent["counts"]]
        if bits:
            found, which = np.unique(np.concatenate([np.cumsum(unpacked(x).astype(np.uint64), dtype=np.uint64) for x in sent["items"]]),
                                     return_inverse=True)
        else:
            number: dict[bytes, int] = defaultdict(count().__next__)
            which = np.concatenate([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in map(unpacked_words, sent["items"])])
            found = list(number)
        f = np.zeros(len(found), np.int64)
        np.add.at(f, which, np.concatenate(counts))
        good = np.flatnonzero(f >= min_count)
        if not len(good):
            return pd.DataFrame(columns=columns)
        index = np.full(len(found), -1, np.int64)
        index[good] = np.arange(len(good))
        items = unmixed(found[good], bits) if bits else [found[i].decode("utf-8", "surrogatepass") for i in good]
        out = [(key[0], key[1], None, None, None, items, f[good])]
        at = 0
        for chunk, begin, size in zip(sent["chunk"], sent["begin"], map(len, counts)):
            own = index[which[at:at + size]]
            at += size
            hit = np.flatnonzero(own >= 0)
            if len(hit):
                out.append((key[0], key[1], chunk, packed(np.diff(begin + hit, prepend=0)), packed(own[hit]), None, None))
        return pd.DataFrame(out, columns=columns).astype({"chunk": "Int64"})

    columns = ["lang", "part", "chunk", "locals", "indexes", "items", "f"]
    kind = "long" if bits else "string"
    sent = state.select("chunk", "lang", "items", "counts").mapInPandas(send, MESSAGES)
    return written(sent.groupBy("lang", "part").applyInPandas(
        add_up, f"lang string, part long, chunk long, locals binary, indexes binary, items array<{kind}>, f array<long>"),
        f"phrases-counts-{level}")


def ranked(state: DataFrame, min_count: int, level: int, counts: DataFrame | None = None) -> DataFrame:
    """lang, item, f and rank (from 0 by falling f, per language) of the items of all chunks found at
    least ``min_count`` times, and where they stand in ``counts`` (part and index; ``counted`` of words, if
    not given).  Rows are ordered over many tasks; what stands in the tasks before gives the rank that a
    task begins with."""
    counts = counted(state, min_count, level) if counts is None else counts
    total = counts.where(F.col("chunk").isNull()).select("lang", F.col("part").alias("of"), F.posexplode(F.arrays_zip("items", "f")).alias("index", "x"))
    total = total.select("lang", "of", "index", F.col("x.items").alias("item"), F.col("x.f").alias("f"))
    order = [F.desc("f"), F.asc("item")]
    dealt = written(total.repartitionByRange("lang", *order).withColumn("part", F.spark_partition_id()),
                    f"phrases-ranks-{level}")
    sizes = dealt.groupBy("lang", "part").agg(F.count("*").alias("size"))
    earlier = W.partitionBy("lang").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per task
    begins = sizes.select("lang", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("begin"))
    place = F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))
    return dealt.withColumn("place", place).join(begins, ["lang", "part"]).select(
        "lang", "item", "f", (F.col("begin") + F.col("place") - 1).alias("rank"), F.col("of").alias("part"), "index")


def answers(counts: DataFrame, ranks: DataFrame) -> DataFrame:
    """chunk, locals and ranks: what the parts answer to each chunk, in ranks."""

    def answer(replies: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        rank = np.zeros(len(table), np.int64)
        rank[table["index"].to_numpy()] = table["rank"].to_numpy()
        return pd.DataFrame({"chunk": replies["chunk"], "locals": replies["locals"],
                             "ranks": [packed(rank[unpacked(x)]) for x in replies["indexes"]]})

    replies = counts.where(F.col("chunk").isNotNull()).select("lang", "part", "chunk", "locals", "indexes")
    table = ranks.select("lang", "part", "index", "rank")
    return replies.groupBy("lang", "part").cogroup(table.groupBy("lang", "part")).applyInPandas(
        answer, "chunk long, locals binary, ranks binary")


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes left << 32 | right that occur, how often, for each pair its place among them)."""
    if not len(left):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    side = int(max(left.max(), right.max()) >> SIDE_BITS) + 1
    tile = (left >> SIDE_BITS) * side + (right >> SIDE_BITS)
    if side * side <= TILES:
        filled = np.bincount(tile, minlength=1)
        dense = np.flatnonzero(filled >= DENSE * (1 << 2 * SIDE_BITS))
    else:
        tiles, filled = np.unique(tile, return_counts=True)
        dense = tiles[filled >= DENSE * (1 << 2 * SIDE_BITS)]
    place = np.empty(len(left), np.int64)
    codes, counts, known = [], [], 0
    mask, rest = (1 << SIDE_BITS) - 1, np.ones(len(left), bool)
    for t in dense.tolist():
        here = np.flatnonzero(tile == t)
        rest[here] = False
        cell = (left[here] & mask) << SIDE_BITS | right[here] & mask
        n = np.bincount(cell, minlength=1 << 2 * SIDE_BITS)
        used = np.flatnonzero(n)
        n[used], times = np.arange(known, known + len(used)), n[used]
        place[here] = n[cell]
        codes.append((t // side << SIDE_BITS | used >> SIDE_BITS) << 32 | t % side << SIDE_BITS | used & mask)
        counts.append(times)
        known += len(used)
    here = np.flatnonzero(rest)
    coordinates, where, times = np.unique(left[here] << 32 | right[here], return_inverse=True, return_counts=True)
    place[here] = known + where
    return np.concatenate([*codes, coordinates]), np.concatenate([*counts, times]), place


def paired(state: DataFrame, known: DataFrame, bits: int) -> DataFrame:
    """The chunks rewritten as sequences of pairs of neighbouring frequent items, whose ranks of
    ``bits`` bits are in the ``answers`` to the chunks."""

    def pair(sequences: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        out = []
        for chunk, lang, size, raw in zip(sequences["of"], sequences["lang"], sequences["size"], sequences["ids"]):
            rank = np.full(size + 1, -1, np.int64)  # the first place is that of a gap
            for local, ranks in zip(table["locals"], table["ranks"]):
                rank[np.cumsum(unpacked(local)) + 1] = unpacked(ranks)
            ids = rank[unpacked(raw)]
            good = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            codes, counts, place = tile_counts(ids[good], ids[good + 1])
            hashes = mixed(codes, bits)
            order = np.argsort(hashes)
            into = np.empty(len(codes), np.int32)
            into[order] = np.arange(len(codes))
            pairs = np.full(len(ids), -1, np.int32)
            pairs[good] = into[place]
            if len(codes):
                out.append((chunk, lang, packed(squeezed(pairs) + 1), len(codes),
                            packed(np.diff(hashes[order], prepend=np.uint64(0))), packed(counts[order])))
        return pd.DataFrame(out, columns=["chunk", "lang", "ids", "size", "items", "counts"])

    sequences = state.select(F.col("chunk").alias("of"), "lang", "size", "ids")
    return sequences.groupBy("of").cogroup(known.groupBy("chunk")).applyInPandas(pair, PAIRS)


# ---- phrases --------------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> tuple[DataFrame, list[DataFrame]]:
    """(words per language, for each length the phrases found at least ``min_count`` times: lang, rank,
    phrase, last (its last word), f, firsts and lasts (how often its first and last 1, 2, ... words occur),
    and the ranks of its first and last words but one, left and right)."""
    state = written(chunks(docs), "phrases-words")
    total = state.groupBy("lang").agg(F.sum("n").alias("n"))
    counts = counted(state, min_count, 1)
    ranks = written(ranked(state, min_count, 1, counts), "phrases-level-1")
    none = F.lit(None).cast("long")
    levels = [ranks.select("lang", "rank", F.col("item").alias("phrase"), F.col("item").alias("last"), "f",
                           F.array("f").alias("firsts"), F.array("f").alias("lasts"), none.alias("left"), none.alias("right"))]
    for level in range(2, max_words + 1):
        bits = max(1, (ranks.agg(F.max("rank")).first()[0] or 0).bit_length())
        state = written(paired(state, answers(counts, ranks), bits), f"phrases-pairs-{level}")
        counts = counted(state, min_count, level, bits)
        ranks = written(ranked(state, min_count, level, counts), f"phrases-level-{level}")
        low = F.lit((1 << 32) - 1)
        pairs = ranks.select("lang", "rank", "f", F.shiftright("item", 32).alias("left"), F.col("item").bitwiseAND(low).alias("right"))
        first = levels[-1].select("lang", F.col("rank").alias("left"), "phrase", "firsts")
        second = levels[-1].select("lang", F.col("rank").alias("right"), "last", "lasts")
        found = pairs.join(first, ["lang", "left"]).join(second, ["lang", "right"]).select(
            "lang", "rank", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
            F.concat("firsts", F.array("f")).alias("firsts"), F.concat("lasts", F.array("f")).alias("lasts"), "left", "right")
        levels.append(written(found, f"phrases-found-{level}"))
    return total, levels


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 share_percent: int = 100, per_lang: int = PER_LANG) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best ``per_lang`` phrases of each language.

    ``docs`` needs lang and text; other columns are not read.  Texts are folded to small letters (A-Z
    only) and cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and tabs; phrases
    of 2 to ``max_words`` words do not cross pieces.  a, l and r count the phrase, its first and its other
    words at the cut with the lowest score floor(1000 * a * n / (l * r)) (the first such cut), n all words
    of the language.  A phrase inside a longer candidate that reaches ``share_percent`` of its count is
    dropped.  Ties of score go to larger a, then to the phrase by its bytes.

    NULL and empty texts hold no word, a NULL language is ``und``; repeated rows count again; an empty
    table gives no rows.  No language has a limit on words, phrases or counts before the final report.
    """
    total, levels = frequent_phrases(docs, max_words, min_count)
    found = None
    for m, level in enumerate(levels[1:], 2):
        rows = level
        if m < max_words:  # one word more is enough: what is between has at least the longer one's count
            longer = levels[m]
            inside = longer.select("lang", F.col("left").alias("rank"), F.col("f").alias("longer")).unionByName(
                longer.select("lang", F.col("right").alias("rank"), F.col("f").alias("longer")))
            most = inside.groupBy("lang", "rank").agg(F.max("longer").alias("longer"))
            rows = rows.join(most, ["lang", "rank"], "left").where(
                F.col("longer").isNull() | (100 * F.col("longer") < share_percent * F.col("f")))
        rows = rows.select("lang", "phrase", "f", "firsts", "lasts", F.lit(m).alias("words"))
        found = rows if found is None else found.unionByName(rows)
    # products of three counts need more than 64 bits: decimals of 38 digits are exact
    score = ("transform(sequence(1, words - 1), k -> struct("
             "cast(1000 as decimal(4,0)) * cast(f as decimal(17,0)) * cast(n as decimal(17,0)) div "
             "(cast(firsts[k - 1] as decimal(17,0)) * cast(lasts[words - k - 1] as decimal(17,0))) as score, k as k, "
             "firsts[k - 1] as l, lasts[words - k - 1] as r))")
    scored = found.join(total, "lang").withColumn("cut", F.array_min(F.expr(score))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = scored.withColumn("share", share).withColumn(
        "place", F.row_number().over(W.partitionBy("lang", "share").orderBy(*best))).where(F.col("place") <= per_lang)
    return near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long")).where(
        F.col("rank") <= per_lang).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
