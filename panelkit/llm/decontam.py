"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a document with up to k = floor(rate * m) edits.
Cut into k + 1 pieces, at least one piece then occurs unchanged: exact piece hits (one pass of
an Aho-Corasick automaton over each text) propose places, and Myers' bit-parallel distance
verifies them.  Texts and items are compared lower-cased, with ASCII punctuation and white
space folded to single spaces.  Short items take the same path with ``inside``, as the query and
the pipeline do; a chance hit in the middle of longer words is none, so such a match has to begin
and end at a word boundary.  Scripts written without spaces have boundaries everywhere.

The benchmark is dealt into blocks of bounded size; each block's automaton is broadcast and
meets all documents in one narrow pass, so documents are never shuffled and a larger benchmark
means more passes, not a larger broadcast: with more blocks than one each pass is stored and its
automaton released before the next.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Edits allowed per character of an item.
ERROR_RATE = 0.05
#: Without ``inside``, items shorter than this after folding match only a document that is nothing else.
MIN_CHARS = 32
#: Characters of benchmark text in one automaton, about; a single longer item makes its own block.
BLOCK_CHARS = 2_000_000

#: ASCII white space, control characters and punctuation become spaces.
FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def fold(text: str | None) -> str:
    return b" ".join((text or "").lower().encode().translate(FOLD).split()).decode()


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return math.floor(len(item) * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of nearly equal length that make up the item."""
    n, cuts = len(item), k + 1
    at = [n * i // cuts for i in range(cuts + 1)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


def scores(pattern: str, text: str, anchored: bool = False) -> Iterator[int]:
    """At every place of the text, the least edit distance of the pattern to a stretch that ends
    behind it (``anchored``: to the text up to there), by Myers' bit-parallel steps."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        # what enters at the top row: 0 where the match may start anywhere
        ph = (ph << 1 | anchored) & mask
        pv = (mh << 1 | ~(xv | ph)) & mask
        mv = ph & xv
        yield score


def myers(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of the text (``anchored``: to any
    beginning of it), and the first end (exclusive) where it is reached."""
    if not pattern:
        return 0, 0
    best, end = len(pattern), 0
    for j, score in enumerate(scores(pattern, text, anchored), 1):
        if score < best:
            best, end = score, j
    return best, end


def begin_of(pattern: str, text: str, end: int, distance: int) -> int:
    """Start of the match of that distance that ends at ``end``."""
    low = max(0, end - len(pattern) - distance)
    return end - myers(pattern[::-1], text[low:end][::-1], anchored=True)[1]


#: Scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, Han and its extensions.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
                      "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def boundary(text: str, at: int) -> bool:
    """Whether no word goes on across this place."""
    if not 0 < at < len(text):
        return True
    return any(not (c.isalnum() or unicodedata.category(c)[0] == "M") or UNSPACED.match(c) for c in text[at - 1:at + 1])


def best_words(pattern: str, text: str, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the nearest match within ``k`` that begins and ends at word
    boundaries of the text between ``low`` and ``high``; the first of equal ones.

    One pass gives a lower bound at every end; from the ends at boundaries a pass backwards over
    the item's length gives the distance from every start, the lowest bounds first."""
    ends = sorted((score, low + j) for j, score in enumerate(scores(pattern, text[low:high]), 1)
                  if score <= k and boundary(text, low + j))
    best = None
    for bound, end in ends:
        if best and bound > best[0]:
            break
        begin = max(low, end - len(pattern) - k)
        for j, score in enumerate(scores(pattern[::-1], text[begin:end][::-1], anchored=True), 1):
            if score <= k and boundary(text, end - j):
                found = (score, end - j, end)
                best = found if best is None or found < best else best
    return best


class Matcher:
    """The automaton over the pieces of one block of items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = ERROR_RATE,
                 min_chars: int = MIN_CHARS, inside: bool = False):
        self.inside = inside
        self.items, self.whole = [], {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = fold(text)
            if not text:
                continue
            if len(text) < min_chars and not inside:
                self.whole.setdefault(text, []).append(item_id)
                continue
            k = budget(text, rate)
            for offset, piece in pieces(text, k):
                owners.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, text, k))
        self.owners = list(owners.values())
        self.words = list(owners)
        self.automaton = None

    def search(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, distance, start, end in the folded text) of every item that occurs within
        its budget, at its best place."""
        folded = fold(text)
        out = [(i, 0, 0, len(folded)) for i in self.whole.get(folded, ())]
        if self.words and self.automaton is None:  # built once in each worker
            self.automaton = ahocorasick.Automaton()
            for i, word in enumerate(self.words):
                self.automaton.add_word(word, i)
            self.automaton.make_automaton()
        places: dict[int, list[int]] = {}
        for end, word in self.automaton.iter(folded) if self.automaton is not None else ():
            begin = end + 1 - len(self.words[word])
            for item, offset in self.owners[word]:
                places.setdefault(item, []).append(begin - offset)
        for item, begins in places.items():
            item_id, pattern, k = self.items[item]
            best = None
            for low, high in windows(sorted(set(begins)), len(pattern), k):
                low, high = max(0, low), min(len(folded), high)
                if self.inside:
                    match = best_words(pattern, folded, low, high, k)
                    best = match if match and (best is None or match[0] < best[0]) else best
                    continue
                found, end = myers(pattern, folded[low:high])
                if found <= k and (best is None or found < best[0]):
                    best = (found, low + end)
            if best and len(best) == 3:
                out.append((item_id, *best))
            elif best:
                out.append((item_id, best[0], begin_of(pattern, folded, best[1], best[0]), best[1]))
        return out


def windows(begins: list[int], m: int, k: int) -> Iterator[tuple[int, int]]:
    """Merged stretches in which an item of length m that begins within k of a place may lie."""
    low = high = None
    for b in begins:
        if low is not None and b - k <= high:
            high = b + m + k
            continue
        if low is not None:
            yield low, high
        low, high = b - k, b + m + k
    if low is not None:
        yield low, high


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[int, Iterator[list[tuple[int | None, str]]]]:
    """How many blocks of items, and the blocks, whose text stays near ``block_chars``; equal items once."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_chars))

    def block(i: int) -> list[tuple[int | None, str]]:
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        return [(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()]

    return n, map(block, range(n))


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE,
          min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS, inside: bool = False) -> DataFrame:
    """One row per document row and item found in it, at its nearest place only: distance, start and
    end in the folded text.

    NULL and empty texts and items match nothing; with ``inside`` an item matches whole words within its
    budget, else anywhere, but one shorter than ``min_chars`` only texts that are nothing but the item; items
    with equal id and text count once; repeated document rows give repeated result rows; empty tables
    give an empty result.
    """
    def found(rows: DataFrame, hits: F.Column) -> DataFrame:
        return rows.select("doc_id", F.explode(hits).alias("hit")).select(
            "doc_id", *(F.col("hit")[i].alias(c) for i, c in enumerate(("item_id", "distance", "start", "end"))))

    count, parts = blocks(benchmark, block_chars)
    return reduce(DataFrame.unionAll, [passed(docs, Matcher(p, rate, min_chars, inside), found, count) for p in parts])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE,
               min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS, inside: bool = False) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    count, parts = blocks(benchmark, block_chars)
    for p in parts:
        docs = passed(docs, Matcher(p, rate, min_chars, inside), lambda rows, hits: rows.where(F.size(hits) == 0), count)
    return docs


def passed(docs: DataFrame, matcher: Matcher, use, count: int) -> DataFrame:
    """``use(docs, hits)``, hits being arrays [item id, distance, start, end] of each text.  One of
    several passes is stored, so its automaton can go from driver and executors."""
    shared = docs.sparkSession.sparkContext.broadcast(matcher)

    @F.pandas_udf("array<array<bigint>>")
    def hits(texts: pd.Series) -> pd.Series:
        return pd.Series([[list(hit) for hit in shared.value.search(t)] for t in texts], dtype=object)

    out = use(docs, hits(F.col("text")))
    if count > 1:
        out = written(out, "decontam-pass")
        shared.destroy()
    return out
