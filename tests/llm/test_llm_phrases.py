"""Collocations against counting every phrase of every length."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import documents
from panelkit.llm import phrases

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, max_words, min_count, share, per_lang):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = defaultdict(int)
        for p, a in good.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        scored = []
        for p, a in good.items():
            if 100 * inside[p] >= share * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:per_lang])]
    return sorted(out)


def made_up(seed, texts=300):
    """Texts of a few common words, some fixed phrases and marks, in two languages and none."""
    rng = random.Random(seed)
    fixed = ["New York City", "in spite of all that", "état de droit", "a a a a", "日本 語 文"]
    words = [f"W{i}" for i in range(30)] + ["the", "of", "\x1codd word"]
    rows = []
    for _ in range(texts):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else words[min(int(rng.expovariate(0.15)), 32)] for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", " ", ", ", ".", "\r\n", "? "]) for p in parts)
        rows.append((rng.choice(["en", "en", "fr", None]), text))
    return rows


@pytest.mark.parametrize("chunk,share", [(2_000_000, 100), (500, 70)])
def test_all_phrases(spark, monkeypatch, chunk, share):
    """One chunk of all texts, and many small ones."""
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    rows = made_up(4)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, 5, 12, share, 25)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 5, 12, share, 25)


@pytest.mark.parametrize("dense,tiles", [(1 / 16, 1 << 22), (0, 1 << 22), (1e-6, 1)])
def test_tiles_of_both_kinds(monkeypatch, dense, tiles):
    """Dense and sparse tiles give the same counts, in any mixture."""
    monkeypatch.setattr(phrases, "DENSE", dense)
    monkeypatch.setattr(phrases, "TILES", tiles)
    monkeypatch.setattr(phrases, "SIDE_BITS", 4)
    rng = np.random.default_rng(2)
    left, right = (rng.exponential(20, (2, 5000)).astype(np.int64))
    codes, counts, place = phrases.tile_counts(left, right)
    want = Counter(zip(left.tolist(), right.tolist()))
    assert {(c >> 32, c & 0xFFFFFFFF): n for c, n in zip(codes.tolist(), counts.tolist())} == want
    assert len(set(codes.tolist())) == len(codes)
    assert (codes[place] == left << 32 | right).all()


def test_ranks_fall_with_frequency(spark):
    rows = [("en", " ".join(["b"] * 5 + ["a"] * 5 + ["c"] * 9 + ["d"])), ("fr", "a a")]
    state = phrases.chunks(spark.createDataFrame(rows, "lang string, text string"))
    got = sorted(tuple(r) for r in phrases.ranked(state, 2, 0).select("lang", "rank", "item", "f").collect())
    assert got == [("en", 0, "c", 9), ("en", 1, "a", 5), ("en", 2, "b", 5), ("fr", 0, "a", 2)]


def test_scores_beyond_64_bits(spark):
    """Counts of trillions of words: the products have 31 digits."""
    row = spark.sql("select cast(1000 as decimal(4,0)) * cast(4000000000000 as decimal(17,0)) * cast(7000000000000000 as decimal(17,0)) "
                    "div (cast(5000000000001 as decimal(17,0)) * cast(6000000000007 as decimal(17,0))) as s").first()
    assert row.s == 1000 * 4000000000000 * 7000000000000000 // (5000000000001 * 6000000000007)


def test_edge_rows(spark):
    docs = documents(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = phrases.collocations(docs, 5, 100, 100, 2000)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 5, 100, 100, 2000)
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_numbers_keep_their_bits():
    rng = np.random.default_rng(3)
    for top in (1, 200, 1 << 12, 1 << 31, 1 << 40):
        numbers = rng.integers(0, top, 1000)
        assert (phrases.unpacked(phrases.packed(numbers)) == numbers).all()
    assert len(phrases.unpacked(phrases.packed(np.zeros(0, np.int64)))) == 0
    for bits in (1, 5, 17, 31, 32):
        codes = np.unique(rng.integers(0, 1 << min(bits, 31), 500) << 32 | rng.integers(0, 1 << bits, 500))
        hashes = phrases.mixed(codes, bits)
        assert len(np.unique(hashes)) == len(codes)
        sent = np.cumsum(phrases.unpacked(phrases.packed(np.diff(np.sort(hashes), prepend=np.uint64(0)))).astype(np.uint64), dtype=np.uint64)
        assert sorted(phrases.unmixed(sent, bits).tolist()) == codes.tolist()
        for parts in (1, 3, 1000):
            ends = phrases.part_begins(np.sort(hashes), 2 * bits, parts)
            assert ends[0] == 0 and ends[-1] == len(codes) and (np.diff(ends) >= 0).all()


@pytest.mark.parametrize("chunk,part", [(2_000_000, 20), (500, 200)])
def test_many_parts(spark, monkeypatch, chunk, part):
    """Counts and ranks that come from many parts, for one chunk and for many."""
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(phrases, "PART_WORDS", part)
    monkeypatch.setattr(phrases, "PART_PAIRS", part)
    rows = made_up(7, 150)
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), 4, 8, 100, 25)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 4, 8, 100, 25)


def test_items_are_sent_once_and_packed(spark, monkeypatch):
    """No step deals or joins all items of the chunks as rows, and an item with its count takes a few bytes."""
    plans, tables, keep = [], {}, phrases.written

    def written(df, name):
        plans.append(df._jdf.queryExecution().toString())
        tables[name] = keep(df, name)
        return tables[name]

    monkeypatch.setattr(phrases, "written", written)
    rng = np.random.default_rng(5)
    words = rng.zipf(1.2, 200_000) % 3000
    rows = [("en", " ".join(map(str, words[i:i + 500]))) for i in range(0, len(words), 500)]
    _, levels = phrases.frequent_phrases(spark.createDataFrame(rows, "lang string, text string").coalesce(1), 3, 20)
    assert levels[2].count() > 0
    assert plans and not any(re.search(r"explode\((arrays_zip\()?items#\d+(, counts#|\))", p) for p in plans)
    pairs = tables["phrases-pairs-2"].selectExpr("size", "length(items) + length(counts) as bytes").collect()
    assert all(p.bytes < 5 * p.size for p in pairs) and sum(p.size for p in pairs) > 10_000
