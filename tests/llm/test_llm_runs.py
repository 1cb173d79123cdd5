"""Periodic runs against plain scans of every distance."""

import hashlib
import random

import numpy as np
import pytest
from edge import documents
from panelkit.llm import queries, runs
from conftest import SF001


def plain_runs(words):
    """(start, end, period) of all runs, by walking along every distance."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(runs.MIN_WORDS, 2 * q):
                found.setdefault((s, i + q), q)
            i = max(i, s + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def plain_row(doc_id, text, change=runs.planted):
    words = change((text or "").encode().split(), doc_id)
    found = plain_runs(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    s, e, q = min(found, key=lambda r: (r[0] - r[1], r[0], r[2])) if found else (None, 0, None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), s, e - s if found else None, q, 1000 * (e - s) // q if found else None,
            sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def random_words(rng):
    n, letters = rng.randint(0, 240), rng.choice([1, 2, 3, 40])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 5 else 0):
        p, a = rng.randint(1, n // 3), rng.randrange(n)
        for i in range(a + p, min(n, a + rng.randint(1, n))):
            words[i] = words[i - p]
    return words


def test_one_tile_of_each_octave():
    rng = random.Random(3)
    for _ in range(150):
        words = random_words(rng)
        a = np.array(words, np.int32)
        got = sorted((s, e, q) for k in range(runs.octaves(len(a))) for q, s, e in runs.stretches(a, k))
        assert got == plain_runs(words)
        assert got == sorted((s, e, q) for k in range(runs.octaves(len(a))) for q, s, e in runs.plain_stretches(a, k))


@pytest.mark.parametrize("tile", [32, runs.TILE])
def test_tiles_stitched(spark, tile):
    """Tiles of 32 words cut almost every run; the last texts repeat stretches over many tiles."""
    rng = random.Random(11)
    texts = [" ".join(map(str, random_words(rng))) for _ in range(150)]
    turn = [str(rng.randrange(10 ** 6)) for _ in range(700)]
    texts += [" ".join(turn * 3), " ".join(turn[:90] * 40 + turn), "ab " * 4000, " ".join(turn[:130] + turn[:64] + turn)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r)[:8] for r in runs.periodic_runs(docs, tile=tile).collect())
    assert got == [plain_row(i, t, runs.as_they_are) for i, t in enumerate(texts)]


def test_query_against_plain_scan(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").where("length(text) < 9000").collect()
    got = {r.doc_id: tuple(r) for r in queries.op13_runs(spark, SF001).collect()}
    assert len(got) >= len(rows) > 100
    for r in rows:
        assert got[r.doc_id] == plain_row(r.doc_id, r.text)


def test_false_block_hashes_are_found_out(monkeypatch):
    """With all blocks alike to the hash, the words themselves still decide."""
    monkeypatch.setattr(runs, "prefix_hashes", lambda words: np.zeros(len(words) + 1, np.uint64))
    a = np.array([1, 2, 3, 4, 5, 6] * 4 + list(range(10, 60)), np.int32)
    assert [(s, e, q) for k in range(runs.octaves(len(a))) for q, s, e in runs.stretches(a, k)] == [(0, 24, 6)]


def test_edge_rows(spark):
    docs = documents(spark)
    got = runs.periodic_runs(docs, runs.planted).collect()
    assert len(got) == docs.count()
    want = [plain_row(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 40_000]
    rows = sorted((tuple(r)[:8] for r in got), key=repr)
    assert all(w in rows for w in want)
    long = next(r for r in got if r.doc_id == 5)
    assert (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (1, 0, 90_000, 3, 30_000_000)
    assert long.collapsed_sha256 == hashlib.sha256(b"the thing is").hexdigest()
    assert runs.periodic_runs(docs.limit(0)).collect() == []
