"""Near copies, decontamination, mixing, sharding, tokens and chat against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF001, SF01
from edge import LONG, ROWS, documents, plain
from panelkit.llm import chat, decontam, mixing, queries, sharding, simhash, tokens
from panelkit.llm.common import table


# ---- SimHash ------------------------------------------------------------------------

def naive_simhash(text, k=3):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)][:len(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def naive_components(prints, bits=2):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_query_against_all_pairs(spark):
    docs = table(spark, SF001, "documents", "doc_id", "text").collect()
    prints = {r.doc_id: naive_simhash(r.text) for r in docs}
    want = naive_components(prints)
    got = queries.op8_simhash(spark, SF001).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{p:016x}", want[i]) for i, p in prints.items()}
    assert len(got) == len(docs)


def planted_prints(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n, dtype=np.int64)
    out = set(base.tolist())
    for b in base[:n // 2].tolist():
        for _ in range(6):  # chains of small steps
            for k in rng.integers(0, 63, rng.integers(1, 4)):
                b ^= 1 << int(k)
            out.add(b)
    dense = int(base[0])
    out |= {dense ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)}
    return sorted(out)


def test_vantage_tree_finds_every_component(spark):
    prints = planted_prints(300, 9)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long").cache()
    stars = simhash.link_stars(fps, 2, sample=256, leaf_target=60)
    got = {r.node: r.root for r in simhash.components(stars).collect()}
    want = naive_components({p: p & (1 << 64) - 1 for p in prints})
    assert {p: got.get(p, p) for p in prints} == want
    assert stars.count() <= 4 * len(prints)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_midpoints_give_the_links_of_dense_leaves(spark, bits):
    prints = planted_prints(40, 12)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long").cache()
    want = naive_components({p: p & (1 << 64) - 1 for p in prints}, bits)
    for leaf_max in (0, 30):  # all leaves, and only some
        stars = simhash.link_stars(fps, bits, sample=64, leaf_target=16, leaf_max=leaf_max)
        got = {r.node: r.root for r in simhash.components(stars).collect()}
        assert {p: got.get(p, p) for p in prints} == want


def test_a_ball_of_50000_fingerprints_meets_in_no_task(spark, monkeypatch):
    rng = np.random.default_rng(3)
    ball = {0} | {1 << i for i in range(63)} | {1 << i | 1 << j for i in range(63) for j in range(i)}
    ball |= {1 << i | 1 << j | 1 << k for i in range(63) for j in range(i) for k in range(j)}
    ball |= {x ^ 1 << 10 for x in list(ball)[:20_000]}
    apart = [int(x) for x in rng.integers(1 << 61, 1 << 62, 3_000)]
    prints = sorted(ball | set(apart))
    assert len(ball) > 41_000
    leaf_stars = simhash.leaf_stars

    def bounded(x, bits):
        assert len(x) <= 5_000
        return leaf_stars(x, bits)

    monkeypatch.setattr(simhash, "leaf_stars", bounded)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    stars = simhash.link_stars(fps, 2, sample=4_096, leaf_target=500, leaf_max=5_000)
    roots = {r.node: r.root for r in simhash.components(stars).collect()}
    assert {roots.get(p, p) for p in ball} == {0}
    near = {p for p in apart if p.bit_count() <= 6}
    assert all(roots.get(p, p) != 0 for p in set(apart) - near)


@pytest.mark.parametrize("block", [8, 64])
def test_leaf_blocks_against_all_pairs(block):
    prints = planted_prints(60, block)
    a, b = simhash.leaf_stars(np.array(prints), 2, block)
    got = dict(zip(a.tolist(), b.tolist()))
    assert {p: got.get(p, p) for p in prints} == naive_components({p: p & (1 << 64) - 1 for p in prints})


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(70)] + [(200, 100)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 71)}, 200: 100}


def test_near_copies_on_edge_rows(spark):
    docs = documents(spark)
    got = simhash.near_copies(docs).collect()
    assert len(got) == len(ROWS)
    zero = {r.doc_id: r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {3: 3, 4: 3, 8: 3, None: 3}
    kept = simhash.drop_near_copies(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter([1, 3, 5, 6, 7, 9, 10, None])
    assert kept[0].__fields__ == docs.columns
    assert simhash.near_copies(docs.limit(0)).count() == 0 and simhash.drop_near_copies(docs.limit(0)).count() == 0


# ---- decontamination ----------------------------------------------------------------

def nearest(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edits(a: str, b: str) -> int:
    """Edit distance of two whole strings."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def test_matcher_against_full_edit_distance():
    random.seed(10)
    for _ in range(150):
        items = [(i, "".join(random.choices("abcdefgh ", k=random.randint(40, 110)))) for i in range(4)]
        x = list(items[1][1])
        for _ in range(random.randint(0, 5)):
            x[random.randrange(len(x))] = random.choice(["", "z", "zz"])
        doc = "".join(random.choices("abcdefgh ", k=80)) + "".join(x) + "".join(random.choices("ab .", k=60))
        folded = decontam.fold(doc)
        want = {i: nearest(decontam.fold(t), folded) for i, t in items}
        want = {i: d for i, d in want.items() if d <= decontam.budget(decontam.fold(items[i][1]))}
        hits = decontam.Matcher(items).search(doc)
        assert {h[0]: h[1] for h in hits} == want
        for i, d, a, b in hits:
            assert decontam.myers(decontam.fold(items[i][1]), folded[a:b])[0] == d


def test_myers_against_dynamic_programming():
    random.seed(11)
    for _ in range(800):
        p, t = ("".join(random.choices("abc", k=random.randint(lo, 12))) for lo in (1, 0))
        assert decontam.myers(p, t)[0] == nearest(p, t)


def test_leaks_query_against_brute_force(spark):
    items = [(r.item_id, decontam.fold(r.text)) for r in table(spark, SF001, "benchmark").collect()]
    docs = table(spark, SF001, "documents", "doc_id", "text").collect()
    want = {(d.doc_id, i) for d in docs for i, t in items if t in decontam.fold(d.text)}
    got = queries.op9_decontamination(spark, SF001).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.distance == 0} == want
    by_id, by_item = {d.doc_id: decontam.fold(d.text) for d in docs}, dict(items)
    for r in got:
        assert nearest(by_item[r.item_id], by_id[r.doc_id][r.start:r.end]) == r.distance


def test_decontamination_blocks_and_edge_rows(spark):
    docs = documents(spark)
    bench = spark.createDataFrame([
        (1, "ALPHA beta, gamma delta epsilon - zeta eta theta iota kappa LAMBDA"), (None, "alpha beta gammma delta epsilon zeta eta theta"),
        (3, None), (4, ""), (5, "nameless text of some"), (6, "nameless text of some words here!"), (7, "password"),
        (1, "ALPHA beta, gamma delta epsilon - zeta eta theta iota kappa LAMBDA")], "item_id long, text string")
    one = plain(decontam.leaks(docs, bench))
    assert plain(decontam.leaks(docs, bench, block_chars=40)) == one
    assert Counter((r[0], r[1]) for r in one) == Counter(
        [(i, item) for i in (1, 1, 2) for item in (1, None)] + [(None, 6)])
    left = decontam.drop_leaks(docs, bench, block_chars=40)
    assert Counter(r.doc_id for r in left.collect()) == Counter([3, 4, None, 5, 6, 7, 8, 9, 10])
    assert decontam.leaks(docs.limit(0), bench).count() == 0 and decontam.leaks(docs, bench.limit(0)).count() == 0
    assert decontam.drop_leaks(docs, bench.limit(0)).count() == len(ROWS)


def test_short_items_are_found_inside_documents(spark, tmp_path):
    bench = spark.createDataFrame([(1, "Who wrote Faust?"), (2, "富士山の高さは何メートルですか"), (3, "the capital of peru is lima"),
                                   (4, "art"), (5, "who wrote faust")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Quiz. Who wrote Faust? Goethe."), (2, "次の問題:富士山の高さは何メートルですかと聞いた"), (3, "x The capital of Peru js Lima, y"),
        (4, "who wrote fausts"), (5, "a party started"), (6, "modern art, though"), (7, None)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op9_decontamination(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in got} == {(1, 1, 0), (1, 5, 0), (2, 2, 0), (3, 3, 1), (6, 4, 0)}
    assert {tuple(r)[3:] for r in got if r.doc_id == 1} == {(5, 20)}
    import corpus_pipeline
    assert sorted(r.doc_id for r in corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).collect()) == [4, 5, 7]


def test_short_items_against_full_edit_distance():
    random.seed(18)
    for _ in range(400):
        item = " ".join("".join(random.choices("ab", k=random.randint(1, 4))) for _ in range(random.randint(3, 9)))[:31].strip()
        x = list(item)
        x[random.randrange(len(x))] = random.choice(["", "c", "a", " "])
        doc = decontam.fold("".join(random.choices("ab ", k=20)) + random.choice([" ", "", "c"]) + "".join(x) + random.choice([" ", ""]) + "".join(
            random.choices("ab ", k=20)))
        k, ends = decontam.budget(item), [i for i in range(len(doc) + 1) if i in (0, len(doc)) or " " in doc[i - 1:i + 1]]
        want = min((edits(item, doc[a:b]), a, b) for a in ends for b in ends if a < b)
        got = decontam.Matcher([(1, item)], inside=True).search(doc)
        assert got == ([(1, *want)] if want[0] <= k else []), (item, doc)


def test_one_rule_for_items_of_all_lengths():
    random.seed(31)
    for chars in (12, 20, 31, 32, 33, 60, 90):
        for _ in range(25):
            item = " ".join("".join(random.choices("abcd", k=random.randint(1, 7))) for _ in range(40))[:chars]
            item = item.strip() + "a" * (chars - len(item.strip()))
            x = list(item)
            for _ in range(random.randint(0, decontam.budget(item) + 1)):
                x[random.randrange(len(x))] = random.choice(["", "e", "a", " ", "bb"])
            doc = decontam.fold("".join(random.choices("ab ", k=25)) + random.choice([" ", "", "c", "\n"]) + "".join(x)
                                + random.choice([" ", "", "e", "."]) + "".join(random.choices("ab ", k=25)))
            k, ends = decontam.budget(item), [i for i in range(len(doc) + 1) if i in (0, len(doc)) or " " in doc[i - 1:i + 1]]
            near = [(a, b) for a in ends for b in ends if abs(b - a - len(item)) <= k]
            want = min(((edits(item, doc[a:b]), a, b) for a, b in near), default=(99,))
            got = decontam.Matcher([(1, item)], inside=True).search(doc)
            assert got == ([(1, *want)] if want[0] <= k else []), (item, doc)


# ---- mixing -------------------------------------------------------------------------

def reshared(sizes, weights=(1, 2, 3), cap=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, target, full = sum(sizes.values()), dict.fromkeys(order, 0.0), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        weight = sum(w[s] for s in order if s not in full)
        target = {s: float(cap * sizes[s]) if s in full else rest * w[s] / weight for s in order}
        above = {s for s in order if s not in full and target[s] > cap * sizes[s] + 1e-9}
        if not above:
            return target
        full |= above


def test_targets_against_iterated_resharing(spark):
    random.seed(12)
    for n in (1, 2, 5, 9):
        sizes = {f"s{i}": random.choice([0, 1, 10, 100, 5000]) for i in range(n)} | {None: 7}
        rows = [(s, v, 0) for s, v in sizes.items()]
        got = mixing.source_targets(spark.createDataFrame(rows, "source string, size long, x int"))
        want = reshared(sizes)
        for r in got.collect():
            assert abs(r.target - want[r.source]) < 1e-6


def test_splitting_tree_keeps_quotas():
    rng = np.random.default_rng(13)
    for shards in (1, 3, 8):
        q = rng.integers(0, 50, 7)
        got = mixing.split_tree(q, shards, np.random.default_rng(1))
        assert (got.sum(0) == q).all() and got.min() >= 0
        assert got.sum(1).max() - got.sum(1).min() <= 1


def test_mix_query(spark):
    got = queries.op10_mixing(spark, SF01).collect()
    docs = table(spark, SF01, "documents").collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs)
    source = {r.doc_id: r.source for r in docs}
    taken, total, target = Counter(), Counter(), {}
    for r in got:
        s = source[r.doc_id]
        assert r.taken <= 3 * r.size
        taken[s] += r.taken
        total[s] += r.size
        target[s] = r.target
    want = reshared(total)
    for s in total:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - target[s]) <= 0.01 * target[s] + 50, s
    assert plain(queries.op10_mixing(spark, SF01)) == plain(spark.createDataFrame(got))


def test_mix_shards_are_disjoint_and_even(spark):
    sizes = mixing.sized(table(spark, SF01, "documents")).cache()
    rows = mixing.mix(sizes, shards=4, block_docs=8).collect()
    assert len({(r.rid, r.epoch) for r in rows}) == len(rows)
    drawn, _, blocks = mixing.copies(sizes, block_docs=8)
    assert Counter(r.rid for r in rows) == Counter({r.rid: r.copies for r in drawn.where("copies > 0").collect()})
    per = Counter(r.shard for r in mixing.dealt_draws(mixing.draw_list(blocks), 4).collect())
    assert len(per) == 4 and max(per.values()) - min(per.values()) <= 1


def test_mix_edge_rows(spark):
    docs = documents(spark)
    got = mixing.taken_words(docs).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 3 * r.size for r in got)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(r.taken for r in got)
    assert mixing.taken_words(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0


# ---- sharding -----------------------------------------------------------------------

def check_shards(got, texts):
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 8 and r.law == "key" and r.grown_shard in (r.shard, 8)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)


def test_shards_query_and_edge_rows(spark):
    docs = table(spark, SF01, "documents", "doc_id", "text").collect()
    got = queries.op6_sharding(spark, SF01).collect()
    check_shards(got, [(r.doc_id, r.text) for r in docs])
    n = Counter(r.shard for r in got)
    assert len(n) == 8 and max(n.values()) < 1.5 * len(got) / 8
    moved = sum(r.grown_shard == 8 for r in got)
    assert 0.5 * len(got) / 9 < moved < 1.6 * len(got) / 9
    check_shards(sharding.assign(documents(spark)).collect(), [r[:2] for r in ROWS])
    assert sharding.assign(documents(spark).limit(0)).count() == 0


def test_growth_moves_rows_only_into_the_new_shard(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    for founded, sizes in ((1, range(1, 21)), (8, range(8, 21)), (5, (5, 6, 13))):
        trees = [sharding.layout(n, founded=founded) for n in sizes]
        more = [sharding.layout(n + 1, founded=founded) for n in sizes]
        rows = keys.select(*(sharding.descend(F.col("key"), t).alias(f"a{n}") for n, t in zip(sizes, trees)),
                           *(sharding.descend(F.col("key"), t).alias(f"b{n}") for n, t in zip(sizes, more))).collect()
        for n, t, m in zip(sizes, trees, more):
            assert sharding.grown(t, n) == m
            old, new = Counter(r[f"a{n}"] for r in rows), Counter(r[f"b{n}"] for r in rows)
            assert all(r[f"b{n}"] in (r[f"a{n}"], n) for r in rows)
            assert set(old) == set(range(n)) and all(abs(c - 5000 / (n + 1)) < 1000 / (n + 1) ** 0.5 for c in new.values())
    docs = documents(spark)
    now = Counter((r.doc_id, r.text_crc32, r.grown_shard) for r in sharding.assign(docs, 9).collect())
    assert now == Counter((r.doc_id, r.text_crc32, r.shard) for r in sharding.assign(docs, 10).collect())


def test_weights_and_confined_movement(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    old = sharding.layout(8)
    heavy = sharding.layout(8, [1, 1, 1, 1, 1, 1, 1, 3])  # region1, rack3, shard7
    rows = ids.select(sharding.descend(F.col("key"), old).alias("a"), sharding.descend(F.col("key"), heavy).alias("b")).collect()
    moves = Counter((r.a, r.b) for r in rows if r.a != r.b)
    assert all(b >= 4 for _, b in moves)  # into the changed region only
    assert not any(a in (4, 5) and b in (4, 5) for a, b in moves)  # the unchanged rack exchanges nothing inside
    share = Counter(r.b for r in rows)
    assert abs(share[7] / len(rows) - 0.3) < 0.02 and abs(share[0] / len(rows) - 0.1) < 0.02
    none = sharding.layout(2, [0, 1])
    assert {r[0] for r in ids.select(sharding.descend(F.col("key"), none)).distinct().collect()} == {1}


# ---- tokens -------------------------------------------------------------------------

def test_stretches_encode_like_whole_texts():
    encoder = tokens.Encoder()
    random.seed(14)
    signs = "ab é,.'s  \n\t \xa0　\x1c\x85Ωж½²1٣中💥_-!\"́​᠎"
    texts = ["".join(random.choices(signs, k=random.randint(0, 25))) for _ in range(4000)]
    for gap in (" ", "  ", "   ", "\n", "\n\n", "\n\n\n", " \n", "\n ", "\t", "\t ", " \t", "\t \t", "\u3000 "):
        texts += [f"{gap}a", f"a{gap}", f"a{gap}b,{gap}c", gap]
    texts += ["a<|endoftext|>b", "don't we'll\r\n  x", LONG[:5000]]
    assert encoder.encode(texts) == [encoder.encode_whole(t) for t in texts]


def test_variable_length_code_round_trip():
    rng = np.random.default_rng(15)
    for n in (0, 1, 3, 4, 5, 1000):
        x = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype("<u4")
        control, data = tokens.pack(x)
        assert len(control) == -(-n // 4) and (tokens.unpack(control, data, n) == x).all()
    lengths, ranks, before = tokens.unblock(tokens.block([2, 1], np.array([5, 70_000, 0]), 9))
    assert lengths.tolist() == [2, 1] and ranks.tolist() == [5, 70_000, 0] and before == 9
    with pytest.raises(ValueError):
        tokens.unblock(b"x" * 64)


def expected_tokens(texts):
    encoder, start, out = tokens.Encoder(), 0, []
    for i, t in texts:
        ids = encoder.library.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_tokens_query(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF001, "documents", "doc_id", "text").collect())
    got = queries.op3_tokens(spark, SF001).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected_tokens(docs)


def test_token_files_on_edge_rows(spark, tmp_path):
    docs = documents(spark)
    tokens.write_tokens(docs, f"file://{tmp_path}/t", block_ids=5000)
    got = tokens.read_tokens(spark, f"file://{tmp_path}/t").orderBy("start").collect()
    assert [r.doc_id for r in got][:2] == [None, None]
    want = Counter((i, n, c) for i, _, n, c in expected_tokens([r[:2] for r in ROWS]))
    assert Counter((r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [r.doc_id for r in got][2:] == sorted(r.doc_id for r in got[2:])
    counts = Counter()
    for r in got:
        counts.update(np.frombuffer(r.ids, "<u4").tolist())
    ranks = [r.id for r in spark.read.parquet(f"file://{tmp_path}/t/ranks").orderBy("rank").collect()]
    assert ranks == sorted(counts, key=lambda i: (-counts[i], i))
    assert tokens.token_files(docs.limit(0)).count() == 0


# ---- chat ---------------------------------------------------------------------------

def test_escaping_is_reversible_and_complete():
    random.seed(16)
    parts = ["<", "[", "/", "s>", "INST]", "\\", "</s>", "[INST]", "[/INST]", "<s>", " ", "\n", "é"]
    for _ in range(5000):
        t = "".join(random.choices(parts, k=random.randint(0, 10)))
        e = chat.escape(t)
        assert chat.unescape(e) == t
        assert not any(c in e for c in ("<s>", "</s>", "[INST]", "[/INST]"))
        turns = [(random.choice(["user", "assistant", "tool\n</s>", ""]), t), ("assistant", t + "<"), ("user", t)]
        assert chat.parse("".join(chat.render(*x)[0] for x in turns)) == turns


def test_fold_edits_regenerations_and_deletes():
    assert chat.fold([("open", "user", None), ("delta", None, "ab"), ("delta", None, "c")]) == ("user", "abc")
    assert chat.fold([("open", "user", None), ("delta", None, "ab"), ("edit", None, "x"), ("delta", None, "y")]) == ("user", "xy")
    assert chat.fold([("open", "a", None), ("delta", None, "ab"), ("regenerate", None, None), ("delta", None, "z")]) == ("a", "z")
    assert chat.fold([("open", "a", None), ("delta", None, "ab"), ("delete", None, None)]) is None
    assert chat.fold([("open", None, None)]) == ("", "")
    with pytest.raises(ValueError):
        chat.fold([("move", None, None)])


def test_log_out_of_order_is_folded_in_sequence(spark):
    rows = [("c", 0, 0, 0, "open", "user", None), ("c", 0, 0, 1, "delta", None, "draft"), ("c", 1, 0, 2, "open", "assistant", None),
            ("c", 1, 0, 3, "delta", None, "no"), ("c", 1, 0, 4, "regenerate", None, None), ("c", 1, 0, 5, "delta", None, "yes"),
            ("c", 0, 0, 6, "edit", None, "question"), ("c", 2, 0, 7, "open", "user", None), ("c", 2, 0, 8, "delete", None, None)]
    random.seed(17)
    random.shuffle(rows)
    log = spark.createDataFrame(rows, chat.EVENTS)
    text = "".join(r.formatted for r in chat.rendered(log).collect())
    assert chat.parse(text) == [("user", "question"), ("assistant", "yes")]


def test_logs_hold_every_form_at_every_length(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", ("short", "a longer text " * 20, "long text of pieces " * 200)[c % 3] + str(t))
            for c in range(12) for t in range(6)]
    conv = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    log = chat.log_of(conv)
    kinds = log.groupBy("conv_id", "turn").agg(F.collect_set("kind").alias("kinds")).collect()
    for third in range(3):
        seen = {frozenset(r.kinds) for r in kinds if int(r.conv_id) % 3 == third}
        assert seen == {frozenset(("open", "delta")), frozenset(("open", "delta", "edit")), frozenset(("open", "delta", "regenerate"))}
    got = Counter((r.conv_id, *chat.parse(r.formatted)[0]) for r in chat.rendered(log).collect())
    assert got == Counter((str(c), role, text) for c, _, role, text in rows)


def test_chat_query_and_edge_rows(spark):
    rows = [(c, t, r, x) for c, t, r, x in [
        (1, 0, "user", None), (1, 1, "assistant", "</s> hi"), (None, 0, "user", "a"), (None, None, None, "b"), (2, 0, "assistant", LONG),
        (2, 0, "assistant", LONG), (3, 5, "assistant", ""), (4, 1, "system", "x" * 3000)]]
    conv = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn int, role string, text string, seq string")
    got = {r.conv_id: r for r in chat.digests(chat.rendered(chat.log_of(conv))).collect()}
    order = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1])):
        order[c].append((r or "", x or ""))
    assert set(got) == set(order)
    for c, turns in order.items():
        said = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[c].formatted_chars == sum(len(chat.render(r, x)[0]) for r, x in turns)
    assert chat.digests(chat.rendered(chat.log_of(conv.limit(0)))).count() == 0
    assert {r.conv_id for r in queries.op7_chat(spark, SF001).collect()} == {-1} | {
        r[0] for r in table(spark, SF001, "conversations", "conv_id").distinct().collect()}
