"""Quality, secrets, personal data and toxicity against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF001, SF01
from edge import ROWS, documents
from panelkit.llm import privacy, quality, queries, secrets, toxicity
from panelkit.llm.common import table

WORD = r"[^\x20\x09-\x0D]+"


def test_quality_measures_against_brute_force(spark):
    def brute(text):
        text = text or ""
        words = re.findall(WORD, text)
        at = defaultdict(list)
        for i in range(len(words) - 4):
            at[tuple(words[i:i + 5])].append(i)
        covered = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                len(lines) - len(set(lines)), len(covered))

    random.seed(4)
    texts = [r[1] for r in ROWS if r[1] is None or len(r[1]) < 100_000]
    texts += ["".join(random.choices(["a", "b", " ", "\n", "#", "é", " "], k=random.randint(0, 120))) for _ in range(300)]
    for t in texts:
        assert quality.measure(t)[:5] == brute(t)


def test_ablations_of_the_query_against_brute_force(spark, tmp_path):
    random.seed(5)
    texts = [r[1] for r in ROWS] + [" ".join(random.choices(["ab", "#$", "XY", "x" * 90, "long"], k=random.randint(0, 40))) for _ in range(200)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    got = queries.op1_quality(spark, str(tmp_path)).collect()
    mask = quality.POLICIES[quality.CURRENT]
    assert len(got) == len(texts) and len({r.failed for r in got}) > 5
    for r in got:
        assert r.kept_without == sum(not o.failed & mask & ~r.failed for o in got)
    empty = quality.with_ablation(quality.ledger(documents(spark).limit(0)))
    assert empty.count() == 0


def test_quality_on_edge_rows_and_empty(spark):
    docs = documents(spark)
    got = quality.apply_policy(quality.ledger(docs)).collect()
    assert len(got) == len(ROWS)
    assert [r.kept for r in got if r.doc_id == 3] == [False]
    assert quality.ledger(docs.limit(0)).count() == 0


def test_policies_and_ablations(spark):
    rows = spark.createDataFrame([(i, b) for i, b in enumerate([0, 0, 1, 2, 3, 4, 6])], "doc_id long, failed long")
    got = {(r.policy, r.rule): tuple(r)[2:] for r in quality.ablations(rows, {"p": 3, "q": 4}).collect()}
    assert got == {("p", "too_few_words"): (7, 4, 2, 1), ("p", "repeated_words"): (7, 4, 3, 2), ("q", "symbols"): (7, 2, 2, 2)}
    one = quality.profile(rows).first()
    assert (one.n_docs, one.any_failed, one.all_failed) == (7, 7, 0)
    with_policy = quality.apply_policy(rows, "base")
    assert sorted(r.doc_id for r in with_policy.where("kept").collect()) == [0, 1, 5]


def test_quality_keeps_good_documents(spark):
    rows = queries.op1_quality(spark, SF01).join(table(spark, SF01, "labels"), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n[1, True] >= 0.97 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] >= 0.8 * (n[0, False] + n.get((0, True), 0))


# ---- secrets ------------------------------------------------------------------------

def naive_secrets(text):
    text = text or ""
    out = []
    assign = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_secrets_against_brute_force():
    random.seed(5)
    parts = ["password", "API_KEY", "tokEn", "ſecret", "=", ": ", '"', "'", " ", "abc123", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef",
             "0123456789abcdefabcdef01", "\n", "é", "x"]
    for _ in range(3000):
        t = "".join(random.choices(parts, k=random.randint(0, 12)))
        assert secrets.base_spans(t) == naive_secrets(t), t


def test_pruned_viterbi_equals_full():
    rng = np.random.default_rng(6)
    for _ in range(300):
        field = secrets.Field()
        field.move = rng.normal(0, 1, (3, 3))
        scores = rng.normal(0, 3, (rng.integers(1, 30), 3)) + [2, 0, 0]
        tags = secrets.viterbi(scores, field.move)
        best = max(itertools.product(range(3), repeat=len(scores)), key=lambda y: sum(s[a] for s, a in zip(scores, y)) + sum(
            field.move[a, b] for a, b in zip(y, y[1:]))) if len(scores) < 7 else tuple(tags)
        assert tuple(tags) == best
        spans, i = [], 0
        for i, tag in enumerate(tags):
            if tag == secrets.INSIDE and spans and spans[-1][1] == i:
                spans[-1] = (spans[-1][0], i + 1)
            elif tag:
                spans.append((i, i + 1))
        assert secrets.Tagger(field).tags(scores) == spans


def test_field_learns_and_scan_keeps_base_spans(spark):
    docs = table(spark, SF01, "documents", "doc_id", "text")
    field = secrets.fit(docs)
    got = {r.doc_id: r.spans for r in secrets.scan(docs, field).collect()}
    extra = 0
    for r in docs.collect():
        base = [(s.start, secrets.KINDS.index(s.kind), s.end) for s in got[r.doc_id] if s.kind != "crf"]
        assert base == naive_secrets(r.text)
        extra += sum(s.kind == "crf" for s in got[r.doc_id])
    assert extra <= 0.02 * len(got)
    tagger = secrets.Tagger(field)
    text = "ener tion erly the password=9f8e7d6c5b4a3f2e1d and then of the"
    tokens = text.encode().split()
    assert tagger.tags(tagger.scores(tokens)[0]) == [(4, 5)]


def test_field_finds_secrets_that_no_pattern_reads(spark):
    """320 secrets of eight kinds in clean texts; the field is fitted on documents that hold none of these kinds."""
    field = secrets.fit(table(spark, SF01, "documents", "doc_id", "text"))
    tagger = secrets.Tagger(field)
    rng = random.Random(3)
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda n, letters=base62: "".join(rng.choices(letters, k=n))
    kinds = [lambda: ("ghp_", some(36)), lambda: ("Bearer ", f"eyJ{some(30)}.{some(20)}"), lambda: ("pwd: ", some(14)),
             lambda: ("auth=", some(24)), lambda: ("sk-proj-", some(32)), lambda: ("password is ", some(16, "0123456789abcdef")),
             lambda: ("client_key = ", some(14)), lambda: ("xoxb-", f"{some(11, base62[52:])}-{some(24)}")]
    prose = [r.text for r in table(spark, SF001, "documents").orderBy("doc_id").collect()
             if r.text and len(r.text.split()) > 60 and not secrets.base_spans(r.text)]
    found, added, wrong = [0] * 8, 0, 0
    for i in range(320):
        words = rng.choice(prose).split(" ")
        at = rng.randrange(10, len(words) - 10)
        lead, value = kinds[i % 8]()
        text = " ".join([*words[:at], lead + value, *words[at:]])
        start = text.index(lead + value) + len(lead)
        spans = [(a, b) for a, k, b in tagger.spans(text) if k == 3]
        found[i % 8] += any(a <= start and b >= start + len(value) for a, b in spans)
        added += len(spans)
        wrong += sum(b <= start - len(lead) or a >= start + len(value) for a, b in spans)
    assert sum(found) >= 0.9 * 320 and min(found) >= 0.75 * 40, found
    assert wrong <= 0.05 * added, (wrong, added)


def test_tagged_runs_keep_what_no_pattern_covers():
    """Tokens of a run outside the patterns' spans stay; marks around a span and lone signs do not."""
    field = secrets.Field()
    field.move[:] = 1.0
    tagger = secrets.Tagger(field)
    tagger.tags = lambda scores: [(1, 3)]
    text = 'x password=abcdef0123 "Zx81kPq02LmN44", = y'
    spans = tagger.spans(text)
    assert [(k, text[a:b]) for a, k, b in spans] == [(0, "password=abcdef0123"), (3, "Zx81kPq02LmN44")]
    tagger.tags = lambda scores: [(3, 4)]
    assert [k for _, k, _ in tagger.spans(text)] == [0]


def test_secrets_on_edge_rows(spark):
    docs = documents(spark)
    got = secrets.scan(docs, secrets.Field()).collect()
    want = Counter((r[0], tuple(naive_secrets(r[1]))) for r in ROWS)
    assert Counter((r.doc_id, tuple((s.start, secrets.KINDS.index(s.kind), s.end) for s in r.spans if s.kind != "crf")) for r in got) == want
    assert secrets.scan(docs.limit(0)).count() == 0


# ---- personal data ------------------------------------------------------------------

def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def naive_private(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p[-400:]) <= 255 and int(p[:-400] or 0) == 0 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def test_private_spans_against_brute_force(spark):
    random.seed(7)
    parts = ["a.b", "@", "x-y.com", ".", "10.0.0.1", "256.1.1.1", "007", "+1", "(555) ", "123-4567", "4111 1111 1111 1111", " ", "é", "\n", "-", "5", "9%"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(1500)]
    texts += [r[1] for r in ROWS if r[1] is None or "x" * 100 not in r[1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in privacy.base_spans(docs).collect():
        assert [(s.start, s["rank"], s.end) for s in r.spans] == naive_private(texts[r.doc_id]), texts[r.doc_id]


def test_private_query_on_edge_rows(spark):
    docs = documents(spark)
    got = queries.span_digests(privacy.sanitise(docs), ("email", "ip", "card", "phone")).collect()
    small = [r for r in ROWS if r[0] not in (5, 6)]
    want = Counter((r[0], digest(naive_private(r[1]), privacy.KINDS)) for r in small)
    assert Counter((r.doc_id, r.base_sha256) for r in got if r.doc_id not in (5, 6)) == want
    assert len(got) == len(ROWS)
    assert privacy.sanitise(docs.limit(0)).count() == 0


def test_disclosing_terms_are_found_and_copies_prove_nothing(spark):
    fill = [f"{a}{b}" for a in ("al", "be", "ga", "de", "om", "si") for b in ("pha", "ta", "mma", "ga")]
    rows = [f"{fill[4 * i]} {fill[4 * i + 1]} Zorblat {fill[4 * i + 2]} ann@x.org {fill[4 * i + 3]}" for i in range(5)]
    rows += ["same words Quibble same bob@y.org same words"] * 6
    rows += [f"near copies show {w} Quabble today eve@z.org near copies show" for w in fill[:8]]
    rows += [f"one two writes {w} same words" for w in fill * 3] + ["a late Zorblat alone"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in privacy.sanitise(docs).collect()}
    terms = {r.doc_id: [s.value for s in got[r.doc_id].spans if s.kind == "term"] for r in got.values()}
    assert all(terms[i] == ["Zorblat"] for i in range(5)) and terms[len(rows) - 1] == ["Zorblat"]
    assert not any(terms[i] for i in range(5, len(rows) - 1))
    assert got[0].clean == "alpha alta <term> almma  alga"


def naive_clean(text, spans, actions):
    at, out = 0, ""
    for s, action in zip(spans, actions):
        out += text[at:s.start] if s.start >= at else ""
        out += f"<{s.kind}>" if action == "generalise" else ""
        at = max(at, s.end)
    return out + text[at:]


def test_both_actions_reach_the_query_and_overlaps_are_whole(spark, tmp_path):
    random.seed(23)
    words = ["".join(p) for p in itertools.product("bdgklmn", "aeiou", "rstvz")]

    def some(n):
        return " ".join(random.sample(words, n))

    rows = [f"{some(6)} Zorblat {some(6)} ann@x.org +14111 1111 1111 1111 {some(3)}" for _ in range(20)]  # phone over card
    rows += [f"{some(6)} Quibble {some(6)} bob@x.org quibble.zorblat@x.org Zorblat" for _ in range(20)]
    rows += [f"{some(6)} Quibble" for _ in range(4)] + [f"{some(8)}" for _ in range(400)] + [None, "", "é" * 5000 + " ann@x.org 😀 tail"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in privacy.sanitise(docs, generalise_at=0.5, remove_at=0.97).collect()}
    assert len(got) == len(rows) and {a for r in got.values() for a in r.actions} == {"remove", "generalise"}
    for r in got.values():
        text = rows[r.doc_id] or ""
        assert r.clean == naive_clean(text, r.spans, r.actions)
        base = [(s.start, s.end) for s in r.spans if s.kind != "term"]
        hidden = [m.span() for m in re.finditer(r"(?i)\b(?:zorblat|quibble)\b", text)]
        free = [x for x in hidden if all(x[1] <= s or e <= x[0] for s, e in base)]
        assert [(s.start, s.end) for s in r.spans if s.kind == "term" and s.value.lower() in ("zorblat", "quibble")] == free
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op5_privacy(spark, str(tmp_path)).collect():
        assert r.n_generalised + r.n_removed == len([x for x in r.spans.split(",") if x])


def test_a_text_with_very_many_matches_takes_linear_time(spark):
    import time

    text = "".join(f"u{i}@ab.org, " for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "one@ab.org")], "doc_id long, text string").repartition(1)
    privacy.base_spans(docs.limit(0)).collect()
    start = time.monotonic()
    got = privacy.base_spans(docs).selectExpr("doc_id", "size(spans) n", "spans[size(spans) - 1].end e", "clean").collect()
    took = time.monotonic() - start
    assert {(r.doc_id, r.n, r.e) for r in got} == {(1, 100_000, len(text) - 2), (2, 1, 10)}
    assert next(r.clean for r in got if r.doc_id == 1) == ", " * 100_000
    assert took < 15, took


def private_terms(spark, rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return {s.value for r in privacy.sanitise(docs).collect() for s in r.spans if s.kind == "term"}


def test_more_evidence_and_copies_hide_no_term(spark):
    random.seed(17)
    words = ["".join(p) for p in itertools.product("bdgklmn", "aeiou", "rstvz")]

    def mail(term, name):
        w = random.sample(words, 8)
        return f"{' '.join(w[:4])} {term} {name}@x.org {' '.join(w[4:])}"

    rows = [mail("Zorblat", "ann") for _ in range(400)]
    rows += [mail("Quibble", "bob") for _ in range(50)]
    rows += [f"near copies show {w} Quibble bob@x.org near copies show again" for w in words[:100]]
    rows += [f"other copies tell {w} Snoffle eve@x.org other copies tell again" for w in words]
    rows += [" ".join(random.sample(words, 5)) for _ in range(600)]
    assert private_terms(spark, rows) == {"Zorblat", "Quibble"}


def test_terms_far_from_the_entity_and_many_mentions(spark):
    random.seed(20)
    words = ["".join(p) for p in itertools.product("bdgklmn", "aeiou", "rstvz")]

    def some(n):
        return " ".join(random.sample(words, n))

    rows = [f"Zorblat {some(20)} signed by the usual office at ann@x.org" for _ in range(5)]
    rows += [" ".join(f"{some(6)} Quibble bob@x.org {some(6)}." for _ in range(20))] + [f"{some(9)} bob@x.org" for _ in range(9)]
    rows += [f"Quibble {some(9)}" for _ in range(4)] + [f"{some(9)} signed by the usual office at" for _ in range(80)]
    assert private_terms(spark, rows) == {"Zorblat"}


# ---- toxicity -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, "the idiot is a clown and a moron said stupid things to little boot books ") for i in range(20)],
                                 "doc_id long, text string")
    return toxicity.log_model(toxicity.trigram_counts(docs))


@pytest.mark.parametrize("hidden,word", [("1d10t", "idiot"), ("i d i o t", "idiot"), ("idiooooot", "idiot"),
                                         ("$tup1d", "stupid"), ("m-o-r-o-n", "moron"), ("CL0WN", "clown"), ("the books", "the books")])
def test_restoration(model, hidden, word):
    assert toxicity.restore(hidden, model) == word


@pytest.mark.parametrize("hidden,word", [
    ("1 d 1 0 t", "idiot"), ("i d 1 o t", "idiot"), ("m-0-r-0-n", "moron"), ("$ t u p 1 d", "stupid"), ("i d i o t !", "idiot !"),
    ("(1d10t)", "idiot"), ("[1d10t]", "idiot"), ("*1d10t*", "idiot"), ("\u201c1d10t\u201d,", "idiot"), ("(1d10t", "idiot"),
    ("1d10t-like", "idiot like"), ("moron/1d10t", "moron idiot"), ("(idiooot)", "idiot"), ("idiooot-like", "idiot like"),
    ("(l0wn", "clown"), ("1 0 4 5 7", "1 0 4 5 7"), ("10-4-0-1-3", "10-4-0-1-3"), ("don't", "don't"), ("well-known (f)", "well-known (f)")])
def test_restoration_of_mixed_and_wrapped_words(model, hidden, word):
    assert toxicity.restore(hidden, model) == word


def test_long_spaced_passages_take_linear_time(model):
    import time

    def decoded(n):
        letters = "".join(random.Random(n).choices("abcdeinorst", k=n))
        start = time.process_time()
        out = toxicity.viterbi(toxicity.lattice(" ".join(letters), True), model)
        assert out.replace(" ", "") == letters
        return time.process_time() - start

    decoded(1_000)
    assert decoded(160_000) < 8 * decoded(40_000) + 1


def test_viterbi_against_enumeration(model):
    random.seed(8)
    for _ in range(60):
        steps = toxicity.lattice("".join(random.choices("1de30too$$", k=random.randint(1, 6))), False)

        def cost(path):
            x = y = 0
            total = sum(c for _, c in path)
            for s in toxicity.symbols("".join(t for t, _ in path) + " "):
                total += float(model[x, y, s])
                x, y = y, int(s)
            return total

        best = min(cost(p) for p in itertools.product(*steps))
        found = toxicity.viterbi(steps, model)
        assert any(abs(cost(p) - best) < 1e-4 and "".join(t for t, _ in p).strip() == found for p in itertools.product(*steps))


def test_held_out_accuracy_and_labels_unseen(spark):
    rows = queries.op2_toxicity(spark, SF01).join(table(spark, SF01, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    clean = [r for r in held if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted == r.toxic for r in held) >= 0.93 * len(held)


def test_toxicity_edge_rows(spark):
    docs, labels = documents(spark), spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.scores(docs.select("doc_id", "text"), labels).collect()
    assert len(got) == len(ROWS) and len({r.score for r in got}) == 1
    assert toxicity.scores(docs.select("doc_id", "text").limit(0), labels).count() == 0
    some = spark.createDataFrame([(1, 1), (1, None), (None, 1), (2, 0), (9, 0)], "doc_id long, toxic int")
    assert toxicity.scores(docs.select("doc_id", "text"), some).count() == len(ROWS)


@pytest.mark.parametrize("share", [0.4, 0.7, 0.9])
def test_mostly_toxic_labels_still_teach(spark, share):
    random.seed(19)
    words = ["".join(p) for p in itertools.product("bdgklmn", "aeiou", "rstvz", "aeiou")]
    rows = [(i, i < 1000 * share, random.sample(words, 12)) for i in range(1000)]
    rows = [(i, int(y), " ".join(w + [random.choice(["idiot", "moron", "clown"])] * y)) for i, y, w in rows]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, y, _ in rows], "doc_id long, toxic int")
    toxic = {i: y for i, y, _ in rows}
    got = toxicity.scores(docs, labels).where(toxicity.held_out()).collect()
    assert sum(r.predicted == toxic[r.doc_id] for r in got) >= 0.95 * len(got)
