"""Toxicity with noisy-channel deobfuscation.

Writers hide words by look-alike symbols (``1d10t``), spacing (``i d i o t``) and repetition
(``idiooot``).  Each such passage is a lattice of characters: every observed symbol may stand
for one of a few letters, separators inside a spaced-out run (of letters and look-alikes) may be dropped or kept, a run of
three or more equal letters may stand for one or two.  Tokens are cut at brackets, quotes, hyphens
and slashes first, and each part has its own lattice.  A character trigram model counted over
ALL documents weighs the paths and Viterbi takes the best.  Text without such passages has a
single path and is left as it is.  Restored words, and their beginnings (which catch inflected
forms that no label shows), then feed a sparse logistic model learned from the labels.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

#: Labelled training rows the classifier is fitted on, at most (smallest hash of the id first).
TRAIN_ROWS = 20_000
#: Candidate features of the model: those with the strongest association to the label.
FEATURES = 1_024
#: Distinct documents a candidate feature has to occur in.
MIN_DOCS = 4
#: Lengths of the word beginnings used as features besides whole words.
STEMS = (4, 5, 6)
L1 = 4.0
PRIOR_SCORE = 0.05
#: Entries of a worker's word cache; a full cache is emptied, which changes no result.
CACHE = 400_000

# Look-alike symbols and the letters they may stand for.
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
SEPARATORS = " .*_-"

#: Channel costs (negative log probabilities).
SUBSTITUTED, DROPPED, COLLAPSED, KEPT_SYMBOL = 1.0, 0.5, 0.7, 6.0
#: Cost of reading a "(" that begins a passage as a bracket.
BRACKET = 2.0

# ---- character language model -------------------------------------------------------

#: 0 boundary or space, 1-26 a-z, 27-59 Latin-1 small letters, 60 any other letter, 61 the rest.
SYMBOLS = 62


def symbol_table() -> np.ndarray:
    table = np.full(257, 61, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 0
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    table[0xDF:0x100] = np.arange(27, 60)
    table[256] = 60
    return table


TABLE = symbol_table()
SYMBOL = TABLE.tolist()


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return TABLE[np.minimum(points, 256)]


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all character trigrams of all texts; at most SYMBOLS**3 rows reach the driver."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for pdf in batches:
            s = symbols("  ".join(t.lower() for t in pdf["text"] if t)).astype(np.int32)
            for i in range(0, max(len(s) - 2, 0), 1 << 22):
                part = s[i:i + (1 << 22) + 2]
                total += np.bincount((part[:-2] * SYMBOLS + part[1:-1]) * SYMBOLS + part[2:],
                                     minlength=SYMBOLS ** 3)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"code": seen.astype(np.int32), "n": total[seen]})

    rows = (docs.select("text").mapInPandas(count, "code int, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(SYMBOLS ** 3, np.int64)
    counts[rows["code"].to_numpy(int)] = rows["n"].to_numpy(np.int64)
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def log_model(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b): trigram, bigram and single counts interpolated."""
    tri = counts / np.maximum(counts.sum(2, keepdims=True), 1)
    two = counts.sum(0)
    bi = two / np.maximum(two.sum(1, keepdims=True), 1)
    one = counts.sum((0, 1)) + 1.0
    return -np.log(0.6 * tri + 0.3 * bi[None] + 0.1 * (one / one.sum())).astype(np.float32)


# ---- lattice and Viterbi ------------------------------------------------------------

RUN = re.compile(r"(.)\1\1")
#: Single letters and look-alikes with a separator between them; punctuation that may as well be
#: meant as such ends no run, and what may be a bracket or a sign begins none.
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_]|[013457890@$!€])(?:[ .*_-](?:[^\W\d_]|[013457890@$!|+(€])){2,}"
                    r"[ .*_-](?:[^\W\d_]|[013457890@$€])(?!\w)")
LEET = re.compile(r"[013457890@$!|+(€]")
LEET_WORD = re.compile(r"[^\W_@$!|+(€]*(?:[@$!|+(€][^\W_@$!|+(€]*)*")
LETTER = re.compile(r"[^\W\d_]")
#: Brackets, quotes, hyphens, slashes and marks of emphasis, at which tokens are cut; a "(" only
#: if the token closes it, else it may stand for a letter.
CUT = re.compile("[\\[\\]{}<>)\"'`´*_~/\\\\\u00ab\u00bb\u2010-\u201f\u2039\u203a\u300c-\u300f-]+")
PAIR = re.compile(r"\(([^()]*)\)")
#: Lower-case hexadecimal strings are keys and digests, not words.
DIGEST = re.compile(r"[0-9a-f]{8,}$")


def lattice(passage: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """For each run of equal observed characters its readings and their costs."""
    out = []
    for m in re.finditer(r"(.)\1*", passage, re.S):
        c, n = m[1], len(m[0])
        if spaced and c in SEPARATORS:
            out.append([("", DROPPED), (" ", KEPT_SYMBOL)])
        elif c in LOOKALIKE:
            readings = [(x * k, SUBSTITUTED + (k != n) * COLLAPSED) for x in LOOKALIKE[c]
                        for k in {n, min(n, 2), 1}]
            if c == "(" and not out:
                readings.append(("", BRACKET))
            out.append([*readings, (c * n, KEPT_SYMBOL)])
        elif n >= 3 and c.isalpha():
            out.append([(c * k, COLLAPSED) for k in (1, 2)])
        else:
            out.append([(c * n, 0.0)])
    return out


def viterbi(steps: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The cheapest reading of a lattice under channel and trigram model, from boundary to boundary; of
    equal ones the first in the order of the readings.  Paths are back-pointers, shared as far as they agree."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for readings in [*steps, [(" ", 0.0)]]:
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            for reading, channel in readings:
                x, y, total = a, b, cost + channel
                for c in reading:
                    s = SYMBOL[min(ord(c), 256)]
                    total += float(model[x, y, s])
                    x, y = y, s
                got = new.get((x, y))
                if got is None or total < got[0]:
                    new[x, y] = (total, (path, reading))
        states = new
    path, out = min(states.values(), key=lambda state: state[0])[1], []
    while path:
        path, reading = path
        out.append(reading)
    return "".join(reversed(out)).strip()


def unspaced(text: str, model: np.ndarray) -> str:
    """The text with its spaced-out runs decoded; runs of digits and signs alone stay."""
    return SPACED.sub(lambda m: viterbi(lattice(m[0], True), model)
                      if len(set(m[0])) > 3 and LETTER.search(m[0]) else m[0], text)


def restore(text: str, model: np.ndarray) -> str:
    """The lower-cased text with its obfuscated passages decoded."""
    return " ".join(restore_word(w, model) for w in unspaced(text.lower(), model).split())


def restore_word(word: str, model: np.ndarray) -> str:
    core = word.strip(".,;:?\"'")
    if core.isalpha():
        return restore_part(core, model)
    parts = [p for p in (x.strip(".,;:?") for x in CUT.split(PAIR.sub(r"[\1]", core))) if p]
    plain = [restore_part(p, model) for p in parts]
    return " ".join(plain) if plain != parts else word


def restore_part(part: str, model: np.ndarray) -> str:
    if part.isalpha():
        return viterbi(lattice(part, False), model) if RUN.search(part) else part
    if (LEET.search(part) and LETTER.search(part) and LEET_WORD.fullmatch(part)
            and not DIGEST.match(part)):
        return viterbi(lattice(part, False), model)
    return part


LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:k]}" for k in STEMS if len(word) > k)]


class Reader:
    """Features of texts, with the features of each word kept for a while."""

    def __init__(self, model: np.ndarray, wanted: dict[str, int] | None = None):
        self.model, self.wanted, self.cache = model, wanted, {}

    def word(self, token: str) -> tuple:
        plain = restore_word(token, self.model)
        found = [f for w in ([plain] if plain.isalpha() else LETTERS.findall(plain)) for f in features_of(w)]
        if self.wanted is not None:
            return tuple([self.wanted[f] for f in found if f in self.wanted])
        return tuple(found)

    def features(self, text: str | None) -> set:
        """Distinct features of a text (numbers, if a vocabulary is wanted)."""
        text = unspaced((text or "").lower(), self.model)
        out: set = set()
        cache = self.cache
        for token in set(text.split()):
            got = cache.get(token)
            if got is None:
                if len(cache) >= CACHE:
                    cache.clear()
                got = cache[token] = self.word(token)
            if got:
                out.update(got)
        return out


# ---- classifier ---------------------------------------------------------------------

def held_out() -> F.Column:
    """Rows whose labels are never learned from; a NULL id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, y) of at most ``rows`` labelled rows that are not held out."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "y")


def candidate_features(train: DataFrame, lm, limit: int = FEATURES) -> list[str]:
    """The features most associated with the label (log-likelihood ratio) over the
    distinct texts of the training rows."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, n, ones = Reader(lm.value), Counter(), Counter()
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["y"]):
                found = reader.features(text)
                n.update(found)
                if y:
                    ones.update(found)
            if len(n) > 500_000:
                yield pd.DataFrame({"f": list(n), "n": list(n.values()), "k": [ones[f] for f in n]})
                n, ones = Counter(), Counter()
        yield pd.DataFrame({"f": list(n), "n": list(n.values()), "k": [ones[f] for f in n]})

    once = train.groupBy(F.xxhash64("text").alias("h")).agg(F.any_value("text").alias("text"), F.max("y").alias("y"))
    size = once.agg(F.count(F.lit(1)).alias("N"), F.coalesce(F.sum("y"), F.lit(0)).alias("K")).first()
    if not size.K or size.K == size.N:
        return []
    counts = (once.select("text", "y").mapInPandas(count, "f string, n long, k long")
              .groupBy("f").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).where(F.col("n") >= MIN_DOCS))
    rate = size.K / size.N
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    gain = (F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0.0)
            + F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - rate)))).otherwise(0.0))
    top = counts.where(k / n > rate).orderBy(gain.desc(), "f").limit(limit)
    return [r.f for r in top.collect()]


def logistic_l1(x: np.ndarray, y: np.ndarray, l1: float = L1, steps: int = 300) -> np.ndarray:
    """Weights (last: intercept) of a non-negative sparse logistic model, by accelerated
    proximal gradient; the intercept bears no penalty."""
    n, m = x.shape
    w, z, t = np.zeros(m + 1), np.zeros(m + 1), 1.0
    w[m] = z[m] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    lip = 0.25 * max(1.0, power_norm(x)) + 0.25 * n ** 0.5
    for _ in range(steps):
        p = 1 / (1 + np.exp(-((x @ z[:m].astype(np.float32)).astype(float) + z[m])))
        g = np.append(x.T @ (p - y).astype(np.float32), 0.0)
        new = z - g / lip
        new[:m] = np.maximum(new[:m] - l1 / lip, 0)
        # the intercept's own Newton step
        new[m] = z[m] - (p - y).sum() / max((p * (1 - p)).sum(), 1.0) * 0.5
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t_new * (new - w)
        z[m], w, t = new[m], new, t_new
    return w


def power_norm(x: np.ndarray, steps: int = 20) -> float:
    """The largest eigenvalue of x'x."""
    v = np.ones(x.shape[1], np.float32)
    top = 1.0
    for _ in range(steps):
        v = x.T @ (x @ v)
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    return top


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, dict[str, int], np.ndarray]:
    """(character model, feature numbers, weights with the intercept last)."""
    spark = docs.sparkSession
    model = log_model(trigram_counts(docs))
    lm = spark.sparkContext.broadcast(model)
    train = training_rows(docs, labels, rows)
    names = candidate_features(train, lm)
    if not names:
        return model, {}, np.array([np.log(PRIOR_SCORE / (1 - PRIOR_SCORE))])
    wanted = {f: i for i, f in enumerate(names)}

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lm.value, wanted)
        for pdf in batches:
            yield pd.DataFrame({"f": [sorted(reader.features(t)) for t in pdf["text"]], "y": pdf["y"]})

    rows_ = train.mapInPandas(present, "f array<int>, y int").groupBy("f", "y").count().collect()
    # texts with equal features count once (copies must not outvote the rest), but those
    # without any feature, whose texts differ, count in full
    hits = [r for r in rows_ if r.f]
    y = np.array([r.y for r in hits] + [r.y for r in rows_ if not r.f for _ in range(r["count"])], float)
    x = np.zeros((len(y), len(names)), np.float32)
    for i, r in enumerate(hits):
        x[i, r.f] = 1
    return model, wanted, logistic_l1(x, y)


def scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` appended."""
    model, wanted, weights = fit(docs, labels, rows)
    used = {f: i for f, i in wanted.items() if weights[i] > 0}
    shared = docs.sparkSession.sparkContext.broadcast((model, used, weights))
    fitted = uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, used, weights = shared.value
        reader = kept(("reader", fitted), lambda: Reader(model, used))
        for texts in batches:
            total = np.array([weights[list(reader.features(t))].sum() for t in texts], float) + weights[-1]
            yield pd.Series(1 / (1 + np.exp(-total)))

    return docs.withColumn("score", score(F.col("text"))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
