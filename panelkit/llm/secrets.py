"""Secret scan: fixed patterns plus a linear-chain conditional random field over tokens.

Tokens (stretches without white space) are tagged begin, inside or outside of a secret.  The
score of a tag adds weights of the token's shape, of the neighbouring tokens and of features of
the whole file; tags of neighbours add transition weights; Viterbi finds the best tags.  The
field is fitted on a bounded sample of documents in which the fixed patterns mark the secrets;
it then tags every token of every document and adds the spans the patterns do not cover.

Scores are kept per distinct token, so a text costs a table lookup per token.  A token whose
lead for "outside" exceeds what any neighbouring tags could make up for is outside in the best
tagging whatever the rest, so Viterbi runs on the stretches between such tokens; the result is
that of Viterbi over the whole text.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import cut_lineage

from .common import WORD, kept

#: Documents that the windows for fitting are taken from, about; windows of each sort (with and
#: without a secret), at most.
SAMPLE_DOCS, SAMPLE_WINDOWS = 20_000, 3_000
#: Tokens on either side of a sampled place.
CONTEXT = 8
#: Hashed feature ids.
DIMENSION = 1 << 12
STEPS = 80
RATE, L2 = 0.3, 1e-3
#: Entries of a worker's token cache; a full cache is emptied, which changes no result.
CACHE = 400_000

OUT, BEGIN, INSIDE = 0, 1, 2
KINDS = ("assign", "access", "hex", "crf")
#: Characters of an added span at least, as many as the patterns ask of an assigned value.
LEAST_ADDED = 6
WRAPPING = "\"'`.,;:()[]{}<>*|"

# ---- fixed patterns -----------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24}")
#: A text without any of these has no ``assign`` match.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str, maybe_hex: bool = True) -> list[Span]:
    """Spans of the fixed patterns, sorted."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if maybe_hex and LONG_HEX.search(text):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out)


# ---- features -----------------------------------------------------------------------

KEYWORD = re.compile(r"pass|pwd|secret|token|key|cred|auth|bearer", re.I)


def number(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) % DIMENSION


def entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def shape(token: str) -> str:
    """Classes of characters in order of appearance, runs folded, first eight."""
    folded = re.sub(r"[^\W\d_]+", lambda m: case(m[0]), token)
    folded = re.sub(r"\d+", "0", folded)
    return re.sub(r"((?:Aa|A|a|0){1,3})\1+", r"\1+", folded)[:8]


def case(letters: str) -> str:
    return "a" if letters.islower() else "A" if letters.isupper() else "Aa"


def changes(token: str) -> int:
    """How often the class of character (small, capital, digit, other) changes along a token, up to 15."""
    kinds = re.sub(r"\d", "0", re.sub(r"[^\W\d_]", lambda m: "a" if m[0].islower() else "A", token))
    return min(sum(a != b and (a in "aA0" or b in "aA0") for a, b in zip(kinds, kinds[1:])), 15)


def plain_class(token: str) -> tuple[str, int] | None:
    """Shape and size class of a word of letters, with marks around it; None for any other token.
    Words of one class have the same features."""
    core = token.strip("\"'.,;:=()")
    if not core.isalpha() or KEYWORD.search(core):
        return None
    return token.replace(core, case(core), 1)[:8], min(len(token).bit_length(), 8)


def describe(token: str) -> tuple[list[int], list[int]]:
    """Feature ids of a token for itself and for its neighbours."""
    plain = plain_class(token)
    if plain:
        kind, size = plain
        own = [f"s:{kind}", f"n:{size}", "k:False", "d:0", "e:word", "r:0", "t:0", "u:0",
               f"q:{'=' in token}{':' in token}", "p:word"]
        near = [f"s:{kind[:4]}", "k:False", "w:"]
    else:
        word, kind, key = token.strip("\"'.,;:=()").lower(), shape(token), bool(KEYWORD.search(token))
        digits = sum(c.isdigit() for c in token)
        own = [f"s:{kind}", f"n:{min(len(token).bit_length(), 8)}", f"k:{key}", f"d:{min(digits, 9)}",
               f"e:{int(2 * entropy(token))}", f"r:{int(4 * digits / len(token))}",
               f"t:{changes(token)}", f"u:{int(8 * changes(token) / len(token))}",
               f"q:{'=' in token}{':' in token}", f"p:{token[:4]}"]
        near = [f"s:{kind[:4]}", f"k:{key}", f"w:{word if key else ''}"]
    return [number(f) for f in own], [number(f) for f in near]


def file_features(n_tokens: int, n_digit_tokens: int, n_signs: int) -> list[int]:
    """Feature ids of a whole text: its size, share of tokens with digits, of ``=`` and ``:`` tokens."""
    share = int(10 * n_digit_tokens / max(n_tokens, 1))
    signs = int(10 * n_signs / max(n_tokens, 1))
    return [number(f"file n:{n_tokens.bit_length()}"), number(f"file d:{share}"), number(f"file q:{signs}")]


# ---- the field ----------------------------------------------------------------------

class Field:
    """Weights: ``own``, ``prev``, ``next`` and ``file`` give each tag's score per feature id,
    ``move[a, b]`` scores tag b after tag a."""

    def __init__(self):
        self.own, self.prev, self.next, self.file = (np.zeros((DIMENSION, 3)) for _ in range(4))
        self.move = np.zeros((3, 3))

    def lead(self) -> float:
        """A lead of "outside" that no neighbouring tags can make up for."""
        gain = self.move[:, [BEGIN, INSIDE]] - self.move[:, [OUT]]  # moves into the tag
        back = self.move[[BEGIN, INSIDE]] - self.move[[OUT]]  # moves out of it
        into, out = np.maximum(gain.max(0), 0), np.maximum(back.max(1), 0)  # 0: at an edge of the text
        return float((into + out).max()) + 1e-9


def viterbi(scores: np.ndarray, move: np.ndarray, left: int | None = None, right: int | None = None) -> list[int]:
    """Best tags of a stretch between known tags (None: the text's edge)."""
    best = scores[0] + (move[left] if left is not None else 0)
    back = []
    for row in scores[1:]:
        paths = best[:, None] + move
        back.append(paths.argmax(0))
        best = paths.max(0) + row
    if right is not None:
        best = best + move[:, right]
    tags = [int(best.argmax())]
    for pointers in reversed(back):
        tags.append(int(pointers[tags[-1]]))
    return tags[::-1]


class Tagger:
    """Tags texts, with the scores of each distinct token kept for a while."""

    def __init__(self, field: Field):
        self.field, self.lead = field, field.lead()
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}  # of tokens
        self.classes: dict[tuple, int] = {}  # of plain words
        self.size = 0
        self.table = np.zeros((1024, 9))
        self.flags = np.zeros((1024, 3), bool)  # has a digit, has = or :, holds a long hex run

    def add(self, token: bytes) -> int:
        text, f = token.decode(), self.field
        long_hex = len(token) >= 24 and bool(LONG_HEX.search(text))
        key = plain_class(text)
        key = key and (*key, long_hex)
        if key in self.classes:
            self.rows[token] = self.classes[key]
            return self.rows[token]
        i, self.size = self.size, self.size + 1
        if i == len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
            self.flags = np.vstack([self.flags, np.zeros_like(self.flags)])
        own, near = describe(text)
        # as itself; what it adds to the next token; what it adds to the previous one
        self.table[i] = np.concatenate([f.own[own].sum(0), f.prev[near].sum(0), f.next[near].sum(0)])
        self.flags[i] = any(c.isdigit() for c in text), "=" in text or ":" in text, long_hex
        self.rows[token] = i
        if key:
            self.classes[key] = i
        return i

    def look_up(self, tokens: list[bytes]) -> np.ndarray:
        if len(self.rows) > CACHE:
            self.clear()
        rows = self.rows
        at = [rows.get(t, -1) for t in tokens]
        if -1 in at:
            at = [i if i >= 0 else rows[t] if t in rows else self.add(t) for i, t in zip(at, tokens)]
        return np.array(at)

    def scores(self, tokens: list[bytes]) -> tuple[np.ndarray, bool]:
        """Tag scores of every token; whether some token holds a long hex run."""
        at = self.look_up(tokens)
        table, flags = self.table[at], self.flags[at]
        out = table[:, :3].copy()
        out[1:] += table[:-1, 3:6]
        out[:-1] += table[1:, 6:9]
        seen = flags.sum(0)
        out += self.field.file[file_features(len(tokens), int(seen[0]), int(seen[1]))].sum(0)
        return out, bool(seen[2])

    def tags(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """(first, last + 1) token of every tagged secret."""
        open_ = np.flatnonzero(scores[:, OUT] - scores[:, 1:].max(1) <= self.lead)
        found: list[tuple[int, int]] = []
        n = len(scores)
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1) if len(open_) else ():
            a, b = int(run[0]), int(run[-1]) + 1
            best = viterbi(scores[a:b], self.field.move, OUT if a else None, OUT if b < n else None)
            for i, tag in enumerate(best, a):
                if tag == INSIDE and found and found[-1][1] == i:
                    found[-1] = (found[-1][0], i + 1)
                elif tag != OUT:
                    found.append((i, i + 1))
        return found

    def spans(self, text: str | None) -> list[Span]:
        """All spans of a text, sorted: those of the patterns, and tagged ones that overlap none."""
        text = text or ""
        tokens = text.encode().split()
        if not tokens:
            return base_spans(text)
        scores, maybe_hex = self.scores(tokens)
        base = base_spans(text, maybe_hex)
        tagged = self.tags(scores)
        if not tagged:
            return base
        places = [m.span() for m in re.finditer(WORD, text)]
        extra = []
        for a, b in tagged:
            run: list[int] = []
            for i in range(a, b + 1):  # one beyond the run closes it
                if i < b and all(places[i][1] <= s or places[i][0] >= e for s, _, e in base):
                    run.append(i)
                elif run:
                    start, end = trimmed(text, places[run[0]][0], places[run[-1]][1])
                    if end - start >= LEAST_ADDED:
                        extra.append((start, 3, end))
                    run = []
        return sorted(base + extra)


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the quotes, brackets and marks around it."""
    body = text[start:end]
    left = len(body) - len(body.lstrip(WRAPPING))
    return (start + left, start + len(body.rstrip(WRAPPING))) if left < len(body) else (start, start)


# ---- fitting ------------------------------------------------------------------------

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
SORTS = ("secret", "digits", "plain")
#: Times that each way of disguise is used on a sampled secret, with other letters, words and lengths.
DISGUISED = 4
#: Words about secrets that the patterns do not know; a field feature sees them by ``KEYWORD``.
CUES = ("pwd", "cred", "auth", "bearer", "key", "pass")


def relettered(value: str, h: int, least: int = 16, most: int = 44) -> str:
    """A value of ``least`` to ``most`` - 1 letters and digits in place of ``value``, by its hash."""
    rng = np.random.default_rng([h, xxhash.xxh32_intdigest(value)])
    alphabet = LETTERS[rng.choice([0, 26]):][:62]  # with or without capitals
    return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(least, most)))


def disguises(tokens: list[str], value: str, h: int) -> Iterator[tuple[list[str], list[int]]]:
    """A window's other words (``tokens``, None for the secret) with the secret written as no pattern reads it,
    so that its shape and neighbours have to tell: alone, in other letters and lengths, behind an ordinary word
    and a sign, behind a short prefix, near a word about secrets that the patterns do not know."""
    at = tokens.index(None)
    words = [t for t in tokens if t and t.isalpha()] or ["it"]
    name, cue = words[h % len(words)], CUES[h // 7 % len(CUES)]
    other, short, cut = relettered(value, h), relettered(value, h + 2, 10, 18), value[:10 + h % 10]
    for body in ([value], [other], [f"{name}={other}"], [name + ":", other], [name, "=", other], [f'"{other}"'],
                 [f"{name[:3]}{'_-'[h % 2]}{relettered(value, h + 1)}"], [short], [name + ":", short], [cue, other],
                 [cue + ":", short], [f"{name}_{cue}", "=", short], [cue, name, cut], [cue, name, short]):
        yield tokens[:at] + body + tokens[at + 1:], [0] * at + [0] * (len(body) - 1) + [BEGIN] + [0] * (len(tokens) - at - 1)


def sample_windows(text: str, limit: int = 4) -> list[tuple[str, list[str], list[int], list[int]]]:
    """Windows of (sort, tokens, tags, file features): around the first ``limit`` spans of the patterns, as they are
    and with the keyword masked (``disguises``); or, in a text without any, at a hashed token and at a
    hashed one of the tokens with a digit."""
    places = [m.span() for m in re.finditer(WORD, text)]
    if not places:
        return []
    tokens = [text[a:b] for a, b in places]
    starts = np.array([a for a, _ in places])
    tags = np.zeros(len(tokens), int)
    centres: dict[tuple[int, int], str] = {}
    for start, _, end in base_spans(text):
        a = int(np.searchsorted(starts, start, "right")) - 1
        b = int(np.searchsorted(starts, end, "left"))
        if not tags[a]:
            tags[a] = BEGIN
        tags[a + 1:b] = INSIDE
        if not any(i <= a < j for i, j in centres):  # a value that two patterns read counts once
            centres[a, b] = "secret"
    file = file_features(len(tokens), sum(any(c.isdigit() for c in t) for t in tokens),
                         sum("=" in t or ":" in t for t in tokens))
    h = xxhash.xxh32_intdigest(text)
    if not centres:
        digits = [i for i, t in enumerate(tokens) if any(c.isdigit() for c in t)]
        centres[h % len(tokens), h % len(tokens) + 1] = "plain"
        if digits:
            i = digits[h % len(digits)]
            centres[i, i + 1] = "digits"
    out = []
    for (a, b), sort in [*centres.items()][:limit]:
        low, high = max(0, a - CONTEXT), min(len(tokens), b + CONTEXT)
        out.append((sort, tokens[low:high], tags[low:high].tolist(), file))
        if sort == "secret" and not tags[low:a].any() and not tags[b:high].any():
            value = tokens[b - 1].strip(WRAPPING + "=")
            value = re.split("[=:]", value)[-1].strip(WRAPPING) or value
            hidden = tokens[low:a] + [None] + tokens[b:high]
            out += [(sort, *d, file) for i in range(DISGUISED) for d in disguises(hidden, value, h + 7919 * i)]
    return out


def fit_field(windows: list[tuple[list[str], list[int], list[int]]], steps: int = STEPS) -> Field:
    """Maximum likelihood by full-batch Adagrad; forward and backward sums run over all windows
    of one length at a time."""
    field = Field()
    if not windows:
        return field
    groups: dict[int, list] = {}
    for tokens, tags, file in windows:
        groups.setdefault(len(tokens), []).append((*zip(*map(describe, tokens)), tags, file))
    batches = []
    for n, rows in groups.items():
        own = np.array([r[0] for r in rows])
        near = np.array([r[1] for r in rows])
        batches.append((own, near, np.array([r[2] for r in rows]), np.array([r[3] for r in rows])))
    parts = [field.own, field.prev, field.next, field.file, field.move]
    squares = [np.full_like(p, 1e-6) for p in parts]
    total = len(windows)
    for _ in range(steps):
        grads = [L2 * p for p in parts]
        for own, near, tags, file in batches:
            error, moves = gradient(field, own, near, tags, file)
            error /= total
            for grad, ids, e in ((grads[0], own, error), (grads[1], near[:, :-1], error[:, 1:]),
                                 (grads[2], near[:, 1:], error[:, :-1]), (grads[3], file, error.sum(1))):
                k = ids.shape[-1]
                flat = ids.reshape(-1)
                for y in range(3):
                    grad[:, y] += np.bincount(flat, np.repeat(e[..., y].reshape(-1), k), DIMENSION)
            grads[4] += moves / total
        for p, g, s in zip(parts, grads, squares):
            s += g * g
            p -= RATE * g / np.sqrt(s)
    return field


def gradient(field: Field, own, near, tags, file) -> tuple[np.ndarray, np.ndarray]:
    """Expected minus observed tags (windows x tokens x 3) and moves (3 x 3)."""
    scores = field.own[own].sum(2)
    scores[:, 1:] += field.prev[near[:, :-1]].sum(2)
    scores[:, :-1] += field.next[near[:, 1:]].sum(2)
    scores += field.file[file].sum(1)[:, None]
    n = scores.shape[1]
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for i in range(1, n):
        ahead[:, i] = scores[:, i] + log_sum(ahead[:, i - 1, :, None] + field.move, 1)
    for i in range(n - 2, -1, -1):
        behind[:, i] = log_sum(field.move[None] + (scores[:, i + 1] + behind[:, i + 1])[:, None, :], 2)
    z = log_sum(ahead[:, -1], 1)
    error = np.exp(ahead + behind - z[:, None, None])
    moves = np.zeros((3, 3))
    for i in range(1, n):
        both = ahead[:, i - 1, :, None] + field.move + (scores[:, i] + behind[:, i])[:, None, :]
        moves += np.exp(both - z[:, None, None]).sum(0)
        np.add.at(moves, (tags[:, i - 1], tags[:, i]), -1.0)
    error -= np.eye(3)[tags]
    return error, moves


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows_: int = SAMPLE_WINDOWS) -> Field:
    """The field fitted on a hashed share of about ``sample_docs`` documents (all, if there are
    fewer), of these on at most 4 windows of a text and ``sample_windows_`` windows of each sort
    (around a secret, around a token with a digit, around any token); only windows reach the driver."""
    known = docs.where("text IS NOT NULL")
    share = min(1.0, sample_docs / max(known.count(), 1))
    h = F.xxhash64("doc_id", "text")
    chosen = known.select("text", h.alias("h")).where(
        F.pmod("h", F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20))))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(h, *w) for h, text in zip(pdf["h"], pdf["text"]) for w in sample_windows(text)]
            yield pd.DataFrame(rows, columns=["h", "sort", "tokens", "tags", "file"])

    cut = cut_lineage(chosen.mapInPandas(
        windows, "h long, sort string, tokens array<string>, tags array<int>, file array<int>"))
    found = []
    for sort in SORTS:
        found += cut.where(F.col("sort") == sort).orderBy("h", "tokens").limit(sample_windows_).collect()
    return fit_field([(list(r.tokens), list(r.tags), list(r.file)) for r in found])


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id and ``spans`` (array of kind, start, end in code points, by start and kind) of every
    row of ``docs``.

    NULL and empty texts have no spans; NULL doc_ids and repeated rows are carried as they are;
    other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(docs))
    fitted = uuid.uuid4().hex

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = kept(("tagger", fitted), lambda: Tagger(shared.value))
        for texts in batches:
            yield pd.Series([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in tagger.spans(t)]
                             for t in texts], dtype=object)

    return docs.select("doc_id", spans(F.col("text")).alias("spans"))
