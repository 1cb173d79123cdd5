"""Chat formatting by event-sourced reconstruction.

A log holds one row per event of a message: ``open`` (role), ``delta`` (a streamed piece),
``edit`` (the whole text anew), ``regenerate`` (drop what was streamed) and ``delete``.  Logs are
partitioned by conversation and sorted by message and sequence number, and each partition is
folded as a stream: only the message at hand is in memory, so a conversation of any length
passes through.  (Events name their message, hence folding message by message gives what
folding in sequence order gives.)

Final messages are rendered one row per turn; the turns of a conversation joined in order are
its formatted text.  Control strings inside texts are broken by a backslash that reading back
takes out again: ``</s>`` becomes ``<\\/s>``, and a literal ``<\\/s>`` becomes ``<\\\\/s>``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a streamed piece when a log is made from finished rows.
DELTA_CHARS = 1024

ASSISTANT = "assistant"
CONTROL = r"/?s>|/?INST\]"
BREAK = re.compile(rf"([<\[])(?=\\*(?:{CONTROL}))")
JOIN = re.compile(rf"([<\[])\\(?=\\*(?:{CONTROL}))")
TURN = re.compile(r"<s> (.*?) </s>|\[INST\] (.*?)\n(.*?) \[/INST\]", re.S)

EVENTS = "conv_id string, turn long, tie long, seq long, kind string, role string, text string"
TURNS = "conv_id string, role string, formatted string, loss_start int, loss_end int"


# ---- template -----------------------------------------------------------------------

def escape(text: str) -> str:
    """No control string is left, and ``unescape`` gives the text back."""
    return BREAK.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return JOIN.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn and the stretch of it under the loss mask (empty unless the assistant's)."""
    body = escape(text)
    if role == ASSISTANT:
        return f"<s> {body} </s>", 4, 4 + len(body)
    return f"[INST] {escape(json.dumps(role, ensure_ascii=False))}\n{body} [/INST]", 0, 0


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation or a part of it."""
    out, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text outside the template")
        at = m.end()
        if m[1] is not None:
            out.append((ASSISTANT, unescape(m[1])))
        else:
            out.append((json.loads(unescape(m[2])), unescape(m[3])))
    if at != len(formatted):
        raise ValueError("text outside the template")
    return out


# ---- folding ------------------------------------------------------------------------

def fold(events: Iterable[tuple[str, str | None, str | None]]) -> tuple[str, str] | None:
    """(role, final text) of one message from its events (kind, role, text) in sequence order;
    None if it was deleted."""
    role, parts, alive = "", [], True
    for kind, who, text in events:
        if kind == "open":
            role, alive = who or "", True
        elif kind == "delta":
            parts.append(text or "")
        elif kind == "edit":
            parts, alive = [text or ""], True
        elif kind == "regenerate":
            parts = []
        elif kind == "delete":
            parts, alive = [], False
        else:
            raise ValueError(f"unknown event {kind!r}")
    return (role, "".join(parts)) if alive else None


def log_of(conversations: DataFrame) -> DataFrame:
    """A log whose final messages are the given rows (conv_id, turn, role, text).

    A hash of the row deals messages of every length to three forms: a draft and an edit; a draft, a
    regeneration and pieces; pieces alone.  Rows of equal conv_id and turn are separate messages in
    hashed order.
    """
    text = F.coalesce("text", F.lit(""))

    def event(kind: str, text, role=None):
        return F.struct(F.lit(kind).alias("kind"), (F.lit(None).cast("string") if role is None else role).alias("role"),
                        text.alias("text"))

    none = F.lit(None).cast("string")
    opened = F.array(event("open", none, F.col("role")))
    draft = F.array(event("delta", F.concat(F.substring(text, 1, 8), F.lit(" ..."))))
    last = F.ceil(F.length(text) / DELTA_CHARS).cast("int") - 1
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                         lambda i: event("delta", F.substring(text, i * DELTA_CHARS + 1, F.lit(DELTA_CHARS))))
    edited = F.concat(draft, F.array(event("edit", text)))
    again = F.concat(draft, F.array(event("regenerate", none)), pieces)
    form = F.pmod(F.xxhash64("conv_id", "turn", "role", "text"), F.lit(3))
    body = F.when(form == 0, edited).when(form == 1, again).otherwise(pieces)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role",
                                F.struct(F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
                                         F.monotonically_increasing_id().alias("id")).alias("key"),
                                F.concat(opened, body).alias("events"))
    tie = F.xxhash64("key.role", "key.text", "key.id")  # equal rows stay apart
    return rows.select("conv_id", "turn", tie.alias("tie"), F.posexplode("events").alias("seq", "e")).select(
        F.col("conv_id").cast("string").alias("conv_id"), "turn", "tie", F.col("seq").cast("long").alias("seq"), "e.*")


def rendered(log: DataFrame) -> DataFrame:
    """One row per final message, in order within each partition, a conversation in one
    partition: conv_id, role, formatted, loss_start and loss_end (the mask, in code points).

    NULL conv_ids form one conversation, NULL turns come first, NULL roles and texts are empty,
    other columns are ignored, an empty log gives an empty result.
    """
    def turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out = None, [], []

        def close() -> None:
            message = fold(held)
            if message:
                out.append((key[0], message[0], *render(*message)))
            held.clear()

        def made() -> pd.DataFrame:
            rows = pd.DataFrame(out, columns=["conv_id", "role", "formatted", "loss_start", "loss_end"])
            out.clear()
            return rows

        for pdf in batches:
            for conv, turn, tie, kind, role, text in pdf.itertuples(index=False):
                if (conv, turn, tie) != key:
                    if held:
                        close()
                    key = (conv, turn, tie)
                held.append((kind, role, text))
            yield made()
        if held:
            close()
        yield made()

    order = ["conv_id", F.col("turn").asc_nulls_first(), "tie", "seq"]
    dealt = log.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn"),
                        "tie", "kind", "role", "text").mapInPandas(turns, TURNS)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted turns: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.  Streams through the partitions that ``rendered`` made."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = (), None

        def row(conv, s) -> tuple:
            return conv, s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"]

        for pdf in batches:
            out = []
            for conv, formatted, a, b in pdf.itertuples(index=False):
                if (conv,) != key:
                    if state:
                        out.append(row(key[0], state))
                    key = (conv,)
                    state = {"n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0}
                for role, text in parse(formatted):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                masked = unescape(formatted[a:b])
                state["loss_chars"] += len(masked)
                state["loss"].update(masked.encode())
                state["chars"] += len(formatted)
            yield frame(out)
        if state:
            yield frame([row(key[0], state)])

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                           "formatted_chars"])

    got = turns.select("conv_id", "formatted", "loss_start", "loss_end").mapInPandas(
        read, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
    return got.withColumn("conv_id", F.col("conv_id").cast("long"))
