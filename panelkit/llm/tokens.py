"""Token files: frequency-ranked ids in a byte-aligned variable-length code.

A first pass tokenizes every text into a table of raw ids and counts every id; the vocabulary
ordered by falling count gives each id its rank, so the commonest ids get the smallest numbers.
A second pass puts documents in doc_id order and writes blocks: two bits of a control byte per
number say whether its rank takes 1, 2, 3 or 4 data bytes; control and data bytes are stored
apart.  Decoding looks the 256 possible control bytes up in a table of lengths (numpy), which
gives all data offsets at once, and maps ranks back to ids.

Layout of a block: ``HEAD`` (magic, documents, numbers, bytes of control, numbers before it in
its file), doc lengths (u4 each), control bytes, data bytes.  Blocks are binary values of a
Parquet table, written by Spark's committer, so lost executors leave no torn files.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import kept, partitions, shared_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Numbers in a block, about; a longer document makes its own block.
BLOCK_IDS = 1 << 20
#: Entries of a worker's caches of words and of their parts; a full one is emptied, which
#: changes no result.
WORDS, PARTS = 600_000, 800_000

MAGIC = b"VLC1"
HEAD = "<4sIQQQ"
HEAD_SIZE = struct.calcsize(HEAD)


# ---- tokenizing ---------------------------------------------------------------------

#: Unicode white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
MARK = "!\"#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~"
#: Stretches that the byte-level pre-tokenizer never joins with their neighbours: words of Latin
#: letters up to white space or punctuation, punctuation up to white space or such letters, any
#: other black stretch, white space as its rule cuts it.
STRETCH = re.compile(
    f" ?[{LATIN}]+(?=[{SPACE}{MARK}]|$)| ?[{MARK}]+(?=[{SPACE}{LATIN}]|$)"
    f"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Stretches that the pre-tokenizer leaves whole.
WHOLE = re.compile(f" ?(?:[{LATIN}]+|[{MARK}]+)")
#: White space that it may join across the spaces at which a text is split.
LONG_SPACE = re.compile(f"[{SPACE}]{{3}}|[{SPACE}]{{2}}$")
ODD_SPACE = re.compile(f"(?![ \n])[{SPACE}]")


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: itself where it can be
    printed, else the next free code point from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    letter = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letter[b] for b in range(256)]


LETTER = byte_letters()


class Encoder:
    """The tokenizers library with the ids of words and of their parts kept for a while: encoding
    a text equals joining the ids of its parts (see the tests).  Ids are bytes of ``dtype``."""

    def __init__(self, path: str = TOKENIZER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = "<u2" if self.code == "H" else "<u4"
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def encode_whole(self, text: str) -> bytes:
        return self.pack(self.library.encode(text, add_special_tokens=False).ids)

    def part(self, stretch: str) -> bytes:
        """Ids of a stretch not met before."""
        if not WHOLE.fullmatch(stretch):
            got = self.encode_whole(stretch)
        else:
            letters = stretch if stretch.isascii() else "".join([LETTER[b] for b in stretch.encode()])
            got = array(self.code, [t.id for t in self.model.tokenize(letters.replace(" ", LETTER[32]))]).tobytes()
        if len(self.parts) >= PARTS:
            self.parts.clear()
        self.parts[stretch] = got
        return got

    def join(self, text: str) -> bytes:
        kept = self.parts.get
        return b"".join([kept(s) or self.part(s) for s in STRETCH.findall(text)])

    def encode_one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.encode_whole(text)
        # words with the space before them left out, or with the line break before them
        first, *words = text.replace("\n", " \n").split(" ")
        if words.count("") + words.count("\n") > 1 or words and words[-1] in ("", "\n"):
            if LONG_SPACE.search(text):
                return self.join(text)
        if len(self.words) >= WORDS:
            self.words.clear()
        kept = self.words
        got = list(map(kept.get, words))
        if None in got:
            if ODD_SPACE.search(text):
                return self.join(text)
            parts, part, stretches = self.parts.get, self.part, STRETCH.findall
            for i, ids in enumerate(got):
                if ids is None:
                    w = words[i]
                    ids = kept.get(w)
                    if ids is None:
                        found = stretches(w if w[:1] == "\n" else " " + w)
                        ids = kept[w] = b"".join([parts(s) or part(s) for s in found])
                    got[i] = ids
        if ODD_SPACE.search(first):
            return self.join(text)
        return (self.join(first) if first else b"") + b"".join(got)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.encode_one(t) for t in texts]


def tokenized(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> tuple[np.ndarray, str]:
    """Write (doc_id, ids) of every text to ``path``; the ids that occur, end ids included, by
    falling count, and the type of the written ids."""
    spark = docs.sparkSession
    dtype = Encoder(tokenizer).dtype

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = kept(("encoder", tokenizer), lambda: Encoder(tokenizer))
        for texts in batches:
            yield pd.Series(encoder.encode(texts.tolist()), dtype=object)

    (docs.select(F.col("doc_id").cast("long"), encode(F.col("text")).alias("ids"))
     .write.option("compression", "zstd").parquet(path))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(END_ID + 1, np.int64)
        for pdf in batches:
            got = np.bincount(np.frombuffer(b"".join(pdf["ids"]), dtype), minlength=len(total))
            got[:len(total)] += total
            total = got
            total[END_ID] += len(pdf)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    ids = spark.read.schema("doc_id long, ids binary").parquet(path).select("ids")
    rows = (ids.mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "id").select("id").collect())  # at most the vocabulary
    return np.array([r.id for r in rows], np.uint32), dtype


# ---- variable-length code -----------------------------------------------------------

#: For each control byte the data bytes of its four numbers.
LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    x = np.asarray(numbers, "<u4")
    size = 1 + (x >= 1 << 8).astype(np.uint8) + (x >= 1 << 16) + (x >= 1 << 24)
    code = np.zeros(-(-len(x) // 4) * 4, np.uint8)
    code[:len(x)] = size - 1
    quads = code.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4) < size[:, None]
    return control.astype(np.uint8).tobytes(), x.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


def block(lengths: list[int], ranks: np.ndarray, before: int) -> bytes:
    control, data = pack(ranks)
    return b"".join([struct.pack(HEAD, MAGIC, len(lengths), len(ranks), len(control), before),
                     np.array(lengths, "<u4").tobytes(), control, data])


def unblock(raw: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(document lengths, ranks, numbers before the block in its file)."""
    magic, docs, n, n_control, before = struct.unpack_from(HEAD, raw)
    if magic != MAGIC:
        raise ValueError("not a token block")
    a = HEAD_SIZE
    b = a + 4 * docs
    lengths = np.frombuffer(raw, "<u4", docs, a)
    return lengths, unpack(raw[b:b + n_control], raw[b + n_control:], n), before


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` into token files below ``path``: ``ranks`` (rank, id), ``blocks`` (file,
    number, doc_ids, block; files and the blocks in them follow doc_id order) and ``raw``, the
    first pass's ids.

    NULL texts are empty; NULL doc_ids come first; repeated rows are separate documents; other
    columns are ignored.
    """
    spark = docs.sparkSession
    by_rank, dtype = tokenized(docs, f"{path}/raw", tokenizer)
    spark.createDataFrame(pd.DataFrame({"rank": np.arange(len(by_rank)), "id": by_rank.astype(np.int64)}),
                          "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))
    shared = spark.sparkContext.broadcast(rank)  # one number per id of the vocabulary

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank, ids, lengths, held = shared.value, [], [], []
        number = before = waiting = 0

        def flush() -> pd.DataFrame:
            ranks = rank[np.concatenate(held)]
            made = pd.DataFrame({"number": [number], "doc_ids": [list(ids)], "block": [block(lengths, ranks, before)]})
            ids.clear(), lengths.clear(), held.clear()
            return made

        for pdf in batches:
            for doc_id, raw in zip(pdf["doc_id"], pdf["ids"]):
                one = np.append(np.frombuffer(raw, dtype), END_ID)
                if held and waiting + len(one) > block_ids:
                    yield flush()
                    number, before, waiting = number + 1, before + waiting, 0
                ids.append(int(doc_id) if doc_id is not None else None)
                lengths.append(len(one))
                held.append(one)
                waiting += len(one)
        if held:
            yield flush()

    raw = spark.read.schema("doc_id long, ids binary").parquet(f"{path}/raw")
    key = F.col("doc_id").cast("string")  # pandas has no NULL in integer columns
    ordered = raw.repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first())
    (ordered.select(key.alias("doc_id"), "ids").mapInPandas(blocks, "number int, doc_ids array<long>, block binary")
     .withColumn("file", F.spark_partition_id()).write.option("compression", "none").parquet(f"{path}/blocks"))


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned
    32-bit integers) of every document of the token files below ``path``."""
    by_rank = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    shared = spark.sparkContext.broadcast(by_rank)
    blocks = spark.read.schema("number int, doc_ids array<long>, block binary, file int").parquet(f"{path}/blocks")

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"file": pdf["file"], "n": [struct.unpack(HEAD, h)[2] for h in pdf["head"]]})

    heads = blocks.select("file", F.expr(f"substring(block, 1, {HEAD_SIZE})").alias("head"))
    files = heads.mapInPandas(total, "file int, n long").groupBy("file").agg(F.sum("n").alias("n"))
    order = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    offsets = files.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("offset"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_rank = shared.value
        for pdf in batches:
            for doc_ids, raw, offset in zip(pdf["doc_ids"], pdf["block"], pdf["offset"]):
                lengths, ranks, before = unblock(raw)
                ids = by_rank[ranks].astype("<u4")
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                yield pd.DataFrame({
                    "doc_id": pd.array([None if d is None else int(d) for d in doc_ids], "Int64"),
                    "start": offset + before + begins, "n_tokens": lengths.astype(np.int64),
                    "ids": [ids[a:b].tobytes() for a, b in zip(begins, ends)]})

    texts = F.col("doc_ids").cast("array<string>").alias("doc_ids")  # numpy has no NULL in integers
    return blocks.join(F.broadcast(offsets), "file").select(texts, "block", "offset").mapInPandas(
        decode, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write token files of ``docs`` to the shared folder and read them back: doc_id, start,
    n_tokens, ids_crc32."""
    path = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
