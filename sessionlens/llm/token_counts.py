"""Operator 11, token counts: exact counts of a given tokenizer, huge texts in overlapping chunks that are spliced.

Texts of up to CHUNK + OVERLAP code points are encoded as they are. Longer ones are cut into chunks of CHUNK that run on for
OVERLAP, so that two chunks hold each seam; chunks are dealt to tasks one by one and encoded with offsets. At a seam the
chunks are spliced where both start a token and the text itself proves a boundary:

* a byte-level BPE cuts a text into pieces by a pattern, left to right, and merges within pieces only. No piece holds
  white space after anything else, an ASCII letter before an ASCII character that is none, or an ASCII digit likewise, so a
  piece ends there whatever came before; and a scan that starts anew there depends on nothing before it;
* the earlier chunk has no special token across that place, as it starts a token there and ends MARGIN or more later,
  which is longer than any special token. The later chunk agrees.

So the earlier chunk's tokens up to there and the later chunk's from there on are the whole text's own. A seam without such a
place fails: its text is cut anew with four times the chunk and the overlap, until one chunk holds it. That always ends, with
a whole encoding at worst, as a text that is one single word needs.

Equal long texts are encoded once, equal short ones once a task. Only positions and counts in the overlaps leave a task, and each seam is settled apart.
The proof holds for byte-level BPE without a normaliser; other tokenizers (sentencepiece models among them) encode whole texts.

A null text is empty and has no tokens. A null doc_id and repeated rows are rows like others. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import hash128, own_columns, partitions, written

#: Code points of a chunk, and of the overlap with the next.
CHUNK, OVERLAP = 1 << 16, 1 << 12
#: Bytes of text that are encoded at a time.
AT_ONCE = 1 << 20
#: Texts whose counts a task remembers before it starts anew.
KNOWN = 200_000
#: A seam keeps off the earlier chunk's end by so much: more than a special token or a contraction is long.
MARGIN = 64
#: Places where a byte-level BPE's pattern ends a piece whatever came before.
STABLE = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[A-Za-z])(?=[\x00-\x40\x5B-\x60\x7B-\x7F])|(?<=[0-9])(?=[\x00-\x2F\x3A-\x7F])")


class Pieces:
    """A tokenizer file of the library that its suffix names, loaded where it is used."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.piece = path.endswith(".model")
        if self.piece:
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer, processors

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        # Of the tokenizer as its file has it; this only stops offsets from leaving out blanks.
        self.placed = Tokenizer.from_file(path)
        self.placed.no_truncation()
        self.placed.no_padding()
        self.placed.post_processor = processors.ByteLevel(trim_offsets=False)

    def counts(self, texts: list[str]) -> list[int]:
        if self.piece:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        return [len(x) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def starts(self, text: str) -> list[int]:
        """Where each token starts, in code points."""
        return [a for a, _ in self.placed.encode(text, add_special_tokens=False).offsets]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def can_splice(path: str) -> bool:
    """Whether the proof holds: a byte-level BPE that cuts by its pattern and changes nothing before."""
    if path.endswith(".model"):
        return False
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    cut = spec.get("pre_tokenizer") or {}
    plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")) and len(t["content"]) < MARGIN for t in spec.get("added_tokens", []))
    return cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not spec.get("normalizer") and spec["model"].get("type", "BPE") == "BPE" and plain


def _count(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replaces text by n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        known: dict[bytes, int] = {}

        def learn(texts: dict[bytes, str]) -> None:
            known.update(zip(texts, own.counts(list(texts.values())), strict=True))
            texts.clear()

        for batch in batches:
            place = batch.schema.get_field_index("text")
            if len(known) >= KNOWN:
                known.clear()
            keys: list[bytes] = []
            new: dict[bytes, str] = {}
            size = 0
            for text in (x.as_py() or "" for x in batch.column(place)):
                keys.append(key := blake2b(text.encode(), digest_size=16).digest())
                if key not in known and key not in new:
                    new[key] = text
                    size += len(text)
                    if size >= AT_ONCE:
                        learn(new)
                        size = 0
            learn(new)
            yield batch.set_column(place, "n_tokens", pa.array([known[k] for k in keys], pa.int64()))

    return run


def _cut(chunk: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """key, text -> key, k (chunk number), last, text (of the chunk and its overlap)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                text = text.as_py()
                n = max(1, -(-(len(text) - overlap) // chunk))
                for lo in range(0, n, 16):
                    some = range(lo, min(n, lo + 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * len(some), pa.binary()), pa.array(some, pa.int32()), pa.array([k == n - 1 for k in some]), pa.array([text[k * chunk : (k + 1) * chunk + overlap] for k in some])], ["key", "k", "last", "text"]
                    )

    return run


def seams(starts: list[int], text: str, base: int, lo: int, hi: int) -> tuple[list[int], list[int]]:
    """Places in text[lo:hi] that are proven and start a token, from the whole text's start (base: the chunk's), and the tokens before each."""
    number: dict[int, int] = {}
    for i, s in enumerate(starts):
        if lo <= s < hi:
            number.setdefault(s, i)
        elif s >= hi:
            break
    own = [m.start() for m in STABLE.finditer(text, lo, hi)]
    own = [p for p in own if p in number and lo <= p < hi]
    return [base + p for p in own], [number[p] for p in own]


def _encode(path: str, chunk: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks -> rows of seams: key, seam (the later chunk's number), side (0: the later chunk), at, before; and the last chunk's tokens."""

    def sides(k: int, last: bool, text: str) -> Iterator[tuple[int, int, list[int], list[int], int | None]]:
        starts, base = pieces(path).starts(text), k * chunk
        if k:
            yield k, 0, *seams(starts, text, base, 0, min(overlap, len(text))), None
        if not last:
            yield k + 1, 1, *seams(starts, text, base, chunk, len(text) - MARGIN), None
        else:
            yield 0, 0, [], [], len(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[Any] = [pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
        for batch in batches:
            for i in range(batch.num_rows):
                key, k, last, text = (batch.column(c)[i].as_py() for c in ("key", "k", "last", "text"))
                rows = [(key, *x) for x in sides(k, last, text)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "seam", "side", "at", "before", "tokens"])

    return run


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """key, n_tokens, failed (seams without a common place) of each distinct text of (key, text)."""
    n = partitions(texts.sparkSession)
    cut = texts.mapInArrow(_cut(chunk, overlap), "key binary, k int, last boolean, text string").dropDuplicates(["key", "k"])
    sides = cut.repartition(n, "key", "k").mapInArrow(_encode(path, chunk, overlap), "key binary, seam int, side int, at array<long>, before array<long>, tokens long")
    of = lambda side: F.max(F.when((F.col("seam") > 0) & (F.col("side") == side), F.struct("at", "before")))
    met = sides.groupBy("key", "seam").agg(of(1).alias("a"), of(0).alias("b"), F.max("tokens").alias("tokens"))
    p = F.array_min(F.array_intersect("a.at", "b.at"))
    number = lambda x: F.expr(f"try_element_at({x}.before, int(array_position({x}.at, p)))")
    met = met.withColumn("p", p).withColumn("n", F.coalesce("tokens", number("a") - number("b")))
    return met.groupBy("key").agg(F.sum("n").alias("n_tokens"), F.count_if(F.col("n").isNull()).alias("failed"))


def count_tokens(documents: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than limit) of every document. path: the tokenizer's file, on all nodes."""
    docs = own_columns(documents, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    length = F.length("text") if can_splice(path) else F.lit(0)
    short = docs.where(length <= chunk + overlap).mapInArrow(_count(path), f"doc_id {doc_id}, n_bytes long, n_tokens long")
    long = docs.where(length > chunk + overlap).withColumn("key", hash128(F.col("text")))
    done: DataFrame | None = None
    if can_splice(path):
        todo = long.select("key", "text")
        while True:
            spliced = written(_spliced(todo, path, chunk, overlap), "spliced")
            own = spliced.where("failed = 0").select("key", "n_tokens")
            done = own if done is None else done.unionByName(own)
            failed = spliced.where("failed > 0").select("key")
            if failed.isEmpty():
                break
            todo = long.select("key", "text").join(failed, "key", "left_semi")
            chunk, overlap = chunk * 4, overlap * 4
        short = short.unionByName(long.drop("text").join(done, "key").select("doc_id", "n_bytes", "n_tokens"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)
