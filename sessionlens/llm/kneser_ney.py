"""Operator 5, LM scoring: an interpolated modified Kneser-Ney trigram model as sorted, memory-mapped hash arrays.

Tokens are the words `[^\\x20\\x09-\\x0D]+` of a text with A-Z in lower case, and one end after the last word. N-grams are
named by 64 bits of hash. Four passes over the texts, each partitioned and shuffled by Spark; no n-gram is left out:

1. Tasks add up their trigrams and send (hash, count), packed by range of the hash space; a reducer adds up one range at a
   time and appends to its sorted arrays in the shared folder. The counts of counts give the discounts.
2. Tasks look up every trigram's count c. An occurrence weighs 1 / c, so the weights of a bigram's occurrences add up to its
   number of distinct predecessors, and of distinct successors seen once, twice and more often, without moving trigrams by
   their bigrams. Reducers write bigram arrays: count, predecessors, back-off weight.
3. The same from bigrams to words: count, predecessors, successors' total, back-off weight.
4. Tasks memory-map the arrays (pages are read as needed and shared by a machine's workers) and score every text.

p(w | uv) = max(c(uvw) - D3, 0) / c(uv) + b(uv) p(w | v), with a(vw), the number of distinct predecessors of vw, in place of
counts for p(w | v) = max(a(vw) - D2, 0) / a(v.) + b(v) p(w), and p(w) = max(a(w) - D1, 0) / a(.) + b / (V + 1). Bigrams at a
text's start have no predecessors and keep their counts. There are three discounts a level. A context that training lacks
passes all mass on.

Arrays are cut into buckets by the hash's leading bits, about BUCKET n-grams each, and hold the next 32 bits: a wrong match
has a chance of BUCKET / 2 ** 32, whatever the input's size. Back-off weights are 32-bit floats, so that a context of any
number of occurrences leaves something to words that never followed it.

Nulls: a null text is empty (only the end); a null doc_id counts as an empty text in the split, so it trains. Repeated
rows count again. Without training texts every token has p = 1 / (V + 1) = 1. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm import textvec as tv
from sessionlens.llm.common import local_path, own_columns, partitions, release_shuffles, scratch

U = np.uint64
START, END = U(0x7C0FFEE5A1B2C3D4), U(0x1D872B41A5F3E690)
#: Texts of so many bytes are looked up at a time, and so many tokens are added up before they leave a task.
SLICE, GATHER = 4 << 20, 3_000_000
#: Hash ranges a shuffle partition at least, and bytes of text a range at most: a reducer holds one range.
RANGES, RANGE_BYTES = 4, 32 << 20
BUCKET = 8
#: Files of parts that a reader keeps open.
OPEN = 256


class Layout(NamedTuple):
    """How the 64-bit hashes are dealt: 2 ** bits ranges over n parts (shuffle partitions), 2 ** deep buckets."""

    folder: str
    n: int
    bits: int
    deep: int

    def part(self, shard: np.ndarray | int) -> Any:
        return (shard * self.n) >> self.bits

    def first(self, part: int) -> int:
        """The first range of a part."""
        return -(-(part << self.bits) // self.n)


class Parts:
    """Sorted hash arrays with values, a set of memory-mapped files a part.

    Fields are numbers of a dtype, or "count": one byte, where 255 stands for a count in a small table beside.
    """

    def __init__(self, layout: Layout, name: str, fields: dict[str, str]) -> None:
        self.layout, self.name, self.fields = layout, name, fields
        self.open: dict[int, dict[str, Any] | None] = {}

    def path(self, part: int) -> str:
        return f"{self.layout.folder}/{self.name}-{part}"

    def _load(self, part: int) -> dict[str, Any] | None:
        if part not in self.open:
            if len(self.open) >= OPEN:
                self.open.clear()
            path, got = self.path(part), None
            if os.path.exists(f"{path}.index"):
                got = {"index": np.memmap(f"{path}.index", np.uint32, "r"), "print": np.memmap(f"{path}.print", np.uint32, "r")}
                for f, kind in self.fields.items():
                    got[f] = np.memmap(f"{path}.{f}", np.uint8 if kind == "count" else kind, "r")
                    if kind == "count":
                        got[f"{f}.key"], got[f"{f}.count"] = (np.fromfile(f"{path}.{f}.{x}", d) for x, d in (("key", U), ("count", np.int64)))
            self.open[part] = got
        return self.open[part]

    def get(self, keys: np.ndarray) -> list[np.ndarray]:
        """The values of sorted keys, 0 where a key is absent."""
        out = [np.zeros(len(keys)) for _ in self.fields]
        if not len(keys):
            return out
        x = self.layout
        part = x.part((keys >> U(64 - x.bits)).astype(np.int64))
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-2)).tolist()
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            got = self._load(int(part[lo]))
            if got is None:
                continue
            own = keys[lo:hi]
            at, ok = _places(own, got, x.deep, x.first(int(part[lo])) << (x.deep - x.bits))
            for values, (f, kind) in zip(out, self.fields.items(), strict=True):
                v = got[f][at[ok]].astype(float)
                if kind == "count" and len(big := np.flatnonzero(v == 255)):
                    v[big] = got[f"{f}.count"][np.searchsorted(got[f"{f}.key"], own[ok[big]])]
                values[lo + ok] = v
        return out


def _places(keys: np.ndarray, part: dict[str, Any], deep: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each key would be, and which keys are there: a binary search in all keys' buckets at once."""
    bucket = (keys >> U(64 - deep)).astype(np.int64) - base
    lo, end = (part["index"][bucket + k].astype(np.int64) for k in (0, 1))
    want, prints = ((keys << U(deep)) >> U(32)).astype(np.uint32), part["print"]
    hi = end.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        below = prints[mid] < want[live]
        lo[live[below]] = mid[below] + 1
        hi[live[~below]] = mid[~below]
        live = live[lo[live] < hi[live]]
    ok = np.flatnonzero(lo < end)
    return lo, ok[prints[lo[ok]] == want[ok]]


class PartWriter:
    """Appends ranges in ascending order; the files get their names when the part is whole. A task that runs again writes the same."""

    def __init__(self, parts: Parts, part: int) -> None:
        self.parts, self.part, self.path = parts, part, f"{parts.path(part)}.{uuid.uuid4().hex}"
        os.makedirs(parts.layout.folder, exist_ok=True)
        self.files = {f: open(f"{self.path}.{f}", "wb") for f in ("print", *parts.fields)}  # noqa: SIM115
        self.sizes: dict[int, np.ndarray] = {}
        self.big: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {f: [] for f, kind in parts.fields.items() if kind == "count"}

    def add(self, shard: int, keys: np.ndarray, **values: np.ndarray) -> None:
        x = self.parts.layout
        inner = x.deep - x.bits
        self.sizes[shard] = np.bincount((keys >> U(64 - x.deep)).astype(np.int64) - (shard << inner), minlength=1 << inner)
        ((keys << U(x.deep)) >> U(32)).astype(np.uint32).tofile(self.files["print"])
        for f, kind in self.parts.fields.items():
            v = values[f]
            if kind == "count":
                large = v >= 255
                self.big[f].append((keys[large], v[large].astype(np.int64)))
                v = np.where(large, 255, v).astype(np.uint8)
            v.astype(v.dtype if kind == "count" else kind).tofile(self.files[f])

    def close(self) -> None:
        x = self.parts.layout
        first, inner = x.first(self.part), x.deep - x.bits
        index = np.zeros(((x.first(self.part + 1) - first) << inner) + 1, np.uint32)
        for shard, size in self.sizes.items():
            index[((shard - first) << inner) + 1 : ((shard - first + 1) << inner) + 1] = size
        np.cumsum(index, dtype=np.uint32).tofile(f"{self.path}.index")
        names = ["index", *self.files]
        for f, rows in self.big.items():
            for k, what in enumerate(("key", "count")):
                np.concatenate([r[k] for r in rows]).tofile(f"{self.path}.{f}.{what}")
                names.append(f"{f}.{what}")
        for f in self.files.values():
            f.close()
        for f in reversed(names):  # the index last: a part with an index is whole
            os.replace(f"{self.path}.{f}", f"{self.parts.path(self.part)}.{f}")


class Tokens(NamedTuple):
    token: np.ndarray
    previous: np.ndarray
    context: np.ndarray  #: hash of the two tokens before
    bigram: np.ndarray
    trigram: np.ndarray
    first: np.ndarray  #: for each text, its first token's number; one more at the end


def joined(before: np.ndarray, token: np.ndarray, factor: int) -> np.ndarray:
    return tv.mix(before * U(factor) + token)


#: The context of a text's first token.
OUTSET = joined(np.array([START]), np.array([START]), 0xD6E8FEB86659FD93)[0]


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    w = tv.words(data, offsets, tv.SPACED)
    n = len(offsets) - 1
    first = w.first + np.arange(n + 1)
    token = np.empty(len(w.hash) + n, U)
    token[np.arange(len(w.hash)) + np.repeat(np.arange(n), np.diff(w.first))] = w.hash
    token[first[1:] - 1] = END
    previous, context = np.empty_like(token), np.empty_like(token)
    previous[1:] = token[:-1]
    previous[first[:-1]] = START
    bigram = joined(previous, token, 0xD6E8FEB86659FD93)
    context[1:] = bigram[:-1]
    context[first[:-1]] = OUTSET
    return Tokens(token, previous, context, bigram, joined(context, token, 0xC2B2AE3D27D4EB4F), first)


#: What travels: for each kind of row, the types of its arrays, the first of which are sorted hashes of one range.
_KINDS = {0: "u8", 1: "u8 u4", 2: "u8 u1 u1", 3: "u8 u4 u4 u4", 4: "u8 f8 f8 f8 f8 f8 f8"}
_PACKED = "shard int, kind int, n int, data binary"


def packed(kind: int, bits: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Columns, sorted by their hashes, cut by range."""
    columns = [np.ascontiguousarray(c, t) for c, t in zip(columns, _KINDS[kind].split(), strict=True)]
    shard = (columns[0] >> U(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-2)).tolist() if len(shard) else [0]
    cuts = list(zip(edges[:-1], edges[1:], strict=True))
    data = [b"".join(c[a:b].tobytes() for c in columns) for a, b in cuts]
    return pa.RecordBatch.from_arrays([pa.array(shard[edges[:-1]], pa.int32()), pa.array([kind] * len(cuts), pa.int32()), pa.array([b - a for a, b in cuts], pa.int32()), pa.array(data, pa.binary())], ["shard", "kind", "n", "data"])


def unpacked(kind: int, n: int, data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for t in map(np.dtype, _KINDS[kind].split()):
        out.append(np.frombuffer(data, t, n, at))
        at += n * t.itemsize
    return out


def _gathered(batches: Iterator[pa.RecordBatch], take: Callable[[Tokens], tuple], send: Callable[..., list[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """take()s arrays from each slice of texts and send()s them, some GATHER tokens together."""
    held: list[tuple] = []
    n = 0
    for batch in batches:
        for _, _, data, offsets in tv.slices(batch.column("text"), SLICE):
            t = tokens(data, offsets)
            held.append(take(t))
            n += len(t.token)
            if n >= GATHER:
                yield from send(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
    if held:
        yield from send(*map(np.concatenate, zip(*held, strict=True)))


def _reduced(parts: Parts, add_up: Callable[[list[tuple[int, list[np.ndarray]]]], tuple[np.ndarray, dict[str, np.ndarray]]], counted: str) -> Callable:
    """Packed rows sorted by range -> the parts' files, and a row of counts a part: of the counted field, and of tokens (field c)."""

    def counts(values: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.array([values.sum(), (values > 0).sum(), *((values == j).sum() for j in range(1, 5)), c.sum()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, shard, held, total = None, None, [], np.zeros(7, np.int64)

        def flush() -> None:
            nonlocal writer, total
            keys, values = add_up(held)
            part = parts.layout.part(shard)
            if writer is None or writer.part != part:
                if writer:
                    writer.close()
                writer = PartWriter(parts, part)
            writer.add(shard, keys, **values)
            total += counts(values[counted], values["c"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "n", "data")), strict=True):
                if row[0] != shard and held:
                    flush()
                    held = []
                shard = row[0]
                held.append((row[1], unpacked(*row[1:])))
        if held:
            flush()
        if writer:
            writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in total], _COUNTS.replace(" long", "").split(", "))

    return run


_COUNTS = "total long, distinct long, n1 long, n2 long, n3 long, n4 long, tokens long"


def _grouped(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys in order, and each column's sums."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], [np.add.reduceat(c[order], start) for c in columns]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney, kept between 0 and the count they are taken from."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return min(max(d1, 0.05), 0.95), min(max(d2, 0.05), 1.95), min(max(d3, 0.05), 2.95)


def discounted(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    off = np.where(c >= 3, d[2], np.where(c >= 2, d[1], d[0]))
    return np.maximum(c - off, 0.0) * (c > 0)


def _send_trigrams(bits: int) -> Callable:
    def send(keys: np.ndarray) -> list[pa.RecordBatch]:
        keys, count = np.unique(keys, return_counts=True)
        one = count == 1
        return [packed(0, bits, keys[one]), packed(1, bits, keys[~one], count[~one])]

    return lambda batches: _gathered(batches, lambda t: (t.trigram,), send)


def _add_trigrams(held: list[tuple[int, list[np.ndarray]]]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    keys = np.concatenate([x[0] for _, x in held])
    keys, (c,) = _grouped(keys, np.concatenate([x[1].astype(np.int64) if kind else np.ones(len(x[0]), np.int64) for kind, x in held]))
    return keys, {"c": c}


def _send_bigrams(trigrams: Parts) -> Callable:
    """Of every bigram: the counts of the trigram that ends with it and of the one that starts with it (0: none)."""
    bits = trigrams.layout.bits

    def take(t: Tokens) -> tuple:
        keys, at = np.unique(t.trigram, return_inverse=True)
        c = trigrams.get(keys)[0][at].astype(np.uint32)
        first, last = t.first[:-1], t.first[1:] - 1
        after = np.zeros_like(c)
        after[:-1] = c[1:]
        after[last] = 0
        before = c.copy()
        before[first] = 1  # a bigram at the start keeps its count: each occurrence weighs 1
        n = len(first)
        return np.concatenate([t.bigram, np.full(n, OUTSET)]), np.concatenate([before, np.zeros(n, np.uint32)]), np.concatenate([after, c[first]])

    def send(keys: np.ndarray, before: np.ndarray, after: np.ndarray) -> list[pa.RecordBatch]:
        # Equal rows become neighbours: the hash's last bits only have to keep a range's order.
        low = U(0xFFFF)
        order = np.argsort((keys & ~low) | (tv.mix(keys + before.astype(U) * U(0x10001) + (after.astype(U) << U(33))) & low))
        keys, before, after = keys[order], before[order], after[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (before[1:] != before[:-1]) | (after[1:] != after[:-1])
        start = np.flatnonzero(new)
        times = np.diff(start, append=len(keys))
        keys, before, after = keys[start], before[start], after[start]
        small = (times == 1) & (before < 256) & (after < 256)
        return [packed(2, bits, keys[small], before[small], after[small]), packed(3, bits, *(x[~small] for x in (keys, before, after, times)))]

    return lambda batches: _gathered(batches, take, send)


def _add_bigrams(d: tuple[float, float, float]) -> Callable:
    def add(held: list[tuple[int, list[np.ndarray]]]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        keys = np.concatenate([x[0] for _, x in held])
        before, after = (np.concatenate([x[j] for _, x in held]).astype(float) for j in (1, 2))
        times = np.concatenate([x[3].astype(float) if kind == 3 else np.ones(len(x[0])) for kind, x in held])
        a = times * (before > 0) / np.maximum(before, 1)
        follows = times * (after > 0)
        s = follows / np.maximum(after, 1)
        keys, (c, a, follows, s1, s2, s3) = _grouped(keys, times, a, follows, s * (after == 1), s * (after == 2), s * (after >= 3))
        back = (d[0] * s1 + d[1] * np.rint(s2) + d[2] * np.rint(s3)) / np.maximum(follows, 1)
        return keys, {"c": c.astype(np.int64), "a": np.rint(a).astype(np.int64), "back": back.astype(np.float32)}

    return add


def _send_words(bigrams: Parts) -> Callable:
    """Of every word: occurrences, distinct predecessors, and of its successors the total and the numbers by predecessors."""
    bits = bigrams.layout.bits

    def take(t: Tokens) -> tuple:
        keys, at = np.unique(t.bigram, return_inverse=True)
        c, a, _ = bigrams.get(keys)
        c, a = c[at], a[at]
        weight = 1.0 / np.maximum(c, 1)
        words, at = np.unique(np.concatenate([t.previous, t.token]), return_inverse=True)
        v, w = at[: len(c)], at[len(c) :]
        add = lambda where, x: np.bincount(where, weights=x, minlength=len(words))
        return words, add(w, np.ones(len(w))), add(w, weight), add(v, weight * a), *(add(v, weight * x) for x in (a == 1, a == 2, a >= 3))

    def send(words: np.ndarray, *columns: np.ndarray) -> list[pa.RecordBatch]:
        words, columns = _grouped(words, *columns)
        return [packed(4, bits, words, *columns)]

    return lambda batches: _gathered(batches, take, send)


def _add_words(d: tuple[float, float, float]) -> Callable:
    def add(held: list[tuple[int, list[np.ndarray]]]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        keys, (c, *x) = _grouped(*(np.concatenate(c) for c in zip(*(x for _, x in held), strict=True)))
        a, follow, s1, s2, s3 = map(np.rint, x)
        return keys, {"c": np.rint(c), "a": a, "follow": follow, "back": (d[0] * s1 + d[1] * s2 + d[2] * s3) / np.maximum(follow, 1)}

    return add


class Model(NamedTuple):
    trigrams: Parts
    bigrams: Parts
    words: Parts
    d3: tuple[float, float, float]
    d2: tuple[float, float, float]
    d1: tuple[float, float, float]
    n_tokens: int
    n_words: int
    n_pairs: int
    back: float  #: what the word level leaves to unknown words


def _score(m: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tv.slices(batch.column("text"), SLICE):
                t = tokens(data, offsets)
                keys, at = np.unique(t.trigram, return_inverse=True)
                c3 = m.trigrams.get(keys)[0][at]
                keys, at = np.unique(np.append(t.bigram, OUTSET), return_inverse=True)
                c, a, back = m.bigrams.get(keys)
                own, start = at[:-1], np.zeros(len(t.token), bool)
                start[t.first[:-1]] = True
                context = np.where(start, at[-1], np.concatenate([own[:1], own[:-1]]))
                c2, back3, a2 = c[context], back[context], a[own]
                keys, at = np.unique(np.concatenate([t.previous, t.token]), return_inverse=True)
                c, a, follow, back = m.words.get(keys)
                v, w = at[: len(c2)], at[len(c2) :]
                p = (discounted(a[w], m.d1) / m.n_pairs if m.n_pairs else 0.0) + m.back / (m.n_words + 1)
                p = np.where(follow[v] > 0, discounted(a2, m.d2) / np.maximum(follow[v], 1) + back[v] * p, p)
                p = np.where(c2 > 0, discounted(c3, m.d3) / np.maximum(c2, 1) + back3 * p, p)
                base = np.log10((c[w] + 1.0) / (m.n_tokens + m.n_words + 1.0))
                first = t.first[:-1]
                part = batch.slice(lo, hi - lo)
                sums = [np.add.reduceat(x, first) for x in (base, np.log10(p))]
                n_known = np.add.reduceat((c[w] > 0).astype(np.int64), first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(np.diff(t.first)), pa.array(n_known), pa.array(np.full(hi - lo, m.n_tokens)), *map(pa.array, sums)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def train(texts: DataFrame) -> Model:
    """The model of a table's column text. Its arrays lie in the shared folder; only sums reach the driver."""
    spark = texts.sparkSession
    texts = own_columns(texts, "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions(spark)
    bits = (max(RANGES * n, size // RANGE_BYTES) - 1).bit_length()
    deep = max(bits, math.ceil(math.log2(max(size / 6 / BUCKET, 1))))  # a token has six bytes or more, by and large
    layout = Layout(local_path(scratch(spark, "kneser-ney")), n, bits, deep)

    def level(send: Callable, parts: Parts, add_up: Callable, counted: str) -> Any:
        part = F.shiftright(F.col("shard").cast("long") * n, bits).cast("int")
        dealt = texts.mapInArrow(send, _PACKED).repartitionById(n, part).sortWithinPartitions("shard", "kind", "n", "data")
        sums = dealt.mapInArrow(_reduced(parts, add_up, counted), _COUNTS)
        return sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums.columns]).first()

    of = lambda r: (r.n1, r.n2, r.n3, r.n4)
    trigrams = Parts(layout, "3", {"c": "count"})
    d3 = discounts(*of(level(_send_trigrams(bits), trigrams, _add_trigrams, "c")))
    release_shuffles(spark)  # nothing refers to the level's plan any more
    bigrams = Parts(layout, "2", {"c": "count", "a": "count", "back": "f4"})
    d2 = discounts(*of(level(_send_bigrams(trigrams), bigrams, _add_bigrams(d3), "a")))
    release_shuffles(spark)
    words = Parts(layout, "1", {"c": "f8", "a": "f8", "follow": "f8", "back": "f8"})
    r = level(_send_words(bigrams), words, _add_words(d2), "a")
    d1 = discounts(*of(r))
    back = (d1[0] * r.n1 + d1[1] * r.n2 + d1[2] * (r.distinct - r.n1 - r.n2)) / r.total if r.total else 1.0
    return Model(trigrams, bigrams, words, d3, d2, d1, r.tokens, r.distinct, r.total, back)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def score_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = own_columns(documents, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out")))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.select("doc_id", "held_out", "text").mapInArrow(_score(model), schema)
