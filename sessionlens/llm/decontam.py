"""Operator 9, benchmark decontamination by winnowing.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case. A window is 13 consecutive words of a
benchmark item; an item of fewer words, but not none, is one window. Of each `13 - K + 1` consecutive K-gram hashes the
smallest is a text's fingerprint, so two texts that share 13 words in a row share a fingerprint: nothing is missed.

1. Training fingerprints are joined to benchmark fingerprints on the hash.
2. Hits are extended: each window of the text whose smallest K-gram is a hit is looked up, by 128 bits of hash, among the
   benchmark's distinct windows. A window stands for the set of items that hold it, so a passage that many items share is
   met once, not once an item. Items too short for the guarantee are one n-gram of their own length, looked up likewise.
3. Each text has the positions of its windows, which give the words hit, and a few item sets. Texts with the same item sets
   share one list of items, which is read in order and hashed once.

The fingerprints of the benchmark travel to the tasks as sorted arrays where there are no more than KNOWN_LIMIT (16 MB, which
pass through the driver as arrays too); then only texts with a hit go on. Beyond that, all fingerprints of the texts go into
the join. Both ways give the same rows.

Nulls: a null text has no words; a null item_id counts as an item, written as an empty string. Texts of no words hit
nothing. Equal texts are judged once and share the result. Repeated items occur together, each counted. Empty tables give
empty results or no hits. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm import textvec as tv
from sessionlens.llm.common import disposable, hash128, own_columns, written

WINDOW = 13
#: Words of a fingerprint's n-gram; WINDOW - K + 1 of them make a window.
K = 7
#: Most benchmark fingerprints that are broadcast (8 bytes each); more are joined by a shuffle only.
KNOWN_LIMIT = 2_000_000

#: DuckDB SQL for the digest of contaminated documents with 13-word windows.
SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
il AS (SELECT iid, item_id, w, least(13, len(w)) AS n FROM iw WHERE len(w) > 0),
ig AS (SELECT DISTINCT iid, item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM il)),
ns AS (SELECT DISTINCT n FROM il),
dg AS (SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, ns WHERE len(w) >= n)),
hit AS (SELECT dg.rid, dg.n, dg.p, ig.iid, ig.item_id FROM dg JOIN ig ON dg.g = ig.g AND dg.n = ig.n),
pos AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT rid, p, n FROM hit)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, iid, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos ON dw.rid = pos.rid LEFT JOIN its ON dw.rid = its.rid
"""


def fingerprints(h: np.ndarray, first: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of words) and hashes of the winnowed k-grams: of each window's k-grams the smallest."""
    grams = tv.ngrams(h, k)
    w = window - k + 1
    low = tv.sliding_min(grams, w)
    if not len(low):
        return np.zeros(0, np.int64), low
    low = np.where(tv.within(first, window), low, np.uint64(0))
    # A k-gram is chosen if it is the smallest of a window that lies within its text.
    chosen = np.zeros(len(grams), bool)
    for j in range(w):
        chosen[j : j + len(low)] |= grams[j : j + len(low)] == low
    at = np.flatnonzero(chosen)
    return at, grams[at]


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, np.ndarray, tv.Words]]:
    for lo, hi, data, offsets in tv.slices(batch.column(name)):
        yield lo, hi, data, tv.words(data, offsets, tv.ALNUM)


def _windows(w: tv.Words, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of the n words from each position on."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    other = tv.mix(w.hash ^ np.uint64(0x6A09E667F3BCC909))
    return tv.ngrams(w.hash, n)[at], tv.ngrams(other, n)[at]


def _item_prints(window: int, k: int) -> Callable:
    """iid, text of items -> n (n-gram length, or 0 for a winnowed k-gram), h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, w in _texts(batch, "text"):
                _, h = fingerprints(w.hash, w.first, window, k)
                size = np.diff(w.first)
                short = np.flatnonzero((size > 0) & (size < window))
                more = np.array([tv.ngrams(w.hash[w.first[i] : w.first[i + 1]], int(size[i]))[0] for i in short], np.uint64)
                n = np.concatenate([np.zeros(len(h)), size[short]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(tv.signed(np.concatenate([h, more])))], ["n", "h"])

    return run


def _item_windows(window: int) -> Callable:
    """iid, text of items -> iid, n, w1, w2 of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, _, w in _texts(batch, "text"):
                size = np.diff(w.first)
                for n in np.unique(np.minimum(size[size > 0], window)).tolist():
                    at = np.flatnonzero(tv.within(w.first, n))
                    item = np.searchsorted(w.first, at, "right") - 1
                    own = np.minimum(size[item], window) == n
                    w1, w2 = _windows(w, at[own], n)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("iid").take(pa.array(item[own] + lo)), pa.array(np.full(len(w1), n, np.int32)), pa.array(tv.signed(w1)), pa.array(tv.signed(w2))], ["iid", "n", "w1", "w2"]
                    )

    return run


def _text_prints(window: int, k: int, lengths: list[int], known: dict[int, np.ndarray] | None) -> Callable:
    """doc_id, t, text -> doc_id, t, n_words, text (null without hits), hits (structs of n, h)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, w in _texts(batch, "text"):
                docs, ns, hs = [], [], []
                for n in [0, *lengths]:
                    if n:
                        h = tv.ngrams(w.hash, n)
                        at = np.flatnonzero(tv.within(w.first, n))
                        h = h[at]
                    else:
                        at, h = fingerprints(w.hash, w.first, window, k)
                    if known is not None:
                        there = known[n]
                        hit = there[np.minimum(np.searchsorted(there, h), len(there) - 1)] == h if len(there) else np.zeros(len(h), bool)
                        at, h = at[hit], h[hit]
                    docs.append(np.searchsorted(w.first, at, "right") - 1)
                    ns.append(np.full(len(at), n, np.int32))
                    hs.append(h)
                doc, n, h = np.concatenate(docs), np.concatenate(ns), np.concatenate(hs)
                order = np.argsort(doc, kind="stable")
                doc, n, h = doc[order], n[order], h[order]
                ends = np.searchsorted(doc, np.arange(hi - lo + 1))
                hits = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays([pa.array(n), pa.array(tv.signed(h))], ["n", "h"]))
                part = batch.slice(lo, hi - lo)
                text = part.column("text").take(pa.array(np.arange(hi - lo), mask=np.diff(ends) == 0))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("t"), pa.array(np.diff(w.first)), text, hits], ["doc_id", "t", "n_words", "text", "hits"])

    return run


def _extend(window: int, k: int) -> Callable:
    """t, text, hits (structs of n, h) -> t, pos, n, w1, w2: the windows that a hit may stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, w in _texts(batch, "text"):
                lists = batch.column("hits").slice(lo, hi - lo)
                kind, hash_ = (c.to_numpy() for c in lists.flatten().flatten())
                owner = np.repeat(np.arange(hi - lo), lists.value_lengths().to_numpy())
                for n in np.unique(kind).tolist():
                    own = kind == n
                    size = n or window
                    at = np.flatnonzero(tv.within(w.first, size))
                    h = tv.ngrams(w.hash, n) if n else tv.sliding_min(tv.ngrams(w.hash, k), window - k + 1)
                    doc = np.searchsorted(w.first, at, "right") - 1
                    # Hits of one text don't count for another one in the slice: the text's number goes into the hash.
                    mark = lambda d, x: tv.mix(x ^ tv.mix(d.astype(np.uint64)))
                    known = np.unique(mark(owner[own], hash_[own].view(np.uint64)))
                    h = mark(doc, h[at])
                    hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                    at, doc = at[hit], doc[hit]
                    w1, w2 = _windows(w, at, size)
                    pos = at - w.first[doc]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("t").take(pa.array(doc + lo)), pa.array(pos.astype(np.int32)), pa.array(np.full(len(at), size, np.int32)), pa.array(tv.signed(w1)), pa.array(tv.signed(w2))], ["t", "pos", "n", "w1", "w2"]
                    )

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """group, item sorted -> group, n_items, items_sha256 of the items, comma-joined; a group's rows stream through."""
    last, n, sha = None, 0, sha256()
    for batch in batches:
        out = []
        for group, item in zip(batch.column("group").to_pylist(), batch.column("item").to_pylist(), strict=True):
            if group != last:
                if n:
                    out.append((last, n, sha.hexdigest()))
                last, n, sha = group, 0, sha256()
            sha.update(("," + item if n else item).encode())
            n += 1
        yield _lists(out)
    yield _lists([(last, n, sha.hexdigest())] if n else [])


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["group", "n_items", "items_sha256"])


def benchmark_windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(n, w1, w2, set of the distinct windows; set, iid: the items of each set), from iid and text."""
    each = written(items.select("iid", "text").mapInArrow(_item_windows(window), "iid long, n int, w1 long, w2 long").distinct(), "item-windows")
    key = ["n", "w1", "w2"]
    # A set of items is named by how many they are and two sums of hashes, which are added up before anything is shuffled.
    total = lambda salt: F.sum(F.shiftright(F.xxhash64(F.lit(salt), "iid"), 20))
    sets = each.groupBy(*key).agg(F.xxhash64(F.count(F.lit(1)), total(1), total(2)).alias("set"))
    sets = written(sets, "windows")
    # One window of each set tells its items.
    one = sets.groupBy("set").agg(F.min(F.struct(*key)).alias("w")).select("set", *[F.col(f"w.{c}").alias(c) for c in key])
    return sets, written(each.join(one, key).select("set", "iid"), "sets")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, known_limit: int = KNOWN_LIMIT) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document; and t, the text's hash, last."""
    with disposable(documents.sparkSession) as keep:
        marked, found = _judged(documents, benchmark, window, k, known_limit)
        keep(marked, found)
    out = marked.select("doc_id", "t", "n_words").join(found, "t", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.lit(sha256(b"").hexdigest())
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "t")


def _judged(documents: DataFrame, benchmark: DataFrame, window: int, k: int, known_limit: int) -> tuple[DataFrame, DataFrame]:
    """(every document with n_words; n_hit, n_items, items_sha256 of the texts with hits), both written."""
    docs = own_columns(documents, "doc_id", "text").withColumn("t", hash128(F.col("text")))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    items = written(own_columns(benchmark, "item_id", "text").where(F.length("text") > 0).withColumn("iid", F.monotonically_increasing_id()), "items")
    prints = written(items.select("text").mapInArrow(_item_prints(window, k), "n int, h long").distinct(), "prints")
    lengths = sorted(r.n for r in prints.where("n > 0").select("n").distinct().collect())  # below `window` values
    known = None
    if prints.count() <= known_limit:
        rows = prints.toArrow()
        n, h = rows.column("n").to_numpy(), rows.column("h").to_numpy()
        known = {x: np.sort(h[n == x].view(np.uint64)) for x in [0, *lengths]}
    schema = f"doc_id {doc_id}, t binary, n_words long, text string, hits array<struct<n:int,h:long>>"
    marked = written(docs.mapInArrow(_text_prints(window, k, lengths, known), schema), "marked")
    hits = marked.where(F.size("hits") > 0).select("t", F.explode("hits").alias("hit")).select("t", "hit.n", "hit.h").distinct()
    hits = hits.join(prints, ["n", "h"], "left_semi").groupBy("t").agg(F.collect_list(F.struct("n", "h")).alias("hits"))
    texts = marked.where("text is not null").select("t", "text").groupBy("t").agg(F.first("text").alias("text"))
    windows = texts.join(hits, "t").select("t", "text", "hits").mapInArrow(_extend(window, k), "t binary, pos int, n int, w1 long, w2 long")
    sets, members = benchmark_windows(items, window)
    met = written(windows.join(sets, ["n", "w1", "w2"]).select("t", "pos", "n", "set"), "met")
    # The words that windows cover: each window adds those past the end of the windows before it.
    spans = F.array_sort(F.collect_set(F.struct("pos", (F.col("pos") + F.col("n")).alias("end"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))
    step = lambda a, x: F.struct(F.greatest(a["end"], x["end"]).alias("end"), (a["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["pos"]))).alias("hit"))
    per = met.groupBy("t").agg(spans.alias("spans"), F.array_sort(F.collect_set("set")).alias("sets"))
    per = written(per.select("t", F.aggregate("spans", start, step)["hit"].cast("long").alias("n_hit"), "sets", F.xxhash64("sets").alias("group")), "hit-texts")
    groups = per.groupBy("group").agg(F.first("sets").alias("sets")).select("group", F.explode("sets").alias("set"))
    named = groups.join(members, "set").select("group", "iid").distinct().join(items.select("iid", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")), "iid")
    lists = named.repartition("group").sortWithinPartitions("group", "item").select("group", "item").mapInArrow(_listed, "group long, n_items long, items_sha256 string")
    return marked, written(per.join(written(lists, "lists"), "group").select("t", "n_hit", "n_items", "items_sha256"), "contaminated")
