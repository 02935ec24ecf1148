"""Operator 2, n-gram Jaccard join: MinHash banding over five-word shingles, verified on full shingle sets.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z in lower case; a text of fewer than five words, but some, is one
shingle. Shingles are named by 44 bits of hash. Two texts are linked if the Jaccard similarity of their shingle sets is
THRESHOLD or more.

1. Texts of one shingle set are one class: a node of the join. Classes come from 128 bits of hash of the set, so copies,
   however many, are grouped by a count and never paired.
2. bands() picks bands and rows a band for the wanted recall at THRESHOLD; nodes meet by band hash.
3. Buckets of up to CROWD nodes list their pairs, which are verified on the full sets.
4. A bucket with more nodes is split by hash into blocks of about BLOCK nodes and BLOCK_SHINGLES shingles. Each two blocks meet
   in one task that verifies their pairs on the full sets and lists none of them: it returns each node's number of links and
   links that span each of its linked groups. A pair that meets in several buckets is left to the list of pairs if one of
   these is small, else to the first of them. So every pair that meets is verified once, and every link counts.
5. Linked nodes get the smallest node of their component by min-label propagation, in logarithmically many rounds in
   practice: each round also takes the label of one's label.

The result has one row a document: class_id (smallest doc_id of its component), set_id (smallest doc_id of the documents with
its shingle set) and n_links (links of its shingle set to other sets).

Nulls: a null text counts as empty. Texts of no words are copies if they are equal, and have no links. A null doc_id names
a class only if the class has no other. Repeated rows are copies. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm import textvec as tv
from sessionlens.llm.common import disposable, hash128, own_columns, written

#: DuckDB SQL for the query's rows; links are exact there.
SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT rid, array_to_string(w[p:p + 4], ' ') AS h FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
k AS (SELECT d.rid, d.doc_id, coalesce(sha256(string_agg(g.h, '|' ORDER BY g.h)), 't' || any_value(d.text)) AS key FROM d LEFT JOIN g ON d.rid = g.rid GROUP BY d.rid, d.doc_id),
n AS (SELECT key, row_number() OVER (ORDER BY key) AS nid, min(rid) AS rid, min(doc_id) AS set_id FROM k GROUP BY key),
x AS (SELECT nid, h, count(*) OVER (PARTITION BY nid) AS size FROM n JOIN g ON n.rid = g.rid),
l AS (SELECT a.nid AS a, b.nid AS b FROM x a JOIN x b ON a.h = b.h AND a.nid <> b.nid GROUP BY a.nid, b.nid, a.size, b.size HAVING count(*) >= 0.8 * (a.size + b.size - count(*))),
c AS (SELECT nid, nid AS label FROM n UNION SELECT l.b, c.label FROM c JOIN l ON l.a = c.nid),
m AS (SELECT nid, min(label) AS label FROM c GROUP BY nid),
i AS (SELECT m.label, min(n.set_id) AS class_id FROM m JOIN n ON m.nid = n.nid GROUP BY m.label),
q AS (SELECT a AS nid, count(*) AS n_links FROM l GROUP BY a)
SELECT k.doc_id, i.class_id, n.set_id, coalesce(q.n_links, 0) AS n_links FROM k JOIN n ON k.key = n.key JOIN m ON n.nid = m.nid JOIN i ON m.label = i.label LEFT JOIN q ON n.nid = q.nid
"""
WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
CROWD = 64
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
FILTER_BITS = 26
U = np.uint64
_BITS = 44


def bands(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """(bands, rows a band): the fewest bands of so many rows that miss a pair at the threshold with 1 - recall at most."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts' distinct shingles as sorted (text number, 44-bit hash) in one number each; where each text's start (one more at the end)."""
    w = tv.words(data, offsets, tv.ALNUM)
    n = len(offsets) - 1
    size = np.diff(w.first)
    at = np.flatnonzero(tv.within(w.first, k))
    h = tv.ngrams(w.hash, k)[at] if len(at) else np.zeros(0, U)
    doc = np.searchsorted(w.first, at, "right") - 1
    short = np.flatnonzero((size > 0) & (size < k))
    more = np.array([tv.ngrams(w.hash[w.first[i] : w.first[i + 1]], int(size[i]))[0] for i in short.tolist()], U)
    both = (np.concatenate([doc, short]).astype(U) << U(_BITS)) | (np.concatenate([h, more]) >> U(64 - _BITS))
    both = np.unique(both)
    return both, np.searchsorted(both >> U(_BITS), np.arange(n + 1, dtype=U))


def _signatures(k: int, n_bands: int, rows: int) -> Callable:
    """doc_id, t, text -> doc_id, t, n (shingles), s1, s2 (hash of the set), bands (null without words)."""
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 1 << 63, n_bands * rows, dtype=np.uint64) * U(2) + U(1)
    shifts = rng.integers(0, 1 << 63, n_bands * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tv.slices(batch.column("text")):
                both, first = shingle_sets(data, offsets, k)
                n, count = hi - lo, np.diff(first)
                some = np.flatnonzero(count)
                start = first[:-1][some]
                h = tv.mix(both & U((1 << _BITS) - 1))
                s1, s2 = np.zeros(n, U), np.zeros(n, U)
                sig = np.zeros((len(some), n_bands), U)
                if len(some):
                    s1[some] = np.add.reduceat(h, start)
                    s2[some] = np.add.reduceat(tv.mix(h ^ U(0x5DEECE66D)), start)
                    for j in range(n_bands):
                        for r in range(rows):
                            low = np.minimum.reduceat(h * factors[j * rows + r] + shifts[j * rows + r], start)
                            sig[:, j] = sig[:, j] * U(0xD6E8FEB86659FD93) + tv.mix(low)
                    sig = tv.mix(sig + np.arange(n_bands, dtype=U))
                sizes = np.zeros(n, np.int64)
                sizes[some] = n_bands
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                part = batch.slice(lo, n)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(tv.signed(sig.reshape(-1))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("t"), pa.array(count.astype(np.int32)), pa.array(tv.signed(s1)), pa.array(tv.signed(s2)), lists], ["doc_id", "t", "n", "s1", "s2", "bands"])

    return run


def _sets(k: int) -> Callable:
    """nid, text -> nid, shingles (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tv.slices(batch.column("text")):
                both, first = shingle_sets(data, offsets, k)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(tv.signed(both & U((1 << _BITS) - 1))))
                yield pa.RecordBatch.from_arrays([batch.column("nid").slice(lo, hi - lo), lists], ["nid", "shingles"])

    return run


def nodes_of(documents: DataFrame, k: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(signed documents: doc_id, t, n, s1, s2; nodes: nid, s1, s2, t of one text, n, bands)."""
    docs = own_columns(documents, "doc_id", "text").withColumn("t", hash128(F.col("text")))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    n_bands, rows = bands(threshold, recall)
    signed = docs.mapInArrow(_signatures(k, n_bands, rows), f"doc_id {doc_id}, t binary, n int, s1 long, s2 long, bands array<long>")
    # A text without words is its own class: equal texts only.
    signed = signed.withColumn("s1", F.when(F.col("n") == 0, F.xxhash64("t")).otherwise(F.col("s1"))).withColumn("s2", F.when(F.col("n") == 0, F.xxhash64(F.lit(1), "t")).otherwise(F.col("s2")))
    signed = written(signed, "signed")
    nodes = signed.groupBy("n", "s1", "s2").agg(F.min("t").alias("t"), F.first("bands").alias("bands"))
    return signed, written(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")


def buckets_of(nodes: DataFrame) -> DataFrame:
    """b (band hash), nid, m (nodes in the bucket), w (their shingles) of the buckets with two nodes or more."""
    met = nodes.select("nid", "n", F.explode("bands").alias("b"))
    stats = written(met.groupBy("b").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w")).where("m > 1"), "buckets")
    return written(met.drop("n").join(stats, "b"), "members")


def all_pairs(members: DataFrame) -> DataFrame:
    """a < b: the pairs within buckets of bounded size."""
    ids = members.groupBy("b").agg(F.sort_array(F.collect_set("nid")).alias("ids"))
    firsts = ids.select("ids", F.posexplode("ids").alias("i", "a"))
    return firsts.select("a", F.explode(F.slice("ids", F.col("i") + 2, F.size("ids"))).alias("b")).distinct()


def shingle_table(documents: DataFrame, nodes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """nid, shingles of the wanted nodes; each from one text of its class."""
    want = written(nodes.join(wanted, "nid", "left_semi").select("nid", "t"), "wanted")
    docs = own_columns(documents, "text").withColumn("t", hash128(F.col("text")))
    # A bitmap of the wanted hashes keeps most other texts out of the shuffle. It has FILTER_BITS bits, so 2**20 rows at most,
    # however many are wanted: small enough to broadcast, by construction. What it lets through by chance, the join drops.
    at = F.xxhash64("t").bitwiseAND((1 << FILTER_BITS) - 1)
    word, bit = F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    bitmap = want.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    own = docs.withColumn("__word", word).withColumn("__bit", bit)
    docs = own.join(F.broadcast(bitmap), (F.col("__word") == F.col("word")) & (F.col("bits").bitwiseAND(F.col("__bit")) != 0), "left_semi").drop("__word", "__bit")
    texts = docs.join(want, "t").groupBy("nid").agg(F.first("text").alias("text"))
    return written(texts.mapInArrow(_sets(k), "nid long, shingles array<long>"), "sets")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""
    left = sets.select(F.col("nid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("nid").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    small, large = F.least(F.size("x"), F.size("y")), F.greatest(F.size("x"), F.size("y"))
    shared = F.size(F.array_intersect("x", "y"))
    # Sets of too different sizes can't be similar; the others are intersected.
    similar = (small >= threshold * large) & (shared >= threshold * (small + large - shared))
    return written(both.where(similar).select("a", "b"), "links")


def _block_links(threshold: float) -> Callable:
    """One pair of blocks of one bucket: rows (a, b, n), either a link a < b of a spanning forest, or b null and n links of a."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        nid, left, right = (group.column(c).to_numpy() for c in ("nid", "i", "side"))
        flat = lambda c: pc.list_flatten(group.column(c)).to_numpy()
        bands_of = flat("bands").reshape(len(nid), -1)
        crowded = np.isin(bands_of, np.unique(flat("crowds")))
        here = int(np.flatnonzero(bands_of[0] == group.column("b")[0].as_py())[0])
        vocabulary, code = np.unique(flat("shingles"), return_inverse=True)
        size = pc.list_value_length(group.column("shingles")).to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        # Pairs of one block with itself are taken once, in the order of rows; those of two blocks from the first to the second.
        same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        first, second = np.flatnonzero(right == left), np.flatnonzero(right != left)
        mark = np.zeros(len(vocabulary), bool)
        degree, label = np.zeros(len(nid), np.int64), np.arange(len(nid))
        links: list[tuple[int, int]] = []
        for place, x in enumerate(first.tolist()):
            others = first[place + 1 :] if same else second
            others = others[np.minimum(size[others], size[x]) >= threshold * np.maximum(size[others], size[x])]
            met = bands_of[others] == bands_of[x]
            # Met first here, and in no small bucket, where pairs are listed.
            others = others[met[:, here] & ~met[:, :here].any(axis=1) & ~(met & ~crowded[x]).any(axis=1)]
            if not len(others):
                continue
            own = code[start[x] : start[x] + size[x]]
            mark[own] = True
            ends = np.cumsum(size[others])
            at = np.arange(int(ends[-1])) + np.repeat(start[others] - (ends - size[others]), size[others])
            shared = np.add.reduceat(mark[code[at]], ends - size[others], dtype=np.int64)
            mark[own] = False
            linked = others[shared >= threshold * (size[others] + size[x] - shared)]
            degree[x] += len(linked)
            degree[linked] += 1
            apart, one = np.unique(label[linked], return_index=True)
            new = apart != label[x]
            links += [(x, int(y)) for y in linked[one[new]]]
            if new.any():
                label[np.isin(label, apart[new])] = label[x]
        some = np.flatnonzero(degree)
        ends_of = nid[np.array(links, np.int64).reshape(-1, 2)]
        return pa.table(
            {
                "a": pa.array(np.concatenate([nid[some], ends_of.min(axis=1)])),
                "b": pa.array(np.concatenate([np.zeros(len(some), np.int64), ends_of.max(axis=1)]), mask=np.arange(len(some) + len(links)) < len(some)),
                "n": pa.array(np.concatenate([degree[some], np.zeros(len(links), np.int64)])),
            }
        )

    return run


def crowd_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float, crowd: int, block: int) -> DataFrame:
    """Rows (a, b, n) of _block_links for the pairs that meet in buckets of more than crowd nodes only."""
    crowded = members.where(F.col("m") > crowd)
    crowds = crowded.groupBy("nid").agg(F.collect_list("b").alias("crowds"))
    info = nodes.select("nid", "bands").join(crowds, "nid").join(sets, "nid")
    blocks = F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("w") / BLOCK_SHINGLES)).cast("int")
    own = crowded.withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("nid", "b"), F.col("blocks")).cast("int"))
    meets = own.select("b", "nid", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meets = meets.select("b", "nid", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    return written(meets.join(info, "nid").groupBy("b", "i", "j").applyInArrow(_block_links(threshold), "a long, b long, n long"), "crowd-links")


def links_of(documents: DataFrame, nodes: DataFrame, k: int = WORDS, threshold: float = THRESHOLD, crowd: int = CROWD, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(a < b: verified links that connect all linked nodes; nid, n_links: the number of all links of every linked node)."""
    members = buckets_of(nodes)
    sets = shingle_table(documents, nodes, members.select("nid").distinct(), k)
    listed = verified(written(all_pairs(members.where(F.col("m") <= crowd)), "pairs"), sets, threshold)
    dense = crowd_links(members, nodes, sets, threshold, crowd, block)
    spanning = listed.unionByName(dense.where("b IS NOT NULL").select("a", "b")).distinct()
    one = F.lit(1).cast("long").alias("n")
    counts = listed.select(F.col("a").alias("nid"), one).unionByName(listed.select(F.col("b").alias("nid"), one)).unionByName(dense.where("b IS NULL").select(F.col("a").alias("nid"), "n"))
    return written(spanning, "all-links"), written(counts.groupBy("nid").agg(F.sum("n").alias("n_links")), "degrees")


def components(links: DataFrame) -> DataFrame:
    """nid, label (the smallest nid of its component) of every linked node."""
    edges = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))), "edges")
    labels = written(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("l")), "labels")
    while True:
        heard = edges.join(labels.select(F.col("u").alias("v"), "l"), "v").groupBy("u").agg(F.min("l").alias("heard"))
        lower = written(labels.join(heard, "u").select("u", F.least("l", "heard").alias("l"), F.col("l").alias("was")), "lower")
        jump = lower.select(F.col("u").alias("l"), F.col("l").alias("next"))
        moved = written(lower.join(jump, "l").select("u", F.least("l", "next").alias("l"), "was"), "moved")
        labels = moved.select("u", "l")
        if not moved.where("l <> was").limit(1).count():
            return labels.select(F.col("u").alias("nid"), F.col("l").alias("label"))


def near_duplicates(documents: DataFrame, k: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id, set_id, n_links of every document; and t (the text's hash), class_t (the text that stands for the class)."""
    with disposable(documents.sparkSession) as keep:
        signed, info = _classes(documents, k, threshold, recall, crowd, block)
        keep(signed, info)
    return signed.join(info, ["n", "s1", "s2"]).select("doc_id", "class_id", "set_id", "n_links", "t", "class_t")


def _classes(documents: DataFrame, k: int, threshold: float, recall: float, crowd: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(signed documents, and what holds for each shingle set: its class, number of links), both written."""
    signed, nodes = nodes_of(documents, k, threshold, recall)
    links, degree = links_of(documents, nodes, k, threshold, crowd, block)
    label = components(links)
    named = written(label.join(degree, "nid"), "named")
    key = ["n", "s1", "s2"]
    ids = signed.groupBy(*key).agg(F.min("doc_id").alias("set_id"))
    sets = nodes.select("nid", "t", *key).join(ids, key).join(named, "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    sets = written(sets, "classes")
    # The class's text is that of its smallest document, or the smallest hash among those without doc_id.
    first = F.struct(F.col("set_id").isNull(), "set_id", "t")
    classes = written(sets.groupBy("label").agg(F.min("set_id").alias("class_id"), F.min(first)["t"].alias("class_t")), "class-ids")
    info = written(sets.join(classes, "label").select(*key, "class_id", "set_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "class_t"), "info")
    return signed, info
