"""Operator 10, toxicity: a chain of linear classifiers, one a category, trained with out-of-fold predictions.

The categories are label columns in a fixed order. The first model sees a text's words; each later one also sees the
logits that the models before it give the text. For training, these come from models that did not see the text: every
category is fitted FOLDS times without one fold, and the left-out fold gets that model's prediction; a last fit on all
folds serves new texts. Models are L2-regularised logistic regressions over the presence of words and of word beginnings
(PREFIX bytes), named by BITS bits of hash. Of near copies among the training texts (full sets of five-word shingles with a Jaccard similarity of COPY or more; any of
COPY_KEYS minima finds the pairs to compare, all but 3 in a million at 0.8) one is kept, but no positive of the last
category goes for a negative. Only words whose association with the category stands out of chance (a G statistic of MIN_G or more; there are
tens of thousands of words) get a weight, so that the words of a few mislabelled texts don't turn clean texts toxic.

Training takes at most MAX_TRAIN labelled documents, the first by a hash of their id, whose texts have MAX_BYTES together at
most: the documented bound of what reaches the driver, whatever the texts' length. A text that would pass MAX_BYTES doesn't
train, later ones that fit do. Which texts train is settled from ids, sizes and hashes; only then are texts read for the
driver. Every document of the input is scored, over its whole text.

Nulls: a null text has no words and gets the models' bias; labels with a null in a category don't train; labels of unknown
documents are unused; of repeated labels of one document the largest value counts, of repeated documents of one id every
row is scored and each trains. Without any labelled document, or with one class only, a category's probability is the
smoothed share of its positives (near 0 if there are none). An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.llm import textvec as tv
from sessionlens.llm.common import own_columns

#: Order of the chain: quality problems first, as they explain some labels, then the category that decides.
CATEGORIES = ("quality", "toxic")
BITS = 44
MAX_TRAIN = 6000
#: Of UTF-8: a mean of some 16 000 a text.
MAX_BYTES = 96 << 20
#: Words of fewer training texts get no weight.
MIN_DOCS = 5
MIN_G = 25.0
COPY_KEYS = 8
#: Similarity of near copies, as a fraction of whole numbers: exact at the border.
COPY = (4, 5)
#: Texts compared with one text at a time.
COMPARED = 256
FOLDS = 3
STEPS = 600
L2 = 0.1
#: Bytes of a word that name its beginning.
PREFIX = 5
THRESHOLD = 0.45


@dataclass(frozen=True)
class Link:
    """One classifier of the chain: weights of kept word columns (sorted) and of earlier logits, and a bias."""

    category: str
    columns: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float


def word_columns(column: pa.Array, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of rows: first, last + 1, row of each distinct word and word beginning within its text, its hashed column."""
    for lo, hi, data, offsets in tv.slices(column):
        w = tv.words(data, offsets, tv.ALNUM)
        row = np.repeat(np.arange(hi - lo), np.diff(w.first)).astype(np.uint64)
        start = np.zeros(len(w.start), np.uint64)
        for k in range(PREFIX):
            at = np.minimum(w.start + k, w.end - 1)
            start = start * np.uint64(257) + np.where(w.start + k < w.end, tv._LOWER[data[at]], 0).astype(np.uint64) + np.uint64(1)
        long = w.end - w.start > PREFIX
        h = np.concatenate([w.hash, tv.mix(start[long] ^ np.uint64(0x50524546))])
        both = np.unique((np.concatenate([row, row[long]]) << np.uint64(bits)) | (h >> np.uint64(64 - bits)))
        yield lo, hi, (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def logistic(rows: np.ndarray, cols: np.ndarray, d: int, dense: np.ndarray, y: np.ndarray, l2: float = L2, steps: int = STEPS) -> np.ndarray:
    """Weights of d sparse columns (value 1 at rows, cols), of the dense columns, and the bias, by accelerated gradient descent."""
    n, m = dense.shape
    theta = np.zeros(d + m + 1)
    theta[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    # A bound of the curvature of each weight in the presence of the others: steps need no search and never diverge.
    width = np.bincount(rows, minlength=n) + np.abs(dense).sum(1) + 1.0
    curve = np.concatenate([0.25 * np.bincount(cols, weights=width[rows], minlength=d), 0.25 * np.abs(dense).T @ width, [0.25 * width.sum()]]) + l2
    look, momentum = theta.copy(), 1.0
    for _ in range(steps):
        g = 1.0 / (1.0 + np.exp(-np.clip(logits(rows, cols, dense, look), -40, 40))) - y
        grad = np.concatenate([np.bincount(cols, weights=g[rows], minlength=d) + l2 * look[:d], dense.T @ g + l2 * look[d : d + m], [g.sum()]])
        new = look - grad / curve
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look = new + (momentum - 1) / after * (new - theta)
        theta, momentum = new, after
    return theta


def logits(rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, theta: np.ndarray) -> np.ndarray:
    n, m = dense.shape
    d = len(theta) - m - 1
    return np.bincount(rows, weights=theta[:d][cols], minlength=n) + dense @ theta[d:-1] + theta[-1]


def telling(rows: np.ndarray, cols: np.ndarray, d: int, y: np.ndarray) -> np.ndarray:
    """Which of d columns stand in more (or fewer) positive texts than chance gives: a G test of the two by two table."""
    n, n1 = len(y), y.sum()
    df = np.bincount(cols, minlength=d)
    both = np.bincount(cols, weights=y[rows], minlength=d)
    g = np.zeros(d)
    for seen, expected in ((both, df * n1 / n), (df - both, df * (n - n1) / n), (n1 - both, (n - df) * n1 / n), (n - df - n1 + both, (n - df) * (n - n1) / n)):
        some = seen > 0
        g[some] += 2 * seen[some] * np.log(seen[some] / expected[some])
    return g >= MIN_G


def one_of_copies(texts: pa.Array, y: np.ndarray) -> np.ndarray:
    """Row numbers without near copies of earlier kept rows whose y is no smaller. Texts of under five words all stay."""
    seen: list[dict[int, list[int]]] = [{} for _ in range(COPY_KEYS)]
    sets: dict[int, np.ndarray] = {}
    keep = []
    for lo, hi, data, offsets in tv.slices(texts):
        w = tv.words(data, offsets, tv.ALNUM)
        grams, ok = tv.ngrams(w.hash, 5), tv.within(w.first, 5)
        grams = grams[ok] if len(grams) else grams
        doc = (np.searchsorted(w.first, np.flatnonzero(ok), "right") - 1) if len(grams) else np.zeros(0, np.int64)
        start = np.flatnonzero(np.diff(doc, prepend=-1))
        keys = [np.minimum.reduceat(tv.mix(grams ^ np.uint64(0x1234567 * (k + 1))), start).tolist() if len(start) else [] for k in range(COPY_KEYS)]
        copies = set()
        for i, a, b, own in zip(doc[start].tolist(), start.tolist(), [*start[1:].tolist(), len(grams)], zip(*keys, strict=True), strict=True):
            shingles = np.unique(grams[a:b])
            found = Counter(j for x, s in zip(own, seen, strict=True) for j in s.get(x, ()))
            # The likeliest first; y and sizes alone leave most others out.
            some = [j for j, _ in found.most_common() if y[j] >= y[lo + i] and _may_be_copies(len(sets[j]), len(shingles))]
            if any(_a_copy(shingles, [sets[j] for j in some[k : k + COMPARED]]) for k in range(0, len(some), COMPARED)):
                copies.add(i)
            else:
                sets[lo + i] = shingles
                for x, s in zip(own, seen, strict=True):
                    s.setdefault(x, []).append(lo + i)
        keep += [lo + i for i in range(hi - lo) if i not in copies]
    return np.array(keep, np.int64)


def _may_be_copies(m: int, n: int) -> bool:
    return COPY[1] * min(m, n) >= COPY[0] * max(m, n)


def _a_copy(shingles: np.ndarray, others: list[np.ndarray]) -> bool:
    """Whether a sorted set has the similarity COPY or more with any of the others, on all their elements."""
    size = np.array([len(x) for x in others])
    every = np.concatenate(others)
    hit = shingles[np.minimum(np.searchsorted(shingles, every), len(shingles) - 1)] == every
    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
    return bool((COPY[1] * both >= COPY[0] * (len(shingles) + size - both)).any())


def fit(rows: np.ndarray, cols: np.ndarray, d: int, dense: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of all d columns (most are 0), of the dense columns, and the bias."""
    m = dense.shape[1]
    theta = np.zeros(d + m + 1)
    if y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0) if y.sum() else 1e-9
        theta[-1] = np.log(share / (1 - share))
        return theta
    keep = telling(rows, cols, d, y)
    ok = keep[cols]
    got = logistic(rows[ok], (np.cumsum(keep) - 1)[cols[ok]], int(keep.sum()), dense, y)
    theta[np.append(np.flatnonzero(keep), np.arange(d, d + m + 1))] = got
    return theta


def fit_chain(texts: pa.Array, labels: dict[str, np.ndarray], folds: np.ndarray) -> list[Link]:
    """One Link a category, in the labels' order."""
    n = len(texts)
    parts = [((r + lo).astype(np.int32), c) for lo, _, r, c in word_columns(texts, BITS)]
    rows = np.concatenate([r for r, _ in parts]) if parts else np.zeros(0, np.int32)
    cols = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    del parts
    words, count = np.unique(cols, return_counts=True)
    words = words[count >= MIN_DOCS]
    if len(words):
        at = np.minimum(np.searchsorted(words, cols), len(words) - 1)
        some = words[at] == cols
        rows, cols = rows[some], at[some].astype(np.int32)
        del at, some
    else:
        rows, cols = rows[:0], cols[:0]
    d, earlier, chain = len(words), np.zeros((n, 0)), []
    for category, y in labels.items():
        y = y.astype(float)
        if not n:
            chain.append(Link(category, words, np.zeros(0), np.zeros(len(chain)), -20.0))
            continue
        out = np.zeros(n)
        for fold in np.unique(folds):
            test = folds == fold
            train = ~test if (~test).any() else test
            a, b, place = train[rows], test[rows], np.cumsum(train) - 1
            theta = fit(place[rows[a]], cols[a], d, earlier[train], y[train])
            out[test] = logits((np.cumsum(test) - 1)[rows[b]], cols[b], earlier[test], theta)
        theta = fit(rows, cols, d, earlier, y)
        used = np.flatnonzero(theta[:d])
        chain.append(Link(category, words[used], theta[used], theta[d:-1], float(theta[-1])))
        earlier = np.column_stack([earlier, np.clip(out, -8, 8)])
    return chain


def _score(chain: list[Link]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, rows, cols in word_columns(batch.column("text"), BITS):
                n = hi - lo
                earlier = np.zeros((n, 0))
                for link in chain:
                    if len(link.columns):
                        at = np.minimum(np.searchsorted(link.columns, cols), len(link.columns) - 1)
                        ok = link.columns[at] == cols
                        z = logits(rows[ok], at[ok], earlier, np.concatenate([link.weights, link.earlier, [link.bias]]))
                    else:
                        z = earlier @ link.earlier + link.bias
                    earlier = np.column_stack([earlier, np.clip(z, -8, 8)])
                part = batch.slice(lo, n)
                p = 1.0 / (1.0 + np.exp(-earlier))
                others = [part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays([*others, *(pa.array(p[:, k]) for k in range(len(chain)))], [*part.schema.names, *(f"p{k}" for k in range(len(chain)))])

    return run


def fitting(sizes: np.ndarray, max_bytes: int) -> np.ndarray:
    """Which rows to take, in order, so that their sizes add up to max_bytes at most: each one that still fits."""
    out, left = np.zeros(len(sizes), bool), max_bytes
    for i, n in enumerate(sizes.tolist()):
        out[i] = n <= left
        left -= n if out[i] else 0
    return out


def train(documents: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, max_train: int = MAX_TRAIN, max_bytes: int = MAX_BYTES) -> list[Link]:
    """The chain, from at most max_train labelled documents with texts of at most max_bytes together."""
    known = own_columns(labels, "doc_id", *categories).dropna().groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    # At most max_train rows, here and below: small enough to broadcast, by construction.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    docs = own_columns(documents, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    order = [F.xxhash64("doc_id"), "doc_id", "key"]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")
    sizes = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id").select("doc_id", "key", size).orderBy(*order).limit(max_train).toPandas()
    taken = sizes[fitting(sizes["size"].to_numpy(), max_bytes)].groupby(["doc_id", "key"]).size().reset_index(name="times")
    ids = documents.sparkSession.createDataFrame(taken, T.StructType([docs.schema["doc_id"], T.StructField("key", T.LongType()), T.StructField("times", T.LongType())]))
    one = docs.join(F.broadcast(ids), ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])
    rows = one.join(F.broadcast(chosen), "doc_id").orderBy(*order)
    got = rows.select("text", "times", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).alias("fold"), *categories).toArrow()
    got = got.take(pa.array(np.repeat(np.arange(len(got)), got.column("times").to_numpy())))
    text = got.column("text").combine_chunks()
    text = text if isinstance(text, pa.Array) else pa.concat_arrays(text.chunks)
    y = {c: got.column(c).to_numpy() for c in categories}
    keep = one_of_copies(text, y[categories[-1]])
    return fit_chain(text.take(pa.array(keep)), {c: y[c][keep] for c in categories}, got.column("fold").to_numpy()[keep])


def scored(documents: DataFrame, chain: list[Link]) -> DataFrame:
    """The documents' columns as c0, c1, ... (whatever they are called), text, and p0, p1, ..., one a category."""
    text = documents.columns.index("text")
    docs = documents.select(*[documents[c].alias("text" if i == text else f"c{i}") for i, c in enumerate(documents.columns)])
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in docs.schema] + [f"p{k} double" for k in range(len(chain))])
    return docs.mapInArrow(_score(chain), schema)


def non_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, as they are, whose last category's probability is below the threshold."""
    chain = train(documents, labels)
    kept = scored(documents, chain).where(F.col(f"p{len(chain) - 1}") < threshold)
    return kept.select(*[F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(documents.columns)])


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_<category> of each category and toxic (boolean: the last category's p reaches threshold)."""
    chain = train(documents, labels)
    out = scored(own_columns(documents, "doc_id", "text"), chain)
    names = [F.col(f"p{k}").alias(f"p_{x.category}") for k, x in enumerate(chain)]
    return out.select(F.col("c0").alias("doc_id"), *names, (F.col(f"p{len(chain) - 1}") >= threshold).alias("toxic"))
