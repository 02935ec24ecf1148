"""Token counts against whole encodings, the prefix trie and the clusters against plain Python."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from sessionlens.llm import catalog, kd_clusters, prefix_trie, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, size int, key string"


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    catalog.with_package(spark)


def whole_counts(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def odd_texts():
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "語", "1", "٣", " ", "  ", "\n", "\r\n", "\t", " ", " ", "'s", "'re", "'", "don't", "...", "<|endoftext|>", "<|endof", "́", "😀", "hello", " world", "\x1c", "\x85"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(50, 900))) for _ in range(60)]
    return texts + ["a" * 3000, "語" * 2000, " " * 2500, "\n" * 1500 + "x", "ab " * 1000, "1" * 2000, "word " * 50 + "w" * 2000 + " end" * 50, "'re" * 700, "<|endoftext|>" * 200, "", "x" * 239, "x " * 120]


def test_spliced_counts(spark):
    texts = odd_texts()
    rows = [(i, x, 1, "k") for i, x in enumerate(texts)] + [(7, texts[7], 1, "k"), (None, texts[3], None, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    want = dict(zip(texts, whole_counts(texts), strict=True))
    for chunk, overlap in ((200, 40), (350, 100)):
        got = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), 512, chunk, overlap).collect()
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
            (-1 if i is None else i, len((x or "").encode()), want.get(x or "", 0), want.get(x or "", 0) > 512) for i, x, *_ in rows
        )


def test_seams_are_settled_in_the_overlap():
    """Ordinary prose needs no second cut: every seam has a proven place."""
    text = "The quick brown fox, it doesn't matter; 123 times.\n" * 200
    own = token_counts.pieces(public_tokenizers.path("byte_bpe_50k.json"))
    a, b = text[: 2000 + 300], text[2000:]
    at_a, n_a = token_counts.seams(own.starts(a), a, 0, 2000, len(a) - token_counts.MARGIN)
    at_b, n_b = token_counts.seams(own.starts(b), b, 2000, 0, 300)
    common = sorted(set(at_a) & set(at_b))
    assert len(common) > 20
    for p in common:
        n = n_a[at_a.index(p)] - n_b[at_b.index(p)] + len(own.starts(b))
        assert n == whole_counts([text])[0]


def test_long_text_and_other_tokenizers(spark):
    """Two megabytes, most of it one word; and a model that isn't spliced."""
    text = "Some words here. " * 60_000 + "x" * 400_000 + " end " * 120_000
    docs = spark.createDataFrame([(1, text, 0, ""), (2, text, 0, ""), (3, "short", 0, "")], DOCS)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    n, short = whole_counts([text, "short"])
    assert got == {1: n, 2: n, 3: short}
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    assert not token_counts.can_splice(path) and not token_counts.can_splice(public_tokenizers.path("word_bpe_49k.json"))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    few = spark.createDataFrame([(1, "hello there " * 50, 0, ""), (2, None, 0, "")], DOCS)
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(few, path).collect()} == {1: len(model.encode("hello there " * 50)), 2: 0}


def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seq = tuple(convs.get(base, [])[:h]) + tuple(own[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = sum(saved[k] for k in kids) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        digest = sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids), leaves[node], saved[node], digest))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows():
    rng = random.Random(9)
    rows = []
    for c in [*range(-320, 900, 3), *range(0, 900, 100), 10**12 + 5, 10**12]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t if rng.random() > 0.02 or t else None, rng.choice(["user", None, "bot"]), rng.choice(["a", "bb", "", None, "éé", "long text"])))
    rows += [(c, t, "user", f"same {t}") for c in range(5000, 5900) for t in range(7)]
    rows += [(77777, t, "user", rng.choice("ab")) for t in range(3000)]
    rows += [(88800 + i, t, "user", "loop") for i in range(3) for t in range(400)]
    return rows + [(None, 1, "user", "lost"), (None, None, None, None)]


@pytest.mark.parametrize(("table", "ends", "fan"), [(100_000, 1 << 16, 16), (7, 20, 2)])
def test_trie(spark, monkeypatch, table, ends, fan):
    for name, value in (("TABLE", table), ("ENDS", ends), ("FAN", fan)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = [*{(c, t): (c, t, r, x) for c, t, r, x in trie_rows() if c is not None}.values(), (None, 1, "user", "lost")]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1)).repartition(5))
    assert sorted(map(str, (tuple(r) for r in got.select(*COLUMNS).collect()))) == sorted(map(str, plain_trie(rows)))


def test_trie_edges(spark):
    schema = "conv_id long, turn long, role string, text string, name string, depth int"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None,) * 6] * 3, schema)).count() == 0
    rows = [(4, None, None, None), (4, None, None, None), (4, None, None, None), (4, 1, "u", "x" * 100_000), (4, 1, "u", "x" * 100_000), (100, 0, "u", "é")]
    got = prefix_trie.prefix_trie(spark.createDataFrame([(*r, "n", 3) for r in rows], schema))
    assert sorted(map(str, (tuple(r) for r in got.select(*COLUMNS).collect()))) == sorted(map(str, plain_trie(rows)))


def plain_clusters(rows, k=16, rounds=3, scale=64, dims=64):
    import math

    from fractions import Fraction

    kept = [(i, tuple(math.floor(Fraction(x) * scale) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    z = [v for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    best = lambda v: min(range(len(z)), key=lambda c: (far(v, z[c]), c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[best(v)].append(v)
        z = [tuple(sum(col) // len(groups[c]) for col in zip(*groups[c], strict=True)) if groups[c] else z[c] for c in range(len(z))]
    out = [(i, c := best(v), far(v, z[c])) for i, v in kept]
    own = defaultdict(int)
    for _, c, d in out:
        own[c] += d
    top = lambda x: min(x, 2**63 - 1)
    return [(i, c, top(d), top(own[c]), top(sum(own.values())), sha256(",".join(map(str, z[c])).encode()).hexdigest()) for i, c, d in out]


CLUSTER = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def compared(got, want):
    assert sorted(map(str, (tuple(r) for r in got.select(*CLUSTER).collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_clusters(spark, kind):
    rng = random.Random(3)
    f = lambda x: float(__import__("numpy").float32(x)) if kind == "float" else x
    center = [[rng.gauss(0, 3) for _ in range(64)] for _ in range(5)]
    rows = [(i, [f(rng.gauss(m, 0.2)) for m in rng.choice(center)]) for i in range(300)]
    rows += [(400 + i, [0.5] * 64) for i in range(90)] + [(400, [0.5] * 64), (None, [f(0.1)] * 64)]
    rows += [(600, None), (601, [1.0] * 63), (602, [1.0] * 63 + [None]), (603, [1.0] * 63 + [float("nan")]), (604, [float("inf")] + [1.0] * 63), (605, [])]
    table = lambda rows: spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, cluster int") if rows else None
    wide = [(i, v, 1) for i, v in rows]
    compared(kd_clusters.cluster_vectors(table(wide).repartition(3), block=64), plain_clusters(rows))
    giants = rows + [(700 + i, [f(rng.choice([1e9, -3e38, 2.0**30]) if j % 7 == 0 else 1.5) for j in range(64)]) for i in range(20)]
    compared(kd_clusters.cluster_vectors(table([(i, v, 1) for i, v in giants]).repartition(3), block=50), plain_clusters(giants))
    few = rows[:5]
    compared(kd_clusters.cluster_vectors(table([(i, v, 1) for i, v in few])), plain_clusters(few))
    assert kd_clusters.cluster_vectors(table(wide).limit(0)).count() == 0


def test_whole_nodes_and_pruning():
    """Separate groups are assigned by node; pruning never changes a point's centroid."""
    import numpy as np

    rng = np.random.default_rng(1)
    centroids = rng.integers(-2000, 2000, (16, 64))
    points = (centroids[rng.integers(0, 16, 3000)] + rng.integers(-40, 40, (3000, 64))).astype(np.int64)
    order, tree = kd_clusters.build(points)
    cluster, count, total, whole = kd_clusters.assign(points[order], tree, centroids)
    assert (cluster == kd_clusters.nearest(points[order], centroids)[0]).all() and count.sum() == 3000 and whole > 2000
    assert all((total[c] == points[order][cluster == c].sum(0)).all() for c in range(16))
    close = rng.integers(-5, 5, (3000, 64)).astype(np.int64)
    order, tree = kd_clusters.build(close)
    near = rng.integers(-5, 5, (16, 64)).astype(np.int64)
    near[9] = near[2]
    assert (kd_clusters.assign(close[order], tree, near)[0] == kd_clusters.nearest(close[order], near)[0]).all()
