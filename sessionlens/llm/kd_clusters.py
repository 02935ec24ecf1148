"""Operator 13, centroid clustering: Lloyd's rounds in whole numbers, filtered through kd-trees.

Each partition packs its vectors into blocks of at most BLOCK and builds a kd-tree a block, once: nodes hold a box, a count
(their range of points) and the integer sum of their points. A round walks each tree with the centroids that may still win.
At a node the centroid nearest to the box's middle stands for the rest: another one goes if it is farther from every point of
the box, strictly, so that ties stay. A node with one centroid left is assigned whole, by its count and sum; at a leaf the
distances decide, ties to the smaller number. Only sums a cluster, dimension and limb leave a task, added up by Spark; the
driver holds k centroids. Pruning changes the work, never the result.

Components are floor(scale * x) in whole numbers. Up to `limit` (2 ** 26 in 64 dimensions) all arithmetic fits 64 bits;
vectors beyond, and rounds with such centroids, are worked out in Python's unbounded numbers. Sums travel in limbs of 40 bits.
A distance or an inertia past 64 bits is returned as the largest long.

Vectors that are null, of another length, or with null or non-finite components take no part and have no row. A null vec_id
is a vector like others, last among the first centroids. Rows of equal vec_id are vectors of their own, ordered by their
components. With fewer vectors than k there are fewer centroids. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import disposable, own_columns, written

#: Vectors of a tree, and of a leaf at most (more only if they are all equal).
BLOCK, LEAF = 4096, 32
LIMB = 40
LONGEST = 2**63 - 1


def limit(dims: int) -> int:
    """Components below this in size, in so many dimensions, give squares of doubled differences that add up within 62 bits."""
    return math.isqrt(2**62 // dims) // 4


class Tree(NamedTuple):
    """Nodes in an order in which the root is first; points are in leaf order."""

    span: np.ndarray  #: first point and the one after the last, left and right child (-1: a leaf)
    lo: np.ndarray
    hi: np.ndarray
    total: np.ndarray


def build(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, Tree]:
    """The order of the points, and their tree: boxes are cut at the median of their widest side."""
    order = np.arange(len(points))
    span, lo, hi, total = [], [], [], []
    todo = [(0, len(points), -1, 0)]
    while todo:
        s, e, parent, side = todo.pop()
        own = points[order[s:e]]
        me = len(span)
        if parent >= 0:
            span[parent][2 + side] = me
        span.append([s, e, -1, -1])
        lo.append(own.min(0))
        hi.append(own.max(0))
        total.append(own.sum(0))
        wide = hi[-1] - lo[-1]
        d = int(wide.argmax())
        if e - s > leaf and wide[d] > 0:
            mid = (e - s) // 2
            order[s:e] = order[s:e][np.argpartition(own[:, d], mid)]
            todo += [(s + mid, e, me, 1), (s, s + mid, me, 0)]
    return order, Tree(np.array(span, np.int32), np.array(lo), np.array(hi), np.array(total))


def contenders(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Those of some centroids (by number) that aren't strictly farther from all of a box than the one nearest to its middle."""
    own = centroids[among]
    best = own[((2 * own - (lo + hi)) ** 2).sum(1).argmin()]
    way = own - best
    corner = np.where(way > 0, hi, lo)  # the box's point that is best for the other one
    return among[(own**2).sum(1) - (best**2).sum() - 2 * (corner * way).sum(1) <= 0]


def assign(points: np.ndarray, tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Each point's cluster, the clusters' counts and sums, and how many points were assigned with their node."""
    k = len(centroids)
    cluster, count, total, whole = np.zeros(len(points), np.int32), np.zeros(k, np.int64), np.zeros_like(centroids), 0
    todo = [(0, np.arange(k))]
    while todo:
        i, among = todo.pop()
        s, e, left, right = tree.span[i]
        among = contenders(tree.lo[i], tree.hi[i], centroids, among)
        if len(among) == 1:
            c = among[0]
            cluster[s:e] = c
            count[c] += e - s
            total[c] += tree.total[i]
            whole += e - s
        elif left < 0:
            own = among[nearest(points[s:e], centroids[among])[0]]
            cluster[s:e] = own
            for c in set(own.tolist()):
                count[c] += (own == c).sum()
                total[c] += points[s:e][own == c].sum(0)
        else:
            todo += [(left, among), (right, among)]
    return cluster, count, total, whole


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest centroid of each point, and the squared distance."""
    d = np.stack([((points - c) ** 2).sum(1) for c in centroids], 1)
    at = d.argmin(1)
    return at, d[np.arange(len(points)), at]


def whole_numbers(x: np.ndarray, scale: int, most: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """floor(scale * x): which rows stay below `most`, those rows, and the others' rows."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    small = (np.abs(y) < most).all(1)
    return small, y[small].astype(np.int64), [[a * scale // b for a, b in map(float.as_integer_ratio, row)] for row in x[~small].tolist()]


#: Columns of a block: the vectors' ids in leaf order, then the giants' ids.
_BLOCK = "n int, points binary, span binary, lo binary, hi binary, total binary, giants string"


def _blocks(ids: pa.DataType, scale: int, dims: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def row(held: list, giants: list) -> pa.RecordBatch:
        names = pa.concat_arrays([h[0] for h in held])
        points = np.concatenate([h[1] for h in held])
        order, tree = build(points) if len(points) else (np.zeros(0, int), Tree(*(np.zeros((0, w), np.int64) for w in (4, dims, dims, dims))))
        names = pa.concat_arrays([names.take(pa.array(order)), pa.array([g[0] for g in giants], ids)])
        data = [points[order].astype(np.int32), tree.span.astype(np.int32), tree.lo.astype(np.int32), tree.hi.astype(np.int32), tree.total]
        columns = [pa.array([len(points)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in data), pa.array([json.dumps([g[1] for g in giants])])]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), *columns], ["ids", *(c.split()[0] for c in _BLOCK.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, giants, n = [], [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                small, points, rest = whole_numbers(x, scale, limit(dims))
                names = part.column("vec_id")
                held.append((names.filter(pa.array(small)), points))
                giants += zip(names.filter(pa.array(~small)).to_pylist(), rest, strict=True)
                n += part.num_rows
                if n >= size:
                    yield row(held, giants)
                    held, giants, n = [], [], 0
        if held:
            yield row(held, giants)

    return run


class Block(NamedTuple):
    ids: pa.Array
    points: np.ndarray
    tree: Tree
    giants: np.ndarray


def _unpacked(batch: pa.RecordBatch, i: int, dims: int, big: bool) -> Block:
    get = lambda name, kind, width: np.frombuffer(batch.column(name)[i].as_py(), kind).reshape(-1, width)
    kind = object if big else np.int64
    tree = Tree(get("span", np.int32, 4), *(get(c, k, dims).astype(kind) for c, k in (("lo", np.int32), ("hi", np.int32), ("total", np.int64))))
    giants = json.loads(batch.column("giants")[i].as_py())
    return Block(batch.column("ids")[i].values, get("points", np.int32, dims).astype(kind), tree, np.array(giants, object).reshape(-1, dims))


def _is_big(centroids: list[list[int]], dims: int) -> bool:
    return any(abs(x) >= limit(dims) for c in centroids for x in c)


def _totals(centroids: list[list[int]], dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's counts (dimension -1) and sums by cluster, dimension and limb."""
    big = _is_big(centroids, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, exact = np.array(centroids, object if big else np.int64), np.array(centroids, object)
        count, total = [0] * len(z), np.zeros((len(z), dims), object)
        for batch in batches:
            for i in range(batch.num_rows):
                b = _unpacked(batch, i, dims, big)
                if len(b.points):
                    _, n, sums, _ = assign(b.points, b.tree, z)
                    count = [a + int(x) for a, x in zip(count, n, strict=True)]
                    total += sums.astype(object)
                if len(b.giants):
                    for c, x in zip(nearest(b.giants, exact)[0], b.giants, strict=True):
                        count[c] += 1
                        total[c] += x
        rows = [(c, -1, 0, n) for c, n in enumerate(count) if n]
        for c, n in enumerate(count):
            for d in range(dims if n else 0):
                rows += [(c, d, limb, part) for limb, part in limbs(int(total[c, d]))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        columns[3] = [Decimal(x) for x in columns[3]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["cluster", "dim", "limb", "part"])

    return run


def limbs(x: int) -> Iterator[tuple[int, int]]:
    """(place, part): x is the sum of part << LIMB * place, parts having its sign."""
    sign, x, k = (-1 if x < 0 else 1), abs(x), 0
    while x:
        if part := x & ((1 << LIMB) - 1):
            yield k, sign * part
        x >>= LIMB
        k += 1


def _assigned(centroids: list[list[int]], dims: int, ids: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    big = _is_big(centroids, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, exact = np.array(centroids, object if big else np.int64), np.array(centroids, object)
        for batch in batches:
            for i in range(batch.num_rows):
                b = _unpacked(batch, i, dims, big)
                cluster, far = [], []
                if len(b.points):
                    own = assign(b.points, b.tree, z)[0]
                    cluster, far = own.tolist(), ((b.points - z[own]) ** 2).sum(1).tolist()
                if len(b.giants):
                    at, d = nearest(b.giants, exact)
                    cluster, far = cluster + at.tolist(), far + d.tolist()
                yield pa.RecordBatch.from_arrays([b.ids, pa.array(cluster, pa.int32()), pa.array([min(x, LONGEST) for x in far], pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def cluster_vectors(embeddings: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector that takes part.

    The first centroids are the k vectors of smallest sha256 of `seed:vec_id`; empty clusters keep their centroid.
    """
    spark = embeddings.sparkSession
    name = embeddings.schema["vec_id"].dataType
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = own_columns(embeddings, "vec_id", "embedding").select("vec_id", v.alias("v")).where((F.size("v") == dims) & finite)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.orderBy(draw.asc_nulls_last(), "v").limit(k).collect()
    centroids = [[a * scale // b for a, b in (x.as_integer_ratio() for x in r.v)] for r in chosen]
    ids = rows.select("vec_id").limit(0).toArrow().schema.field("vec_id").type
    with disposable(spark) as keep:
        blocks = written(rows.mapInArrow(_blocks(ids, scale, dims, block), f"ids array<{name.simpleString()}>, {_BLOCK}"), "kd-trees")
        for _ in range(rounds):
            sums = blocks.mapInArrow(_totals(centroids, dims), "cluster int, dim int, limb int, part decimal(38,0)")
            got: dict[tuple[int, int], int] = {}
            for r in sums.groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part")).collect():  # at most k * (dims + 1) * limbs rows
                got[r.cluster, r.dim] = got.get((r.cluster, r.dim), 0) + (int(r.part) << LIMB * r.limb)
            centroids = [[got.get((c, d), 0) // n for d in range(dims)] if (n := got.get((c, -1))) else own for c, own in enumerate(centroids)]
        found = written(blocks.mapInArrow(_assigned(centroids, dims, ids), f"vec_id {name.simpleString()}, cluster int, distance long"), "assigned")
        keep(found)
    bounded = lambda total: F.least(total, F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("own"))  # k rows
    digests = spark.createDataFrame([(c, sha256(",".join(map(str, z)).encode()).hexdigest()) for c, z in enumerate(centroids)], "cluster int, centroid_sha256 string")
    total = inertia.agg(F.sum("own").cast("decimal(38,0)").alias("all"))
    per_cluster = inertia.join(F.broadcast(digests), "cluster").join(F.broadcast(total)).select("cluster", bounded(F.col("own")).alias("cluster_inertia"), bounded(F.col("all")).alias("inertia"), "centroid_sha256")
    return found.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """The same by comparing every vector with every centroid. One step a round, for assignment and means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (SELECT id, vec_id, v, c, d FROM (SELECT x.id, x.vec_id, x.v, z.c, list_sum(list_transform(list_zip(x.v, z.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d,
  row_number() OVER (PARTITION BY x.id ORDER BY list_sum(list_transform(list_zip(x.v, z.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))), z.c) AS r FROM x, z{r} z) WHERE r = 1)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT c, i, sum(w) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS w, unnest(range({dims})) AS i FROM a{r}) GROUP BY c, i),
m{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY c),
z{r + 1} AS (SELECT z.c, coalesce(m.v, z.v) AS v FROM z{r} z LEFT JOIN m{r} m ON z.c = m.c)""")
    return f"""WITH x AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: isfinite(e))) = {dims}),
z0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM x QUALIFY c < {k}),
{", ".join(steps)},
i AS (SELECT c, sum(d) AS own FROM a{rounds} GROUP BY c)
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(i.own AS BIGINT) AS cluster_inertia, CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN i ON a.c = i.c JOIN z{rounds} z ON a.c = z.c"""


SQL = _sql()
