"""Operator 7, exact top-k by inner product: norm-sorted vectors, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Components become floor(1024 * x), so scores are whole numbers. The candidates are sorted by descending length and written
in that order as arrays in the shared folder, by ranges of length (ties dealt by id): ids, whole components, the first
HEAD coordinates in the basis of the right singular vectors of all vectors, and the length of what those leave out. The
basis comes from the Gram matrix, which tasks add up (one small matrix a task); the rotation keeps inner products, and puts
most of them into few coordinates. A task takes a block of queries and memory-maps the arrays block by block. It stops when
the longest vector left, by Cauchy-Schwarz, cannot reach a query's k-th best score; within a block, the partial sum plus
the product of the residual lengths bounds every score, and only vectors whose bound reaches are multiplied out, exactly.
Bounds are widened by far more than rounding can take, so the result is exact.

The queries are a stated set against all rows, taken in blocks; a task holds a block of each.

Whole components are kept divided by 1024, which is exact and finite for every finite component. Vectors of components
beyond GIANT take no part in the basis and have no bounds: they are always multiplied out, in integers of any size. Scores
are ranked as they are; those that 64 bits can't hold are returned as the nearest long.

Nulls: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id. Shorter
vectors count as padded with zeros. A query leaves out its own row once; a repeated row is another row. Ties go to the
smaller id. Fewer rows than k give fewer results; empty tables none. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import local_path, own_columns, partitions, scratch, written

SCALE = 1024
#: Rotated coordinates that the partial sums use.
HEAD = 16
#: Beyond this, squares could overflow.
GIANT = 1e100
#: A score in whole numbers of the components divided by SCALE.
UNIT = float(SCALE * SCALE)
#: Queries that one task multiplies at a time, and candidates of a block.
QUERY_BLOCK, BLOCK = 64, 4096

#: DuckDB SQL for queries with vec_id divisible by 100 and k = 10.
SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Equal-length lists as rows, shorter ones padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    out = np.zeros((len(column), dims))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _gram(dims: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column("v"), dims)
            x = x[np.abs(x).max(axis=1, initial=0) <= GIANT]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["gram"])

    return run


def _turned(x: np.ndarray, basis: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Head coordinates, length of the rest, length. Giants have a rest that bounds nothing."""
    most = np.abs(x).max(axis=1, initial=0)
    length = most * np.sqrt(((x / np.maximum(most, 1e-300)[:, None]) ** 2).sum(1))
    giant = most > GIANT
    turned = np.where(giant[:, None], 0.0, x) @ basis
    rest = np.sqrt(np.maximum((turned[:, head:] ** 2).sum(1), 0))
    return turned[:, :head], np.where(giant, np.inf, rest), length


def _whole(x: np.ndarray) -> list[int]:
    return [int(a) * SCALE if abs(a) >= 2.0**53 else int(a * SCALE) for a in x.tolist()]


def _floor(score: float | int) -> float:
    """A float that is not above the score."""
    try:
        return float(score) * (1 - 1e-12 if score > 0 else 1 + 1e-12)
    except OverflowError:
        return 1.7e308 if score > 0 else -np.inf


def _store(folder: str, dims: int, basis: np.ndarray, head: int) -> Callable:
    """Rows sorted by descending length -> array files of BLOCK vectors each, and a row about each block.

    Files appear under their final name only when whole. A task that is run again writes new ones; the manifest names the
    files of the attempt that succeeded.
    """

    def block(ids: np.ndarray, x: np.ndarray) -> tuple:
        name = f"{folder}/{uuid.uuid4().hex}"
        with np.errstate(all="ignore"):
            turned, rest, length = _turned(x, basis, head)
        for what, values in (("ids", ids), ("whole", x), ("head", turned), ("rest", rest), ("length", length)):
            with open(f"{name}.{what}.part", "wb") as f:
                np.save(f, values)
            os.replace(f"{name}.{what}.part", f"{name}.{what}.npy")
        return name, float(length.max()), len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        ids, xs, n, out = [], [], 0, []
        for batch in batches:
            ids.append(batch.column("vec_id").to_numpy())
            xs.append(_matrix(batch.column("v"), dims))
            n += len(ids[-1])
            while n >= BLOCK:
                a, x = np.concatenate(ids), np.concatenate(xs)
                out.append(block(a[:BLOCK], x[:BLOCK]))
                ids, xs, n = [a[BLOCK:]], [x[BLOCK:]], n - BLOCK
        if n:
            out.append(block(np.concatenate(ids), np.concatenate(xs)))
        names, lengths, sizes = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lengths, pa.float64()), pa.array(sizes, pa.int64())], ["name", "length", "n"])

    return run


def _search(manifest: str, dims: int, basis: np.ndarray, head: int, k: int) -> Callable:
    """Queries (vec_id, v) -> query_id, rank, vec_id, score."""

    def best(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        if scores.dtype == object:
            return np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k], np.int64)
        return np.lexsort((ids, -scores))[:k]

    def answer(q_ids: np.ndarray, q: np.ndarray, blocks: list[dict]) -> list[tuple]:
        turned, q_rest, q_length = _turned(q, basis, head)
        top: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(q)
        own = np.ones(len(q), bool)  # its own row is still to be left out
        floor = np.full(len(q), -np.inf)
        for b in blocks:  # by descending length
            # Written so that a bound that is no number leaves nothing out.
            live = np.flatnonzero(~(UNIT * q_length * b["length"] * (1 + 1e-9) + 1 < floor))
            if not len(live):
                break
            part = {what: np.load(f"{b['name']}.{what}.npy", mmap_mode="r") for what in ("ids", "whole", "head", "rest", "length")}
            bound = turned[live] @ part["head"].T + np.outer(q_rest[live], part["rest"])
            slack = 1e-9 * q_length[live, None] * part["length"][None, :]
            reach = ~(UNIT * (bound + slack) + 1 < floor[live, None])
            for r, i in enumerate(live):
                at = np.flatnonzero(reach[r])
                if not len(at):
                    continue
                ids, x = part["ids"][at], part["whole"][at]
                # Products of whole numbers below 2**53 are exact in floating point; larger ones go through integers.
                if UNIT * q_length[i] * b["length"] < 2.0**52:
                    scores = (x @ q[i]) * UNIT
                else:
                    whole, scores = _whole(q[i]), np.empty(len(x), object)
                    scores[:] = [sum(u * v for u, v in zip(_whole(y), whole, strict=True)) for y in x]
                if own[i] and len(same := np.flatnonzero(ids == q_ids[i])):
                    same = same[(x[same] == q[i]).all(1)]
                    if len(same):
                        own[i] = False
                        ids, scores = np.delete(ids, same[0]), np.delete(scores, same[0])
                ids, scores = np.concatenate([top[i][0], ids]), np.concatenate([top[i][1], scores])
                order = best(ids, scores)
                top[i] = (ids[order], scores[order])
                if len(order) == k:
                    floor[i] = _floor(scores[order[-1]])
        return [(int(q_ids[i]), r + 1, int(a), min(max(int(s), -(1 << 63)), (1 << 63) - 1)) for i in range(len(q)) for r, (a, s) in enumerate(zip(*top[i], strict=True))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        for batch in batches:
            if blocks is None:
                with open(manifest) as f:
                    blocks = [json.loads(line) for line in f]
            ids, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), dims)
            for lo in range(0, len(ids), QUERY_BLOCK):
                with np.errstate(all="ignore"):
                    rows = answer(ids[lo : lo + QUERY_BLOCK], x[lo : lo + QUERY_BLOCK], blocks)
                cols = zip(*rows, strict=True) if rows else ((), (), (), ())
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["query_id", "rank", "vec_id", "score"])

    return run


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array of whole doubles divided by SCALE), of the rows that take part."""
    rows = own_columns(embeddings, "vec_id", "embedding").where("vec_id IS NOT NULL AND size(embedding) > 0")
    x = F.transform("embedding", lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    # From 2 ** 43 on, a double times SCALE is whole.
    whole = F.transform(x, lambda e: F.when(F.abs(e) >= 2.0**43, e).otherwise(F.rint(e * SCALE - F.pmod(e * SCALE, F.lit(1.0))) / SCALE))
    return rows.where(finite).select(F.col("vec_id").cast("long"), whole.alias("v"))


def top_k(embeddings: DataFrame, every: int = 100, k: int = 10, head: int = HEAD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for each row whose vec_id is divisible by `every`."""
    spark = embeddings.sparkSession
    vectors = written(whole_vectors(embeddings), "vectors")
    schema = "query_id long, rank int, vec_id long, score long"
    dims = vectors.agg(F.max(F.size("v"))).first()[0]
    if dims is None:
        return spark.createDataFrame([], schema)
    grams = vectors.select("v").mapInArrow(_gram(dims), "gram binary").toLocalIterator()  # dims * dims numbers a task, one at a time
    total = np.zeros((dims, dims))
    for row in grams:
        total += np.frombuffer(row.gram).reshape(dims, dims)
    _, basis = np.linalg.eigh(total)
    basis = np.ascontiguousarray(basis[:, ::-1])
    head = min(head, dims)
    folder = local_path(scratch(spark, "vectors"))
    length = F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)
    by_length = vectors.withColumn("length", length).repartitionByRange(partitions(spark), F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
    stored = by_length.select("vec_id", "v").mapInArrow(_store(folder, dims, basis, head), "name string, length double, n long")
    # One line a block of 4096 vectors goes through the driver into the manifest that tasks read.
    manifest = f"{folder}/manifest"
    os.makedirs(folder, exist_ok=True)
    with open(manifest, "w") as f:
        for b in sorted(stored.collect(), key=lambda b: -b.length):
            f.write(json.dumps(b.asDict()) + "\n")
    queries = vectors.where(F.col("vec_id") % every == 0)
    tasks = max(1, min(partitions(spark) * 4, -(-queries.count() // QUERY_BLOCK)))
    return queries.repartition(tasks, F.xxhash64("vec_id", "v")).mapInArrow(_search(manifest, dims, basis, head, k), schema)
