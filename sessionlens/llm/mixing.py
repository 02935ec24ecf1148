"""Operator 4, mixing sources to target weights by cube-method balanced sampling.

Sources share mix_share times all words by weight; a target stops at max_repeat times its source's size and the excess is
shared anew by weight until none is above (water filling, in closed form over the sorted ratios of cap to weight). A
document of a source with target t and size s is taken floor(t / s) times for sure and once more with the fractional part
as its inclusion probability. The cube method decides that: in each source, three undecided documents at a time move their
probabilities along the null space of the two balancing constraints (documents and words), until one of them is 0 or 1;
both totals stay as they are. A run leaves at most two documents undecided, besides RESERVE that it holds back; those of all
runs go through the next flight, until one run a source is left. The landing then tries every choice of the last few
documents of a source and takes the one whose words, and then documents, come nearest to what the probabilities promise.

Rows are dealt to runs of about RUN rows by source and a hash of their content, so the result does not depend on how the
input is partitioned, a source with a third of all rows takes many tasks, and a task holds three documents at a time.

Nulls: a null text has size 0; null sources are one source, after all others. A repeated row is a document of its own;
rows that are equal in doc_id and text are interchangeable. A source of no words has target 0. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import SPACED_WORD, own_columns, partitions, repeated, written

WEIGHTS = (3, 1, 2)
#: Documents that one run of the flight decides about.
RUN = 1024
#: Documents of a run that wait for the landing, where they make up for a long one that the flight can't decide.
RESERVE = 12
_ZERO = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, mix_share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """source, source_size, target from (source, size): a table of one row a source.

    With ratios r = cap / weight in ascending order, the sources up to some rank are capped; the others get weight times
    one common level. The level is the first that its own ratio is not below.
    """
    # One row a source reaches these windows, not one a document.
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)).cast("int") + 1)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    all_rows = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(all_rows) * F.lit(float(mix_share))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = per.withColumn("level", level)
    # From the first such rank on, levels only fall.
    common = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(all_rows)
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * common, F.col("cap")))
    return leveled.select("source", "source_size", target.alias("target"))


class Flight:
    """The flight phase of one run: add() documents one by one, take decided ones from done; left holds the undecided."""

    def __init__(self, seed: str = "") -> None:
        self.draw = Random(seed).random
        self.left: list[list] = []
        self.done: list[tuple[int, float]] = []
        self.reserve: list[list] = []

    def add(self, row: int, size: float, p: float) -> None:
        self.reserve.append([row, size, p])
        if len(self.reserve) > RESERVE:
            self._decide(self.reserve.pop(0))

    def _decide(self, unit: list) -> None:
        self.left.append(unit)
        while len(self.left) == 3:
            self._move()
            keep = []
            for unit in self.left:
                if unit[2] < _ZERO or unit[2] > 1 - _ZERO:
                    self.done.append((unit[0], float(unit[2] > 0.5)))
                else:
                    keep.append(unit)
            self.left = keep

    def _move(self) -> None:
        """Along u, with sum(u) = 0 and sum(u * size) = 0, as far as the unit cube reaches."""
        (_, a, p), (_, b, q), (_, c, r) = self.left
        u = (b - c, c - a, a - b)
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        ps = (p, q, r)
        up = min((1 - x) / d if d > 0 else x / -d for x, d in zip(ps, u, strict=True) if d)
        down = min(x / d if d > 0 else (1 - x) / -d for x, d in zip(ps, u, strict=True) if d)
        # The side is drawn at random with odds down : up, which keeps each document's probability.
        step = up if self.draw() * (up + down) < down else -down
        for unit, x, d in zip(self.left, ps, u, strict=True):
            unit[2] = x + step * d


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _fly(batches: Iterator[pa.RecordBatch], seed: str) -> Iterator[pa.RecordBatch]:
    """Rows of s, run, size, ..., p, sorted by run -> the same rows with p moved: 0 or 1, or in between for at most RESERVE + 2 rows a run.

    A run has draws of its own, and its rows come in a fixed order: reruns agree.
    """
    run, flight, held, n, schema = None, Flight(), {}, 0, None

    def decided() -> list[tuple]:
        nonlocal flight
        out = [(*held.pop(k)[:-1], p) for k, p in flight.done]
        flight.done = []
        return out

    def undecided() -> list[tuple]:
        out = [(*held.pop(k)[:-1], p) for k, _, p in flight.left + flight.reserve]
        flight.left, flight.reserve = [], []
        return out

    for batch in batches:
        schema, out = batch.schema, []
        for row in _rows(batch):
            if row[:2] != run:
                out += decided() + undecided()
                run, flight = row[:2], Flight(f"{seed}/{row[0]}/{row[1]}")
            held[n] = row
            flight.add(n, float(row[2]), row[-1])
            n += 1
        if out := out + decided():
            yield _batch(out, schema)
    if held:
        yield _batch(decided() + undecided(), schema)


def _land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by source, at most RESERVE + 2 a source -> p of 0 or 1 with the words nearest to what the probabilities promise."""
    held: list[tuple] = []
    source, schema = None, None

    def landed() -> list[tuple]:
        size, p = np.array([r[2] for r in held], float), np.array([r[-1] for r in held])
        choices = (np.arange(1 << len(held))[:, None] >> np.arange(len(held)) & 1) - p
        words, docs = np.abs(choices @ size), np.abs(choices.sum(1))
        best = int(np.argmin(words + docs * size.mean() / 100))
        best = [best >> i & 1 for i in range(len(held))]
        return [(*r[:-1], float(c)) for r, c in zip(held, best, strict=True)]

    for batch in batches:
        schema, out = batch.schema, []
        for row in _rows(batch):
            if row[0] != source and held:
                out += landed()
                held = []
            source = row[0]
            held.append(row)
        if out:
            yield _batch(out, schema)
    if held:
        yield _batch(landed(), schema)


def sample_extra(units: DataFrame, seed: int = 0) -> DataFrame:
    """units: s (source number), size, p (0 <= p < 1) and others, which order equal rows -> the same with p 0 or 1.

    Other seeds deal and draw otherwise: over seeds, a document is taken as often as its p says, but for the last few of a
    source, whose choice is the nearest to the totals.
    """
    spark = units.sparkSession
    others = [c for c in units.columns if c not in ("s", "size", "p")]
    cols = ["s", "run", "size", *others, "p"]
    kind = ", ".join(f"{c} {'int' if c == 'run' else units.schema[c].dataType.simpleString()}" for c in cols)
    sure = (F.col("p") <= _ZERO) | (F.col("p") >= 1 - _ZERO)
    out, still, level = units.where(sure).withColumn("p", F.round("p")), units.where(~sure), 0
    while True:
        # Runs a source: what stays undecided shrinks by RUN / (RESERVE + 2) each time, so this ends after a few levels.
        runs = written(still.groupBy("s").agg(F.ceil(F.count(F.lit(1)) / RUN).cast("int").alias("runs")), f"runs-{level}")
        most = runs.agg(F.max("runs")).first()[0] or 0
        run = F.pmod(F.xxhash64(*others, "size", F.lit(level), F.lit(seed)), F.col("runs")).cast("int")
        dealt = still.join(runs, "s").withColumn("run", run).select(*cols).repartition(partitions(spark), "s", "run")
        dealt = dealt.sortWithinPartitions("s", "run", F.xxhash64(*others, F.lit(seed)), "size", *others, "p")
        flown = written(dealt.mapInArrow(partial(_fly, seed=f"{seed}/{level}"), kind), f"flight-{level}").drop("run")
        between = (F.col("p") > 0) & (F.col("p") < 1)
        out, still = out.unionByName(flown.where(~between)), flown.where(between)
        level += 1
        if most <= 1:
            break
    last = still.withColumn("run", F.lit(0)).select(*cols).repartition(partitions(spark), "s").sortWithinPartitions("s", "size", *others)
    return out.unionByName(last.mapInArrow(_land, kind).drop("run"))


def _text_hash(text: Column) -> list[Column]:
    data = F.coalesce(text, F.lit("\x00"))
    return [F.xxhash64(data).alias("t1"), F.xxhash64(F.lit(1), data).alias("t2")]


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, mix_share: float = 1.5, max_repeat: float = 2.0, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, copies (int: times the document is taken), source and t1, t2 (the text's hash) of every document."""
    docs = own_columns(documents, "doc_id", "text", "source")
    size = F.coalesce(F.regexp_count("text", F.lit(SPACED_WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), *_text_hash(F.col("text")))
    rows = written(rows, "sizes")
    targets = source_targets(rows, weights, mix_share, max_repeat)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sure = F.floor(ratio + F.lit(_ZERO))
    targets = targets.withColumn("s", (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1).cast("int"))
    targets = written(targets.withColumn("sure", sure.cast("int")).withColumn("p", F.greatest(F.lit(0.0), ratio - sure)), "targets")
    # A row a source: Spark broadcasts the table below its size limit and shuffles it, splitting a hot source, beyond.
    near = rows.alias("r").join(targets.select("source", "s", "p").alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    units = near.select("t.s", "r.size", "r.doc_id", "r.t1", "r.t2", "t.p")
    taken = sample_extra(units, seed)
    out = taken.withColumnRenamed("p", "extra").join(targets, "s")
    return out.select("doc_id", "size", "source_size", "target", (F.col("sure") + F.col("extra")).cast("int").alias("copies"), "source", "t1", "t2")


def mix_documents(documents: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every document."""
    mixed = mix(documents, seed=seed)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed_rows(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, mix_share: float = 1.5, max_repeat: float = 2.0, seed: int = 0) -> DataFrame:
    """The documents' rows, all columns, each as often as the mix takes it."""
    names = ["__doc_id", "__source", "t1", "t2"]
    mixed = mix(documents, weights, mix_share, max_repeat, seed)
    taken = mixed.groupBy(F.col("doc_id").alias("__doc_id"), F.col("source").alias("__source"), "t1", "t2").agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies"))
    taken = written(taken.where("copies > 0"), "taken")
    own = documents.select(F.struct(*documents.columns).alias("row"), documents["doc_id"].alias("__doc_id"), documents["source"].alias("__source"), *_text_hash(documents["text"]))
    a, b = own.alias("a"), taken.alias("b")
    met = a.join(b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names]).select("row", *[F.col(f"a.{c}") for c in names], "rows", "copies")
    single = met.where("rows = 1").select("row", F.col("copies").alias("times"))
    # Rows of one doc_id, source and text share what the mix takes of them; only these are numbered. Rows that are equal in
    # all columns are one row with a count, before anything is shuffled.
    shared = met.where("rows > 1").groupBy("row", *names, "rows", "copies").agg(F.count(F.lit(1)).alias("m"))
    before = F.sum("m").over(Window.partitionBy(*names).orderBy(F.xxhash64("row"), "m").rowsBetween(Window.unboundedPreceding, -1))
    more = F.greatest(F.lit(0), F.least("m", F.col("copies") % F.col("rows") - F.coalesce(before, F.lit(0))))
    shared = repeated(shared.select("row", (F.expr("m * (copies div rows)") + more).alias("times")), "times")
    return repeated(single, "times", few=True).unionByName(shared).select("row.*")
