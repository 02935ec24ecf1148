"""Operator 1, sharding: a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

Every row hashes to a cell of the ring; the virtual node at or clockwise of the cell names its home shard. Shards have exact
row capacities (total divided by shards, at most one apart). Rows that their shard cannot hold continue clockwise to the next
virtual node with room. The walk needs only how many rows each cell holds, so it runs on cell totals: it turns them into rank
intervals, and each row finds its interval by its rank in its cell. Rows that no shard overflowed stay where the plain ring
puts them, so little moves when rows or shards come and go: with 1024 virtual nodes a shard, loads are even to a few percent.

Rows that are equal in all columns are one row with a count until the end, so a row that stands for a third of all is ranked
once. Cells of more than BUCKET_ROWS rows, as one key with many different rows makes, are ranked in parts by a hash of the
whole row.

Nulls: a null text has no bytes (size 1, CRC of no bytes, 0); a null key is a key of its own. Repeated rows take consecutive
ranks. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import blake2b

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import own_columns, repeated, written

#: Most ring buckets whose totals reach the driver, whatever the input's size: about 16 MB.
MAX_BUCKETS = 1 << 19
#: Rows that are ranked together at most, as long as MAX_BUCKETS allows.
BUCKET_ROWS = 200_000
VNODES = 1024
#: Cells a virtual node: the finer, the less moves with the number of shards.
CELLS = 16


def ring(shards: int, vnodes: int) -> tuple[int, list[tuple[int, int]]]:
    """(bits, [(cell, shard) of every virtual node, clockwise]): the ring has 2**bits cells, CELLS a virtual node at least."""
    bits = (CELLS * shards * vnodes - 1).bit_length()
    seen: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            draw = 0
            while (at := _point(shard, v, draw) >> (64 - bits)) in seen:
                draw += 1  # a free cell anywhere: the next one would make arcs uneven
            seen[at] = shard
    return bits, sorted(seen.items())


def _point(shard: int, v: int, draw: int) -> int:
    return int.from_bytes(blake2b(f"{shard}/{v}/{draw}".encode(), digest_size=8).digest(), "big")


def walk(totals: list[int], homes: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Rank intervals (bucket, from, to, shard, first slot) for buckets in clockwise order, homes[b] the shard of bucket b.

    First each bucket fills its home shard as far as it has room, clockwise; then what is left over continues clockwise
    to the following buckets' shards that still have room.
    """
    n = sum(totals)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    used = [0] * shards
    plan: list[tuple[int, int, int, int, int]] = []
    left: list[tuple[int, int]] = []

    def put(b: int, at: int, shard: int) -> int:
        k = min(totals[b] - at, room[shard])
        if k:
            plan.append((b, at, at + k, shard, used[shard]))
            room[shard] -= k
            used[shard] += k
        return at + k

    for b in range(len(totals)):
        if (at := put(b, 0, homes[b])) < totals[b]:
            left.append((b, at))
    after = _next_other(homes)
    for b, at in left:
        x = b
        while at < totals[b]:
            x = after[x]
            at = put(b, at, homes[x])
    return plan


def _next_other(homes: list[int]) -> list[int]:
    """For each bucket the first bucket clockwise whose shard is another one."""
    n = len(homes)
    out = [0] * n
    change = [i for i in range(n) if homes[i] != homes[i - 1]] or [0]
    for b in range(n):
        k = bisect_left(change, b + 1)
        out[b] = change[k] if k < len(change) else change[0]
    return out


def shard_rows(rows: DataFrame, key: list[str], shards: int = 16, vnodes: int = VNODES, order: list[str] | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """rows plus shard (int, 0 to shards - 1) and slot (long, gapless from 0 in each shard).

    key: columns that place a row on the ring. order: further columns that order rows of equal key, so that reruns agree.
    Shard counts are at most one apart (law `rows`).
    """
    spark = rows.sparkSession
    names = rows.columns
    order = order or [c for c in names if c not in key]
    bits, vn = ring(shards, vnodes)
    cell = F.shiftrightunsigned(F.xxhash64(*key), 64 - bits).cast("int")
    same = written(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__m")).withColumn("__cell", cell), "rows")
    counts = dict(same.groupBy("__cell").agg(F.sum("__m")).collect())  # at most one row a cell
    most = max(bucket_rows, 2 * sum(counts.values()) // MAX_BUCKETS)
    parts = {c: -(-n // most) for c, n in counts.items() if n > most}
    # Cells in parts: as many as there are rows by `most` at the most, so both tables below are small enough to broadcast.
    split = F.broadcast(spark.createDataFrame(list(parts.items()), "__c int, __parts int"))
    hashed = F.pmod(F.xxhash64(*key, *order, F.lit(1)), F.coalesce("__parts", F.lit(1))).cast("int")
    placed = same.join(split, F.col("__cell") == F.col("__c"), "left").withColumn("__part", hashed)
    totals = {(c, 0): n for c, n in counts.items() if c not in parts}
    if parts:
        own = placed.where("__parts IS NOT NULL").groupBy("__cell", "__part").agg(F.sum("__m").alias("n")).collect()
        totals |= {(r[0], r[1]): r[2] for r in own}
    # Cells without rows count too: the walk passes every virtual node.
    buckets = sorted(totals.keys() | {(c, 0) for c, _ in vn})
    homes, at = [], 0
    for c, _ in buckets:
        while at < len(vn) and vn[at][0] < c:
            at += 1
        homes.append(vn[at % len(vn)][1])
    plan = [(*buckets[b], *rest) for b, *rest in walk([totals.get(b, 0) for b in buckets], homes, shards)]
    intervals = spark.createDataFrame(plan, "__ic int, __ip int, __from long, __to long, shard int, __slot long")
    so_far = F.sum("__m").over(Window.partitionBy("__cell", "__part").orderBy(F.xxhash64(*key), *key, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = placed.withColumn("__end", so_far).withColumn("__rank", so_far - F.col("__m"))
    near = (F.col("__cell") == F.col("__ic")) & (F.col("__part") == F.col("__ip")) & (F.col("__end") > F.col("__from")) & (F.col("__rank") < F.col("__to"))
    lo, hi = F.greatest("__rank", "__from"), F.least("__end", "__to")
    met = ranked.join(F.broadcast(intervals), near).select(*names, "shard", (F.col("__slot") + lo - F.col("__from")).alias("__slot"), (hi - lo).alias("__times"))
    return repeated(met, "__times").select(*names, "shard", (F.col("__slot") + F.col("__copy")).alias("slot"))


def shard_documents(documents: DataFrame, shards: int = 16, vnodes: int = VNODES) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard (null: the law is `rows`)."""
    docs = own_columns(documents, "doc_id", "text")
    data = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = docs.select("doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    out = shard_rows(rows, ["doc_id"], shards, vnodes)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
