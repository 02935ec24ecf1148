"""Duplicates: within a time to live after the last accepted record (WIN-5), and against all keys ever seen (JOIN-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.columns import by_hash
from sessionlens.operators.fold import ordered_fold

KEY = ["acct_session_id", "acct_status_type"]
TTL = 3600
#: Sessions are counted by so many buckets; one with more than HOT records isn't brought together in one task (by_session).
BUCKETS, HOT = 65_536, 500_000
REASON = "LATE_DUPLICATE_LONG_TERM"


def accepted_times(records: DataFrame, ttl: int = TTL) -> DataFrame:
    """The key and at (epoch seconds) of every accepted record: the first of a key, then each first one more than ttl after.

    Accepted times are more than ttl apart, so a bucket of ttl + 1 seconds holds one at most, and it depends on nothing but
    the one before. Rows meet by key and bucket (map-side first), never by key: of a key only its distinct seconds travel on,
    four bytes each, in one array a bucket, and one fold a key goes from bucket to bucket. A key whose records all lie within
    ttl has its first one accepted and no other; only longer keys are folded. records are read twice.
    """
    width = ttl + 1
    at = F.unix_seconds("event_ts")
    timed = records.where(at.isNotNull())
    spans = timed.groupBy(*KEY).agg(F.min(at).alias("at"), F.max(at).alias("last"))
    longer = F.col("last") - F.col("at") > ttl
    once = spans.where(~longer).select(*KEY, "at")
    bucket = F.floor(at / width)
    offset = (at - bucket * width).cast("int")
    # A key with a null is its own, as in groupBy, but counts for nothing later: no record of it is a duplicate.
    seconds = timed.join(spans.where(longer).select(*KEY), KEY, "left_semi").groupBy(*KEY, bucket.alias("bucket")).agg(F.array_sort(F.collect_set(offset)).alias("offsets"))
    history = seconds.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("bucket", "offsets"))).alias("history"))

    def first(last: Column, x: Column) -> Column:
        """The bucket's first time that is late enough, if any."""
        base = x.bucket * width
        return base + F.array_min(F.filter(x.offsets, lambda o: last.isNull() | (base + o >= last + width)))

    times = ordered_fold(F.col("history"), F.lit(None).cast("bigint"), lambda last, x: F.coalesce(first(last, x), last), first, "bigint")
    return once.unionByName(history.select(*KEY, F.explode(times).alias("at")))


def mark_ttl(records: DataFrame, ttl: int = TTL, seq: str = "seq") -> DataFrame:
    """records plus is_duplicate: not more than ttl seconds after the last accepted record of its key, in order of event time.

    A duplicate does not move the last accepted time. A record without a readable time, or with a null in its key, is accepted
    and changes nothing. records are read several times: give a table, or the plan runs as often.
    """
    own = records.withColumn("__at", F.unix_seconds("event_ts"))
    rank = F.row_number().over(Window.partitionBy(*KEY, "__at").orderBy(seq))
    own = own.withColumn("__rank", rank)
    times = accepted_times(records, ttl).withColumnRenamed("at", "__at").withColumn("__accepted", F.lit(True))
    counts = F.col("__at").isNotNull() & F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull()
    first = F.col("__accepted").isNotNull() & (F.col("__rank") == 1)
    return own.join(times, [*KEY, "__at"], "left").withColumn("is_duplicate", counts & ~first).select(*[records[c] for c in records.columns], "is_duplicate")


def hot_buckets(records: DataFrame) -> list[int]:
    """Buckets of sessions (of BUCKETS) with more than HOT records. The driver gets one number for every HOT records at most."""
    sizes = records.groupBy(_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return [r.bucket for r in sizes.where(F.col("n") > HOT).select("bucket").collect()]


def in_buckets(buckets: list[int]) -> Column:
    return _bucket().isin(*buckets) if buckets else F.lit(False)


def _bucket() -> Column:
    return F.pmod(F.hash(KEY[0]), F.lit(BUCKETS))


def by_session(records: DataFrame, ttl: int = TTL, seq: str = "seq") -> DataFrame:
    """records, moved once and kept together by session, plus is_duplicate as of mark_ttl, or null where only that can tell.

    A record more than ttl after the one before it in its key is accepted whatever came earlier. The key's first record is
    accepted, and so decides those up to ttl after it. A key has others only if it has records within ttl of each other later on.
    """
    at = F.col("__at")
    key = Window.partitionBy(*by_hash(KEY[0]), KEY[1]).orderBy("__at", seq)
    first = F.first(at, ignorenulls=True).over(key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = records.repartition(KEY[0]).withColumn("__at", F.unix_seconds("event_ts"))
    rows = rows.select("*", F.lag(at).over(key).alias("__before"), first.alias("__first"))
    fresh = F.col("__before").isNull() | (at - F.col("__before") > ttl)
    counts = at.isNotNull() & F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull()
    found = F.when(fresh | ~counts, F.lit(False)).when(at - F.col("__first") <= ttl, F.lit(True))
    return rows.select(*records.columns, found.alias("is_duplicate"))


def drop_ttl(records: DataFrame, ttl: int = TTL, seq: str = "seq") -> DataFrame:
    return mark_ttl(records, ttl, seq).where(~F.col("is_duplicate")).drop("is_duplicate")


def mark_long_term(records: DataFrame, seen: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """records plus is_duplicate: the key is in `seen`, or came up earlier in these records."""
    rank = F.row_number().over(Window.partitionBy(*by_hash(KEY[0]), KEY[1]).orderBy(*(order or ["event_ts", "seq"])))
    out = records.withColumn("__first", rank == 1)
    if seen is not None:
        known = seen.select(*KEY).distinct().withColumn("__seen", F.lit(True))
        out = out.join(known, KEY, "left").withColumn("__first", F.col("__first") & F.col("__seen").isNull()).drop("__seen")
    return out.withColumn("is_duplicate", ~F.col("__first")).drop("__first")


def duplicate_log(marked: DataFrame, detected_at: Column) -> DataFrame:
    """SNK-7's rows."""
    return marked.where("is_duplicate").select(F.col("acct_session_id").alias("session_id"), detected_at.alias("detected_at"), F.lit(REASON).alias("reason"))


def new_keys(marked: DataFrame) -> DataFrame:
    """The keys that the kept records add to the long-term state."""
    return marked.where(~F.col("is_duplicate")).select(*KEY, F.col("event_ts").alias("first_seen_at"))
